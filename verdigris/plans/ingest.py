"""Ingest: a directory of images -> metadata table ``path, label, length,
modificationTime`` (file bodies are never read: ``content`` is pruned)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigris.functions.labels import LABEL_PATTERN, label_from_name, label_from_parent_dir
from verdigris.functions.paths import canonical_path
from verdigris.operators.dataset import first_row_per_key
from verdigris.sources.files import binary_files
from verdigris.sources.sinks import write_step, write_table


def metadata_from_files(files: DataFrame, label: str = "name", pattern: str = LABEL_PATTERN,
                        scope: str = "basename") -> DataFrame:
    """``binaryFile`` rows -> metadata.  ``label='name'`` takes the class code
    from the file name, ``label='parent'`` the directory name."""
    if label == "name":
        lab = label_from_name("path", pattern, scope)
    elif label == "parent":
        lab = label_from_parent_dir("path")
    else:
        raise ValueError("label must be 'name' or 'parent'")
    return files.select(canonical_path("path", encoded=False).alias("path"), lab.alias("label"),
                        "length", "modificationTime")


def image_metadata(spark: SparkSession, path: str, glob: str | None = None,
                   label: str = "name", pattern: str = LABEL_PATTERN,
                   scope: str = "basename") -> DataFrame:
    files = binary_files(spark, path, glob).select("path", "length", "modificationTime")
    return metadata_from_files(files, label, pattern, scope)


def write_metadata(meta: DataFrame, out: str, fmt: str = "parquet",
                   num_files: int | None = None, **options) -> None:
    """Overwrite the metadata table (any format; a connector is a ``fmt``)."""
    if num_files:
        meta = meta.repartition(num_files)
    write_table(meta, out, fmt=fmt, mode="overwrite", **options)


def append_new(rows: DataFrame, out: str, key: str, order_col: str, step: int, column: str = "step") -> None:
    """Append the rows whose ``key`` no earlier step has written: each key once.

    Of the step's rows with one key that with the smallest ``order_col`` stays;
    rows without a key are left out.  Of what is written only the key column of
    earlier steps is read.  Run again, a step replaces its own rows, so a retry
    neither loses nor repeats any."""
    spark = rows.sparkSession
    new = first_row_per_key(rows, key, order_col)
    schema = new.schema.add(column, "integer")
    try:
        seen = spark.read.schema(schema).parquet(out).where(F.col(column) < step).select(key)
        new = new.join(seen, key, "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # the first step finds no table
            raise
    write_step(new, out, step, column)


def label_counts(meta: DataFrame) -> DataFrame:
    """Label distribution, NULL (unlabelled) included, largest first."""
    return (meta.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.col("n").desc(), F.col("label").asc_nulls_last()))
