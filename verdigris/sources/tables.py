"""Table sources: any Spark format by name, literal rows, JSON side inputs."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None,
               columns: Iterable[str] | None = None, **options) -> DataFrame:
    """Read a table by path (any ``format``) or a catalog name (``fmt='table'``).

    A declared ``schema`` avoids inference; ``columns`` prunes at the scan.
    A document-store or JDBC connector is only another ``fmt`` plus options.
    """
    if fmt == "table":
        df = spark.table(path_or_name)
    else:
        reader = spark.read.format(fmt).options(**options)
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.load(path_or_name)
    if columns is not None:
        df = df.select(*columns)
    return df


def rows_table(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """Literal rows (any number) with a declared schema."""
    return spark.createDataFrame(list(rows), schema=schema)


def json_table(spark: SparkSession, path: str, multiline: bool = True,
               schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON side input (label map, results) as a small table."""
    reader = spark.read.option("multiLine", str(multiline).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def map_table(spark: SparkSession, mapping: Mapping[str, str],
              key: str = "label_index", value: str = "label") -> DataFrame:
    """A ``{index: name}`` JSON object (as written by ``write_json_map``) as rows."""
    return spark.createDataFrame(
        [(float(k), v) for k, v in mapping.items()],
        T.StructType([T.StructField(key, T.DoubleType(), False),
                      T.StructField(value, T.StringType(), True)]))


def json_rows(spark: SparkSession, path: str, value_type: str = "string",
              key: str = "key", value: str = "value") -> DataFrame:
    """The entries of a JSON object ``{key: value, ...}`` as rows ``pos, key, value``.

    ``value_type`` is the values' SQL type: ``string`` for a label map, a
    ``struct<...>`` for results (its fields then become columns).  ``pos`` is
    the entry's place in the file.  A file with no object gives no rows."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.from_json("value", f"map<string,{value_type}>").alias("m"))
    rows = entries.select(F.posexplode("m").alias("pos", key, value))
    return rows.select("pos", key, f"{value}.*") if value_type.lower().startswith("struct") else rows


def label_map_rows(spark: SparkSession, path: str) -> DataFrame:
    """A label map ``{"0": "name", ...}`` as ``label_index double, label``."""
    rows = json_rows(spark, path, "string", "k", "label")
    return rows.select(F.col("k").cast("double").alias("label_index"), "label")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` buckets of ``key``, sorted, and return the table.

    Tables bucketed alike by their join key are joined, or aggregated by it, without a
    shuffle.  The catalog knows the table as ``name`` (by default one of its own); rows are
    dealt into buckets once, so each bucket of a step is one file."""
    name = name or f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)
