"""Featurize: a directory of images -> ``path, features array<float>`` plus a
rejects table.  Decoding is the JVM ``image`` source; pixels are one Arrow pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigris.functions.labels import LABEL_PATTERN, label_from_name
from verdigris.functions.paths import canonical_path
from verdigris.operators import pixels as PX
from verdigris.sources.files import image_files
from verdigris.sources.sinks import write_table


def features_from_images(images: DataFrame, size: int = PX.DEFAULT_SIZE,
                         filter: str = "bicubic", image_col: str = "image") -> DataFrame:
    feats = PX.image_features(images, size=size, filter=filter, image_col=image_col,
                              keep_origin="__origin")
    return feats.withColumn("path", canonical_path("__origin")).drop("__origin")


def rejects_from_images(images: DataFrame, image_col: str = "image") -> DataFrame:
    return (PX.image_rejects(images, image_col)
              .select(canonical_path("origin").alias("path"), "reason"))


def featurize_to(spark: SparkSession, path: str, out: str, size: int = PX.DEFAULT_SIZE,
                 filter: str = "bicubic", glob: str | None = None, with_label: bool = False,
                 pattern: str = LABEL_PATTERN) -> tuple[DataFrame, DataFrame]:
    """Decode every image once and write ``path, reason, features[, label]``
    to ``out``; returns (features, rejects) as filters over the written table."""
    images = image_files(spark, path, glob=glob, drop_invalid=False)
    rows = PX.image_features(images, size=size, filter=filter, keep_origin="__origin",
                             with_rejects=True)
    rows = rows.select(canonical_path("__origin").alias("path"), "reason", "features")
    if with_label:
        rows = rows.withColumn("label", label_from_name("path", pattern))
    write_table(rows, out)
    table = spark.read.parquet(out)
    feats = table.where(F.col("reason").isNull()).drop("reason")
    rejects = table.where(F.col("reason").isNotNull()).select("path", "reason")
    return feats, rejects


def featurize(spark: SparkSession, path: str, size: int = PX.DEFAULT_SIZE,
              filter: str = "bicubic", glob: str | None = None, with_label: bool = False,
              pattern: str = LABEL_PATTERN) -> tuple[DataFrame, DataFrame]:
    """(features, rejects) for every file under ``path``; lazily planned.

    ``with_label=True`` adds ``label`` from the file name in the same narrow
    pass, so ``prepare(None, features)`` needs no metadata join."""
    images = image_files(spark, path, glob=glob, drop_invalid=False)
    feats = features_from_images(images, size, filter).select("path", "features")
    if with_label:
        feats = feats.withColumn("label", label_from_name("path", pattern))
    return feats, rejects_from_images(images)


def write_features(feats: DataFrame, out: str) -> DataFrame:
    write_table(feats, out)
    return feats.sparkSession.read.parquet(out)


def features_minmax_check(feats: DataFrame) -> DataFrame:
    """Sanity: every feature value lies in [0, 1] (one aggregation)."""
    return feats.agg(F.min(F.array_min("features")).alias("min_value"),
                     F.max(F.array_max("features")).alias("max_value"),
                     F.sum(F.size("features")).alias("values"))
