"""Model registry: saved pipelines plus a registry table of their metrics.

Layout under ``root``: ``models/<Name_With_Underscores>/`` (PipelineModel),
``registry/`` (Parquet, one row per saved model, appended), ``label_map/``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigris.functions.labels import normalise_name_py
from verdigris.operators.evaluate import best_model

REGISTRY_SCHEMA = T.StructType([
    T.StructField("model", T.StringType(), False),
    T.StructField("model_key", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("ord", T.IntegerType(), False),
    T.StructField("accuracy", T.DoubleType(), True),
    T.StructField("weighted_precision", T.DoubleType(), True),
    T.StructField("weighted_recall", T.DoubleType(), True),
    T.StructField("weighted_f1", T.DoubleType(), True),
    T.StructField("train_time_sec", T.DoubleType(), True),
    T.StructField("saved_at", T.TimestampType(), False),
])


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def model_path(self, name: str) -> str:
        return f"{self.root}/models/{normalise_name_py(name)}"

    def save(self, name: str, model: PipelineModel, metrics: dict, ord: int = 0) -> None:
        """Save the pipeline (overwrite) and append its registry row."""
        path = self.model_path(name)
        model.write().overwrite().save(path)
        row = (name, normalise_name_py(name), path, int(ord),
               *(metrics.get(k) for k in ("accuracy", "weighted_precision",
                                          "weighted_recall", "weighted_f1", "train_time_sec")),
               dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        self.spark.createDataFrame([row], REGISTRY_SCHEMA).write.mode("append") \
            .parquet(f"{self.root}/registry")

    def table(self) -> DataFrame:
        """Latest registry row per model."""
        reg = self.spark.read.schema(REGISTRY_SCHEMA).parquet(f"{self.root}/registry")
        latest = reg.groupBy("model_key").agg(F.max("saved_at").alias("saved_at"))
        return reg.join(latest, ["model_key", "saved_at"], "left_semi")

    def list(self) -> list[str]:
        """Model keys available for scoring (bounded by the number of models)."""
        return sorted(r[0] for r in self.table().select("model_key").collect())

    def load(self, name: str) -> PipelineModel:
        return PipelineModel.load(self.model_path(name))

    def best(self) -> DataFrame:
        """Best model by accuracy; ties go to the earliest registered."""
        return best_model(self.table(), "accuracy", "ord")

    def save_label_map(self, label_map: DataFrame) -> None:
        label_map.write.mode("overwrite").parquet(f"{self.root}/label_map")

    def label_map(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/label_map")
