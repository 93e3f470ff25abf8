"""Prediction decoding: class index -> class name, confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.functions.vectors import confidence_pct


def decode_prediction(pred: DataFrame, label_map: DataFrame, pred_col: str = "prediction",
                      index_col: str = "label_index", name_col: str = "label",
                      out_label: str = "prediction_label",
                      out_index: str = "class_index") -> DataFrame:
    """Add ``class_index`` (the integer index as text) and the class name; an
    index missing from ``label_map`` decodes to ``class_<index>``.

    ``label_map`` has one row per class; Spark broadcasts it if its size allows."""
    idx = F.col(pred_col).cast("int")
    m = label_map.select(F.col(index_col).cast("int").alias("__idx"),
                         F.col(name_col).alias("__name"))
    out = pred.withColumn("__idx", idx).join(m, "__idx", "left")
    return (out.withColumn(out_index, F.col("__idx").cast("string"))
               .withColumn(out_label, F.coalesce(F.col("__name"),
                                                 F.concat(F.lit("class_"), F.col(out_index))))
               .drop("__idx", "__name"))


def add_confidence(pred: DataFrame, probability_col: str = "probability",
                   out_col: str = "confidence") -> DataFrame:
    """Highest class probability × 100, one decimal; NULL without probabilities."""
    if probability_col not in pred.columns:
        return pred.withColumn(out_col, F.lit(None).cast("double"))
    return pred.withColumn(out_col, confidence_pct(probability_col))
