"""Scoring: images (any number, batch or stream) -> class name, index, confidence."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.functions.paths import canonical_path
from verdigris.functions.vectors import to_vector
from verdigris.operators import decode as DEC
from verdigris.operators import pixels as PX

PREDICTED = ("prediction_label", "class_index", "confidence")


def score_features(feats: DataFrame, model: PipelineModel, label_map: DataFrame,
                   model_name: str, features_col: str = "features") -> DataFrame:
    """Rows with ``features array<float>`` -> predictions with decoded labels."""
    vec = feats.withColumn(features_col, to_vector(features_col))
    pred = model.transform(vec)
    pred = DEC.decode_prediction(pred, label_map)
    pred = DEC.add_confidence(pred)
    return pred.withColumn("model_used", F.lit(model_name))


def score_images(images: DataFrame, model: PipelineModel, label_map: DataFrame,
                 model_name: str, size: int = PX.DEFAULT_SIZE, filter: str = "bicubic",
                 image_col: str = "image", keep: tuple[str, ...] = (),
                 include_rejects: bool = False) -> DataFrame:
    """Image structs -> ``path, prediction_label, class_index, confidence,
    model_used`` (plus ``keep`` columns).  Same plan for batch and streaming.

    Unreadable images are left out, or with ``include_rejects=True`` returned
    with NULL predictions and a ``reason``; either way every image is decoded
    once (a reject passes the model as a black image, and its prediction is
    dropped)."""
    feats = PX.image_features(images.select(*keep, image_col), size=size, filter=filter,
                              image_col=image_col, keep_origin="__origin",
                              with_rejects=include_rejects)
    feats = feats.withColumn("path", canonical_path("__origin")).drop("__origin")
    if include_rejects:
        black = F.array_repeat(F.lit(0.0).cast("float"), size * size)
        feats = feats.withColumn("features", F.coalesce("features", black))
    scored = score_features(feats, model, label_map, model_name)
    if not include_rejects:
        return scored.select(*keep, "path", *PREDICTED, "model_used")
    valid = F.col("reason").isNull()
    return scored.select(*keep, "path", *[F.when(valid, F.col(c)).alias(c) for c in PREDICTED],
                         "model_used", "reason")
