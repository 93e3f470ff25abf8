"""Feature scaling stages (MLlib estimators) and column-level helpers.

Vectors stay in MLlib's ``VectorUDT``; conversions use the JVM functions
``array_to_vector`` / ``vector_to_array`` (no Python UDF).  Every scaler is fit
on training rows only and travels inside the saved pipeline, so scoring applies
exactly the fitted preprocessing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import MinMaxScaler, StandardScaler
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.functions.vectors import to_array, to_vector


def minmax_stage(input_col: str = "features", output_col: str = "features_mm") -> MinMaxScaler:
    """Per-feature (x - min) / (max - min) to [0, 1]; a constant feature maps to 0.5."""
    return MinMaxScaler(inputCol=input_col, outputCol=output_col, min=0.0, max=1.0)


def standard_stage(input_col: str = "features_mm",
                   output_col: str = "scaled_features") -> StandardScaler:
    """x / sample std per feature (no centring, so sparsity and sign are kept);
    a constant feature maps to 0.0."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=False, withStd=True)


class UnitClip(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Clamp every vector component to [0, 1] (JVM expressions only).

    Min-max statistics come from training rows, so unseen rows can fall
    slightly outside [0, 1]; multinomial Naive Bayes rejects negative input."""

    @keyword_only
    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        arr = to_array(self.getInputCol())
        clipped = F.transform(arr, lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))
        return dataset.withColumn(self.getOutputCol(), to_vector(clipped))


def scale_columns(df: DataFrame, cols: Sequence[str], method: str = "minmax",
                  suffix: str | None = None, digits: int | None = 6) -> DataFrame:
    """Scale numeric columns with the scalers' rules (min-max: constant -> 0.5;
    standard: x / sample std, constant -> 0.0).

    One codegen'd aggregation computes the 2 x F statistics (the only values
    that reach the driver); the transform is plain column arithmetic on
    literals, so it stays inside whole-stage codegen.  Vector columns use the
    MLlib stages above instead."""
    if method not in ("minmax", "standard"):
        raise ValueError("method must be 'minmax' or 'standard'")
    suffix = suffix or ("_mm" if method == "minmax" else "_std")
    if method == "minmax":
        aggs = [f(F.col(c)).alias(f"{k}{i}") for i, c in enumerate(cols)
                for k, f in (("lo", F.min), ("hi", F.max))]
    else:
        aggs = [F.stddev_samp(F.col(c)).alias(f"sd{i}") for i, c in enumerate(cols)]
    stats = df.agg(*aggs).first()
    out = df
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        if method == "minmax":
            lo, hi = stats[f"lo{i}"], stats[f"hi{i}"]
            v = (F.lit(0.5) if lo is None or hi == lo
                 else (x - F.lit(float(lo))) / F.lit(float(hi) - float(lo)))
        else:
            sd = stats[f"sd{i}"]
            v = F.lit(0.0) if not sd else x / F.lit(float(sd))
        v = F.when(F.col(c).isNull(), F.lit(None)).otherwise(v)
        out = out.withColumn(f"{c}{suffix}", F.round(v, digits) if digits is not None else v)
    return out
