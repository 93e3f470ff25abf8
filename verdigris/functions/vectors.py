"""Vector <-> array helpers (MLlib's JVM functions, no Python UDF)."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def to_vector(c: str | Column) -> Column:
    """array<float|double> -> dense VectorUDT (JVM-side)."""
    return array_to_vector(F.col(c) if isinstance(c, str) else c)


def to_array(c: str | Column, dtype: str = "float64") -> Column:
    """VectorUDT -> array<double> (or array<float> with dtype='float32')."""
    return vector_to_array(F.col(c) if isinstance(c, str) else c, dtype)


def confidence_pct(probability: str | Column, digits: int = 1) -> Column:
    """Highest class probability in percent, rounded; NULL when the model gives
    no probability column value."""
    return F.round(F.array_max(to_array(probability)) * 100.0, digits)
