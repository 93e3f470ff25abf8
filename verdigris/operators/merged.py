"""Fitted statistics as tables that merge: scaler state and naive Bayes counts.

Every partition is reduced to one row of sums in one pass; rows are merged in a tree,
a few dozen a task, and the result is a table to store.  Statistics of old and new rows
merge into those of all rows, so a model follows arriving rows without reading the old
ones again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigris.functions.vectors import to_array
from verdigris.session import materialize

FAN_IN = 64
SCALER_STATE = "part long, n long, lo array<double>, hi array<double>, mean array<double>, m2 array<double>"
NB_STATE = "part long, label double, n long, sums array<double>"


def _rows(df: DataFrame, features_col: str, *more: str) -> DataFrame:
    """``more`` columns and the features as ``x array<double>``, of rows that have features."""
    vector = not isinstance(df.schema[features_col].dataType, T.ArrayType)
    x = to_array(features_col) if vector else F.col(features_col).cast("array<double>")
    return df.where(F.col(features_col).isNotNull()).select(*more, x.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch["x"]
    flat = x.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(x), -1)


def _merge_in_tree(states: DataFrame, keys: list[str], merge: Callable[[pa.Table], dict], schema: str) -> DataFrame:
    """One row per key: rows are merged ``FAN_IN`` by ``FAN_IN``, each level written."""
    names = [f.name for f in T._parse_datatype_string(schema).fields]

    def level(table: pa.Table) -> pa.Table:
        row = merge(table) | {k: table[k][0].as_py() for k in ["part", *keys]}
        return pa.Table.from_pydict({c: pa.array([row[c]], table.schema.field(c).type) for c in names})

    while True:
        states = materialize(states.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long"))
                                   .groupBy(*keys, "part").applyInArrow(level, schema), "merged_state")
        if (states.agg(F.max("part")).first()[0] or 0) == 0:
            return states


def _moments(parts: Iterator[tuple]) -> tuple:
    """(n, lo, hi, mean, m2) of all of them, merged pairwise without cancellation."""
    out = None
    for n, lo, hi, mean, m2 in parts:
        if out is None:
            out = (n, lo, hi, mean, m2)
            continue
        n0, lo0, hi0, mean0, m20 = out
        total, apart = n0 + n, mean - mean0
        out = (total, np.minimum(lo0, lo), np.maximum(hi0, hi), mean0 + apart * (n / total),
               m20 + m2 + apart * apart * (n0 * n / total))
    return out


def scaler_state(df: DataFrame, features_col: str = "features") -> DataFrame:
    """One row ``n, lo, hi, mean, m2`` (arrays over the features) of a vector or array column, in one pass.

    Rows without features are left out; a table without rows gives no row.  Minimum, maximum and
    sample variance ``m2 / (n - 1)`` of every feature, and so both scalers, follow from it: the
    standard deviation after min-max scaling is that before, divided by the range."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def parts():
            for x in map(_matrix, batches):
                if len(x):
                    mean = x.mean(axis=0)
                    yield len(x), x.min(axis=0), x.max(axis=0), mean, ((x - mean) ** 2).sum(axis=0)

        out = _moments(parts())
        if out is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out[0]], pa.int64()),
                 *[pa.array([v.tolist()], pa.list_(pa.float64())) for v in out[1:]]], ["part", "n", "lo", "hi", "mean", "m2"])

    return merge_scaler_states(_rows(df, features_col).mapInArrow(reduce, SCALER_STATE))


def merge_scaler_states(*states: DataFrame) -> DataFrame:
    """The state of all rows from states of parts of them."""
    def merge(table: pa.Table) -> dict:
        rows = table.to_pylist()
        values = _moments((r["n"], *[np.array(r[c]) for c in ("lo", "hi", "mean", "m2")]) for r in rows)
        return dict(zip(("n", "lo", "hi", "mean", "m2"), (values[0], *[v.tolist() for v in values[1:]])))

    return _merge_in_tree(_together(states), [], merge, SCALER_STATE)


def _together(states: tuple[DataFrame, ...]) -> DataFrame:
    """All rows, their ``part`` numbers interleaved."""
    out = states[0]
    for i, s in enumerate(states[1:], 1):
        out = out.withColumn("part", F.col("part") * 2).unionByName(s.withColumn("part", F.col("part") * 2 + 1))
    return out


@dataclass
class Scaling:
    """Minimum, range and sample std of every feature (4 numbers a feature on the driver)."""
    lo: np.ndarray
    span: np.ndarray
    std: np.ndarray

    @classmethod
    def of(cls, state: DataFrame) -> Scaling:
        r = state.first()
        if r is None:
            raise ValueError("the state has no rows: nothing was fitted")
        lo, hi, m2 = (np.array(r[c]) for c in ("lo", "hi", "m2"))
        std = np.sqrt(m2 / (r["n"] - 1)) if r["n"] > 1 else np.zeros(len(lo))
        return cls(lo, hi - lo, np.where(hi > lo, std, 0.0))

    def minmax(self, x: np.ndarray, clip: bool = False) -> np.ndarray:
        """To [0, 1] by the fitted range; a constant feature gives 0.5."""
        fits = self.span > 0
        out = np.where(fits, (x - self.lo) / np.where(fits, self.span, 1.0), 0.5)
        return np.clip(out, 0.0, 1.0) if clip else out

    def standard_after_minmax(self, x: np.ndarray, clip: bool = False) -> np.ndarray:
        """Min-max, then by the std that the fitted rows have after it; a constant feature gives 0."""
        fits = self.std > 0
        return np.where(fits, self.minmax(x, clip) * self.span / np.where(fits, self.std, 1.0), 0.0)


def scale_by_state(df: DataFrame, state: DataFrame, features_col: str = "features", method: str = "both",
                   clip: bool = False, out_col: str = "scaled_features") -> DataFrame:
    """Add ``out_col``: the features scaled by a stored state (``method``: ``minmax`` or ``both`` scalers)."""
    if method not in ("minmax", "both"):
        raise ValueError("method must be 'minmax' or 'both'")
    scaling = Scaling.of(state)
    rest = [c for c in df.columns if c != out_col]
    source = _rows(df, features_col, *rest)
    schema = T.StructType([*source.select(*rest).schema.fields, T.StructField(out_col, T.ArrayType(T.DoubleType()))])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b)
            y = scaling.minmax(x, clip) if method == "minmax" else scaling.standard_after_minmax(x, clip)
            lists = pa.ListArray.from_arrays(np.arange(0, y.size + 1, max(1, y.shape[1]), dtype=np.int32)[:len(y) + 1], y.reshape(-1))
            yield pa.RecordBatch.from_arrays([*[b[c] for c in rest], lists], [*rest, out_col])

    return source.mapInArrow(apply, schema)


# ------------------------------------------------------------- naive Bayes ----

def nb_statistics(df: DataFrame, features_col: str = "features", label_col: str = "label_index") -> DataFrame:
    """Per class ``label, n, sums``: the rows and the unscaled feature sums of multinomial naive Bayes.

    Rows without label or features are left out."""
    labelled = df.where(F.col(label_col).isNotNull()).withColumn("__label", F.col(label_col).cast("double"))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held: dict[float, list] = {}
        for b in batches:
            x, labels = _matrix(b), b["__label"].to_numpy(zero_copy_only=False)
            for c in np.unique(labels):
                own = x[labels == c]
                n, sums = held.get(c, (0, 0.0))
                held[c] = (n + len(own), sums + own.sum(axis=0))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part] * len(held), pa.int64()), pa.array(held.keys(), pa.float64()), pa.array([n for n, _ in held.values()], pa.int64()),
             pa.array([s.tolist() for _, s in held.values()], pa.list_(pa.float64()))], ["part", "label", "n", "sums"])

    return merge_nb_statistics(_rows(labelled, features_col, "__label").mapInArrow(reduce, NB_STATE))


def merge_nb_statistics(*states: DataFrame) -> DataFrame:
    """The statistics of all rows from those of parts of them."""
    def merge(table: pa.Table) -> dict:
        rows = table.to_pylist()
        return {"n": sum(r["n"] for r in rows), "sums": np.sum([r["sums"] for r in rows], axis=0).tolist()}

    return _merge_in_tree(_together(states), ["label"], merge, NB_STATE)


@dataclass
class NaiveBayesModel:
    """Class labels in ascending order, log priors and log feature shares (K x F numbers)."""
    labels: np.ndarray
    prior: np.ndarray
    theta: np.ndarray
    scaling: Scaling


def nb_model(statistics: DataFrame, state: DataFrame, smoothing: float = 1.0) -> NaiveBayesModel:
    """Multinomial naive Bayes over min-max scaled features, from statistics of the unscaled ones.

    Scaling is affine, so the scaled sums follow from the sums, the class counts and the scaler
    state: when new rows widen a range, old rows are not read again."""
    rows = sorted(statistics.collect(), key=lambda r: r["label"])  # one row per class
    scaling = Scaling.of(state)
    n = np.array([r["n"] for r in rows], dtype=np.float64)
    fits = scaling.span > 0
    sums = np.array([r["sums"] for r in rows])
    scaled = np.where(fits, (sums - n[:, None] * scaling.lo) / np.where(fits, scaling.span, 1.0), 0.5 * n[:, None])
    theta = np.log(scaled + smoothing) - np.log(scaled.sum(axis=1, keepdims=True) + smoothing * scaled.shape[1])
    prior = np.log(n + smoothing) - np.log(n.sum() + smoothing * len(n))
    return NaiveBayesModel(np.array([r["label"] for r in rows]), prior, theta, scaling)


def nb_predict(df: DataFrame, model: NaiveBayesModel, keep: list[str], features_col: str = "features") -> DataFrame:
    """The ``keep`` columns with ``prediction`` (ties: the smaller label) and ``confidence`` in percent."""
    source = _rows(df, features_col, *keep)
    schema = T.StructType([*source.select(*keep).schema.fields, T.StructField("prediction", T.DoubleType()),
                           T.StructField("confidence", T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = model.scaling.minmax(_matrix(b), clip=True) @ model.theta.T + model.prior
            best = raw.max(axis=1) if len(raw) else np.empty(0)
            share = 1.0 / np.exp(raw - best[:, None]).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*[b[c] for c in keep], pa.array(model.labels[raw.argmax(axis=1)]), pa.array(np.round(100.0 * share, 1))],
                [*keep, "prediction", "confidence"])

    return source.mapInArrow(predict, schema)
