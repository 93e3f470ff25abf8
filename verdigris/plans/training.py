"""Train and compare the four classifier presets; evaluate them in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.functions.vectors import to_vector
from verdigris.operators import dataset as D
from verdigris.operators import evaluate as EV
from verdigris.operators import train as TR
from verdigris.operators.partitions import keyed_partitions
from verdigris.plans.registry import ModelRegistry
from verdigris.session import materialize


def as_training_rows(df: DataFrame, features_col: str = "features") -> DataFrame:
    """``array<float>`` features -> vector (JVM), keeping only needed columns."""
    return df.select("path", "label_index", to_vector(features_col).alias("features"))


def train_and_compare(train: DataFrame, test: DataFrame,
                      presets: Sequence[str] = TR.PRESET_ORDER,
                      registry: ModelRegistry | None = None,
                      label_col: str = "label_index", parallel: int = 1,
                      num_partitions: int | None = None) -> tuple[DataFrame, dict]:
    """Fit every preset on ``train``, predict ``test``, and evaluate all models
    in one aggregation grouped by model.

    Presets are fit one after another by default; ``parallel > 1`` submits
    that many fits at once from driver threads (their jobs share the
    cluster, so per-model times then overlap).  Returns (metrics table ordered
    by accuracy, {name: FitResult}).  With a registry, each model is saved
    and its metrics row appended."""
    train = keyed_partitions(train, num_partitions=num_partitions).persist(StorageLevel.MEMORY_AND_DISK)
    test = test.persist(StorageLevel.MEMORY_AND_DISK)

    def fit(name: str) -> TR.FitResult:
        # the rows already are in keyed partitions, as fit_preset would deal them
        return TR.fit_timed(TR.make_pipeline(TR.classifier(name, label_col=label_col)), train, name)

    try:
        D.require_rows(train, "no training rows")
        train.count()
        test.count()
        if parallel > 1:
            from concurrent.futures import ThreadPoolExecutor
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                futures = {n: pool.submit(fit, n)
                           for n in presets}
                fits = {n: f.result() for n, f in futures.items()}
        else:
            fits = {n: fit(n) for n in presets}
        preds = [fits[name].model.transform(test).select(
                     F.lit(name).alias("model"), F.lit(ord_).alias("ord"), label_col, "prediction")
                 for ord_, name in enumerate(presets)]
        all_preds = D.union_all(preds)
        # at most K x K rows a model; written, as two results are made of them
        cells = materialize(EV.confusion_cells(all_preds, label_col, "prediction", ("model", "ord")), "cells")
        metrics = EV.metrics_from_cells(cells, ("model", "ord"), digits=4).join(
            EV.confusion_lists(cells, ("model", "ord")), ["model", "ord"])
        times = train.sparkSession.createDataFrame(
            [(n, f.train_time_sec) for n, f in fits.items()], "model string, train_time_sec double")
        table = metrics.join(times, "model").orderBy(F.col("accuracy").desc(), "ord")
        rows = table.collect()  # one row per model
    finally:
        train.unpersist()
        test.unpersist()
    result = train.sparkSession.createDataFrame(rows, table.schema)
    if registry is not None:
        for r in rows:
            registry.save(r["model"], fits[r["model"]].model, r.asDict(), r["ord"])
    return result, fits
