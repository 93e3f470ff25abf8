"""The whole flow as one function: images -> features -> prepared splits ->
trained, evaluated and registered models.  Each step writes its table, so a
failed run restarts from the last written step's output, not from the images."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from verdigris.operators import pixels as PX
from verdigris.operators import train as TR
from verdigris.operators.evaluate import result_record
from verdigris.plans.featurize import featurize_to
from verdigris.plans.prepare import prepare, read_split, write_prepared
from verdigris.plans.registry import ModelRegistry
from verdigris.plans.training import as_training_rows, train_and_compare
from verdigris.sources.sinks import export_results, write_json_object


@dataclass
class FlowResult:
    metrics: DataFrame
    rejects: DataFrame
    registry: ModelRegistry


def build_and_train(spark: SparkSession, images_dir: str, out_dir: str,
                    size: int = PX.DEFAULT_SIZE, presets=TR.PRESET_ORDER,
                    ratio: float = 0.8, factor: int = 2, seed: int = 42,
                    stratify: bool = False, parallel: int = 1) -> FlowResult:
    """Run every step; outputs under ``out_dir``: ``features/``, ``prepared/``
    (data partitioned by split, label map), ``registry/`` (models + table),
    ``results/`` (metrics as JSON lines), ``results.json`` (one object keyed
    by model name)."""
    out = out_dir.rstrip("/")
    feats, rejects = featurize_to(spark, images_dir, f"{out}/features", size=size,
                                  with_label=True)
    prep = prepare(None, feats, ratio=ratio, factor=factor, seed=seed, stratify=stratify)
    write_prepared(prep, f"{out}/prepared")
    registry = ModelRegistry(spark, f"{out}/registry")
    registry.save_label_map(spark.read.parquet(f"{out}/prepared/label_map"))
    train = as_training_rows(read_split(spark, f"{out}/prepared", "train"))
    test = as_training_rows(read_split(spark, f"{out}/prepared", "test"))
    metrics, _ = train_and_compare(train, test, presets, registry, parallel=parallel)
    export_results(metrics, f"{out}/results", mode="overwrite", fmt="json")
    # one JSON object keyed by model name, in the order of registration
    record = result_record(metrics).select("model", "ord", "accuracy", "precision", "recall", "f1", "confusion_matrix", "train_time_sec")
    write_json_object(record, "model", f"{out}/results.json", order_col="ord")
    return FlowResult(metrics, rejects, registry)
