"""Classifier presets and the training pipeline.

The four classifiers and their parameters are the reference's; the pipeline
is [min-max, (clip), standard, classifier], fit on training rows only.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame, SparkSession

from verdigris.operators.features import UnitClip, minmax_stage, standard_stage

# --- fixed values: classifier presets (names and parameters) --------------
LOGISTIC_REGRESSION = "Logistic Regression"
DECISION_TREE = "Decision Tree"
RANDOM_FOREST = "Random Forest"
NAIVE_BAYES = "Naive Bayes"
PRESET_PARAMS = {
    LOGISTIC_REGRESSION: dict(maxIter=50, regParam=0.1, elasticNetParam=0.0, family="multinomial"),
    DECISION_TREE: dict(maxDepth=8, maxBins=32, impurity="gini", seed=42),
    RANDOM_FOREST: dict(numTrees=20, maxDepth=5, maxBins=32, seed=42),
    NAIVE_BAYES: dict(smoothing=1.0, modelType="multinomial"),
}
# logistic regression as used by the partition sweep
SWEEP_LR_PARAMS = dict(maxIter=20, regParam=0.1, family="multinomial")
PRESET_ORDER = (LOGISTIC_REGRESSION, DECISION_TREE, RANDOM_FOREST, NAIVE_BAYES)
# ---------------------------------------------------------------------------

_CLASSES = {
    LOGISTIC_REGRESSION: LogisticRegression,
    DECISION_TREE: DecisionTreeClassifier,
    RANDOM_FOREST: RandomForestClassifier,
    NAIVE_BAYES: NaiveBayes,
}


def classifier(name: str, features_col: str = "scaled_features",
               label_col: str = "label_index", **overrides):
    """A preset classifier by name; ``overrides`` replace preset parameters."""
    params = {**PRESET_PARAMS[name], **overrides}
    return _CLASSES[name](featuresCol=features_col, labelCol=label_col, **params)


def make_pipeline(clf, input_col: str = "features", scale: bool = True) -> Pipeline:
    """[min-max, standard, classifier]; Naive Bayes also gets a [0, 1] clip."""
    if not scale:
        clf.setFeaturesCol(input_col)
        return Pipeline(stages=[clf])
    stages = [minmax_stage(input_col, "features_mm")]
    std_in = "features_mm"
    if isinstance(clf, NaiveBayes):
        stages.append(UnitClip(inputCol="features_mm", outputCol="features_clip"))
        std_in = "features_clip"
    stages.append(standard_stage(std_in, "scaled_features"))
    clf.setFeaturesCol("scaled_features")
    stages.append(clf)
    return Pipeline(stages=stages)


@dataclass
class FitResult:
    name: str
    model: PipelineModel
    train_time_sec: float
    num_partitions: int | None = None  # that the training rows were dealt into


def fit_timed(pipeline: Pipeline, train: DataFrame, name: str = "model") -> FitResult:
    """Fit and time the pipeline (the caller materialises ``train`` first so
    load time is not counted)."""
    t0 = time.perf_counter()
    model = pipeline.fit(train)
    took = round(time.perf_counter() - t0, 2)
    return FitResult(name, without_summaries(model, train.sparkSession), took)


def without_summaries(model: Model, spark: SparkSession) -> Model:
    for stage in getattr(model, "stages", [model]):
        if getattr(stage, "hasSummary", False):
            # a two-class summary holds the session, which cannot be sent to tasks once a write was observed
            stage._java_obj.setSummary(spark._jvm.scala.Option.empty())
    return model


def fit_preset(name: str, train: DataFrame, input_col: str = "features",
               label_col: str = "label_index", scale: bool = True,
               num_partitions: int | None = None, **overrides) -> FitResult:
    """Fit a preset pipeline.  The rows are dealt into ``num_partitions`` by
    their values (see ``keyed_partitions``), so a model depends on the rows and
    the parameters only; they are persisted for the passes of the fit and
    released afterwards."""
    from pyspark import StorageLevel

    from verdigris.operators.partitions import keyed_partitions, partitions_for
    clf = classifier(name, label_col=label_col, **overrides)
    n = num_partitions or partitions_for(train, input_col)
    rows = keyed_partitions(train, input_col, n).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fit = fit_timed(make_pipeline(clf, input_col, scale), rows, name)
        fit.num_partitions = n
        return fit
    finally:
        rows.unpersist()
