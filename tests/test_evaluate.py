import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from verdigris.operators import evaluate as EV

# (prediction, label) pairs with off-truth predictions
PAIRS = [(0.0, 0.0), (2.0, 0.0), (0.0, 1.0), (1.0, 1.0), (5.0, 3.0)]


@pytest.fixture()
def pred(spark):
    return spark.createDataFrame(PAIRS, "prediction double, label_index double")


def test_weighted_metrics_match_known_values_and_mllib(pred):
    m = EV.evaluate(pred).first().asDict()
    assert m["accuracy"] == pytest.approx(0.4)
    assert m["weighted_precision"] == pytest.approx(0.6)
    assert m["weighted_recall"] == pytest.approx(0.4)
    assert m["weighted_f1"] == pytest.approx(0.466667, abs=1e-6)
    ev = MulticlassClassificationEvaluator(labelCol="label_index", predictionCol="prediction")
    for ours, theirs in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                         ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")):
        assert m[ours] == pytest.approx(ev.evaluate(pred, {ev.metricName: theirs}), abs=1e-6)


def test_cells_sum_to_rows_and_truth_only_matches_reference_matrix(pred):
    cells = EV.confusion_cells(pred)
    assert sum(r["n"] for r in cells.collect()) == len(PAIRS)
    # the reference's matrix: axes are the truth classes 0, 1, 3
    t = {(r["label"], r["prediction"]): r["n"] for r in EV.confusion_cells(pred, truth_only=True).collect()}
    assert t == {(0.0, 0.0): 1, (1.0, 0.0): 1, (1.0, 1.0): 1}


def test_pivot_fills_zeros(pred):
    wide = EV.confusion_pivot(EV.confusion_cells(pred)).collect()
    assert [r["label"] for r in wide] == [0.0, 1.0, 3.0]
    assert wide[2]["5.0"] == 1 and wide[2]["0.0"] == 0


def test_best_model_ties_go_to_first_registered(spark):
    m = spark.createDataFrame([("LR", 0, 0.2143), ("DT", 1, 0.2143), ("NB", 3, 0.0714)],
                              "model string, ord int, accuracy double")
    assert EV.best_model(m).first()["model"] == "LR"


def test_grouped_evaluation_is_one_pass_per_model(spark):
    rows = [("a", 1.0, 1.0), ("a", 0.0, 1.0), ("b", 1.0, 1.0), ("b", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "model string, prediction double, label_index double")
    out = {r["model"]: r["accuracy"] for r in EV.evaluate(df, group_cols=("model",)).collect()}
    assert out == {"a": 0.5, "b": 1.0}


def test_confusion_lists_reference_layout(pred):
    # truth classes 0, 1, 3; the prediction of class 5 falls outside the axes
    full = EV.confusion_lists(EV.confusion_cells(pred)).first()
    assert sum(map(sum, full["confusion_matrix"])) == pred.count()
    r = EV.confusion_lists(EV.confusion_cells(pred), truth_only=True).first()
    assert r["classes"] == [0.0, 1.0, 3.0]
    assert r["confusion_matrix"] == [[1, 0, 0], [1, 1, 0], [0, 0, 0]]


def test_mixed_label_and_prediction_types(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 1.0), (0, 0.0)], "label_index int, prediction double")
    m = EV.evaluate(df).first()
    assert m["accuracy"] == pytest.approx(2 / 3, abs=1e-6)
    per = {r["label"]: r["recall"] for r in EV.per_class_metrics(EV.confusion_cells(df)).collect()}
    assert per == {0.0: 0.5, 1.0: 1.0}
