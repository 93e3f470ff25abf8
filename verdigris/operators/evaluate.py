"""Evaluation from one aggregation: predictions -> confusion cells -> metrics.

The cell table (one row per (truth, prediction) pair that occurs, at most K^2
per group) is the only thing computed over prediction rows; accuracy and the
weighted precision / recall / F1 are arithmetic over it.  ``group_cols`` lets
many models be evaluated in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion_cells(pred: DataFrame, label_col: str = "label_index",
                    pred_col: str = "prediction", group_cols: Sequence[str] = (),
                    truth_only: bool = False) -> DataFrame:
    """``[group..., label, prediction, n]`` for every pair that occurs.

    The cells sum to the number of prediction rows.  ``truth_only=True``
    drops predictions of classes absent from the truth (the matrix of the
    reference, whose axes are the test-truth classes)."""
    g = list(group_cols)
    cells = (pred.groupBy(*g, F.col(label_col).alias("label"), F.col(pred_col).alias("prediction"))
                 .agg(F.count(F.lit(1)).alias("n")))
    if truth_only:
        truth = cells.select(*g, F.col("label").alias("prediction")).distinct()
        cells = cells.join(truth, [*g, "prediction"], "left_semi")
    return cells


def confusion_pivot(cells: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Wide matrix: one row per truth class, one column per predicted class, zeros filled."""
    return (cells.groupBy(*group_cols, "label").pivot("prediction").agg(F.sum("n"))
                 .na.fill(0).orderBy(*group_cols, "label"))


def confusion_lists(cells: DataFrame, group_cols: Sequence[str] = (),
                    truth_only: bool = False) -> DataFrame:
    """Per group, the dense matrix as ``array<array<bigint>>`` over all classes
    that occur as truth or prediction, in ascending order (rows = truth,
    columns = prediction; it sums to the number of rows), plus ``classes``.
    ``truth_only=True`` keeps the truth classes only and drops other
    predictions — the layout of the reference's results export.  Built with array functions over the K classes of each
    group; nothing larger than K x K is formed."""
    g = list(group_cols)
    if not g:
        cells, g = cells.withColumn("__all", F.lit(0)), ["__all"]
    axes = F.collect_set("label") if truth_only else F.array_union(F.collect_set("label"), F.collect_set("prediction"))
    truth = cells.groupBy(*g).agg(F.array_sort(axes).alias("classes"))
    known = (cells.groupBy(*g, "label")
                  .agg(F.map_from_entries(F.collect_list(F.struct("prediction", "n"))).alias("m")))
    rows = truth.withColumn("label", F.explode("classes")).join(known, [*g, "label"], "left")
    rows = rows.select(*g, "label", "classes", F.transform(
        "classes", lambda c: F.coalesce(F.element_at("m", c), F.lit(0).cast("long"))).alias("row"))
    out = (rows.groupBy(*g, "classes")
               .agg(F.array_sort(F.collect_list(F.struct("label", "row"))).alias("rs"))
               .select(*g, "classes", F.transform("rs", lambda r: r["row"]).alias("confusion_matrix")))
    return out.drop("__all")


def confusion_grid(cells: DataFrame, label_map: DataFrame, group_cols: Sequence[str] = (), index_col: str = "label_index",
                   name_col: str = "label") -> DataFrame:
    """Per group, the dense matrix over every class of ``label_map`` in index order, zeros included, and the names ``classes``.

    Classes that no row has as truth or prediction keep their row and column; cells of classes that the map lacks are left
    out.  The map has one row per class, and at most K x K cells of a group are put in order."""
    g = list(group_cols)
    if not g:
        cells, g = cells.withColumn("__all", F.lit(0)), ["__all"]
    axis = label_map.agg(F.array_sort(F.collect_list(F.struct(F.col(index_col).cast("double").alias("i"), F.col(name_col).alias("name")))).alias("axis"))
    key = lambda truth, pred: F.concat_ws("|", truth.cast("double").cast("string"), pred.cast("double").cast("string"))
    known = cells.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct(key(F.col("label"), F.col("prediction")), "n"))).alias("m"))
    axes = axis.first()["axis"]  # one entry per class
    order = F.array(*[F.lit(r["i"]) for r in axes]) if axes else F.array().cast("array<double>")
    matrix = F.transform(order, lambda t: F.transform(order, lambda p: F.coalesce(F.element_at("m", key(t, p)), F.lit(0).cast("long"))))
    names = F.array(*[F.lit(r["name"]) for r in axes]) if axes else F.array().cast("array<string>")
    return known.select(*g, names.alias("classes"), matrix.alias("confusion_matrix")).drop("__all")


def per_class_metrics(cells: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per truth class: ``n_true, n_pred, hits, precision, recall, f1``.

    Every cell counts once for its truth class (``n_true``, ``hits``) and
    once for its predicted class (``n_pred``): one expand + aggregation over
    the cells, no join.  Classes that are predicted but never true carry no
    weight and are left out."""
    g = list(group_cols)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    # truth and prediction may come with different numeric types (int label,
    # double prediction): the class is compared as double
    sides = F.explode(F.array(
        F.struct(F.col("label").cast("double").alias("cls"), F.col("n").alias("t"),
                 hit.alias("h"), zero.alias("p")),
        F.struct(F.col("prediction").cast("double").alias("cls"), zero.alias("t"),
                 zero.alias("h"), F.col("n").alias("p"))))
    per = (cells.select(*g, sides.alias("s"))
                .groupBy(*g, F.col("s.cls").alias("label"))
                .agg(F.sum("s.t").alias("n_true"), F.sum("s.p").alias("n_pred"),
                     F.sum("s.h").alias("hits"))
                .where(F.col("n_true") > 0))
    precision = F.when(F.col("n_pred") == 0, F.lit(0.0)).otherwise(F.col("hits") / F.col("n_pred"))
    recall = F.col("hits") / F.col("n_true")
    per = per.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
    return per.withColumn("f1", f1)


def metrics_from_cells(cells: DataFrame, group_cols: Sequence[str] = (),
                       digits: int | None = 6) -> DataFrame:
    """One row per group: ``accuracy, weighted_precision, weighted_recall,
    weighted_f1`` (weights = truth share; a class never predicted has
    precision 0).  Weighted recall equals accuracy by definition."""
    g = list(group_cols)
    per = per_class_metrics(cells, g)
    total = F.sum("n_true")

    def r(c):
        return F.round(c, digits) if digits is not None else c

    return per.groupBy(*g).agg(
        r(F.sum("hits") / total).alias("accuracy"),
        r(F.sum(F.col("n_true") * F.col("precision")) / total).alias("weighted_precision"),
        r(F.sum(F.col("n_true") * F.col("recall")) / total).alias("weighted_recall"),
        r(F.sum(F.col("n_true") * F.col("f1")) / total).alias("weighted_f1"),
    )


def evaluate(pred: DataFrame, label_col: str = "label_index", pred_col: str = "prediction",
             group_cols: Sequence[str] = (), digits: int | None = 6) -> DataFrame:
    """Predictions -> metrics table (one row per group) in one pass over rows."""
    return metrics_from_cells(confusion_cells(pred, label_col, pred_col, group_cols),
                              group_cols, digits)


#: fixed values: the results record's names of the metrics
RECORD_NAMES = {"weighted_precision": "precision", "weighted_recall": "recall", "weighted_f1": "f1"}


def result_record(metrics: DataFrame) -> DataFrame:
    """Metrics under the names that the results record gives them; other columns stay."""
    return metrics.withColumnsRenamed({k: v for k, v in RECORD_NAMES.items() if k in metrics.columns})


def accuracy(pred: DataFrame, label_col: str = "label_index", pred_col: str = "prediction",
             digits: int | None = 6) -> DataFrame:
    hit = (F.col(label_col) == F.col(pred_col)).cast("double")
    a = F.avg(hit)
    return pred.agg((F.round(a, digits) if digits is not None else a).alias("accuracy"))


def best_model(metrics: DataFrame, metric: str = "accuracy", order_col: str = "ord") -> DataFrame:
    """The best row by ``metric``; ties go to the earliest registered model."""
    w = Window.orderBy(F.col(metric).desc(), F.col(order_col).asc())
    return metrics.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
