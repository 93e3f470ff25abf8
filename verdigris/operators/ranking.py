"""Ranks over whole tables and exact cuts per class, without a task that holds them.

``global_rank`` numbers the rows of a table in one order: a range partition, the
place in the partition, and the rows of the partitions before it. ``class_cuts``
finds for every class the value up to which its quota reaches, digit by digit: only
counts per (class, next digits) are formed.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.session import materialize

STEP = 4  # hex digits of a refinement: at most 16^4 counts a class are put in order


def global_rank(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Add ``out``: the row's number from 0 in ``order`` over the whole table.

    Rows that ``order`` does not tell apart get successive numbers in any order.
    The driver holds one count per shuffle partition, whatever the rows; only a
    value that very many rows share would fill a partition, so ``order`` should
    end with a key."""
    part = F.spark_partition_id()
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("__at", F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33))
                .withColumn("__part", part))
    placed = materialize(placed, "ranked")
    sizes = sorted(tuple(r) for r in placed.groupBy("__part").agg(F.count(F.lit(1))).collect())
    first = accumulate([0, *(n for _, n in sizes)])
    starts = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, first)], "__part int, __first long")
    return (placed.join(F.broadcast(starts), "__part")
                  .withColumn(out, F.col("__first") + F.col("__at")).drop("__part", "__at", "__first"))


def _cut(counts: DataFrame, quota: DataFrame) -> DataFrame:
    """Per class of ``quota`` (``__label, __need``) the value of ``counts`` (``__label, __v, __n``) that the quota
    ends in: ``__label, __cut``, how many of the ``__size`` rows of that value it still needs. Classes within
    their quota have no row."""
    before = Window.partitionBy("__label").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (counts.join(quota.withColumnRenamed("__need", "__quota"), "__label")
                    .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))))
    return (ranked.where((F.col("__before") < F.col("__quota")) & (F.col("__before") + F.col("__n") >= F.col("__quota")))
                  .select("__label", F.col("__v").alias("__cut"), (F.col("__quota") - F.col("__before")).alias("__need"),
                          F.col("__n").alias("__size")))


def refine(cuts: DataFrame, counts: DataFrame, digits: int, length: int) -> tuple[DataFrame, DataFrame]:
    """Cuts of ``digits`` hex digits refined until each takes all rows of its value or has ``length`` digits.

    ``counts`` has ``__label, __v, __n`` of the rows under the cuts that are not exact. Returns the exact
    cuts and those whose rows share one whole value of which only some are needed."""
    exact, open_ = cuts.where("__need = __size"), cuts.where("__need < __size")
    while digits < length and not open_.isEmpty():
        under = counts.join(open_.select("__label", "__cut"), "__label").where(F.substring("__v", 1, digits) == F.col("__cut"))
        # values of a class that are few enough to be put in order are taken whole
        most = under.groupBy("__label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        digits = length if most <= 16 ** STEP else min(length, digits + STEP)
        finer = under.groupBy("__label", F.substring("__v", 1, digits).alias("__v")).agg(F.sum("__n").alias("__n"))
        finer = materialize(_cut(finer, open_.select("__label", "__need")), "cuts")
        exact, open_ = exact.unionByName(finer.where("__need = __size")), finer.where("__need < __size")
    return exact, open_


def class_cuts(values: DataFrame, quota: DataFrame, digits: int, length: int,
               histogram: DataFrame | None = None, stats: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(exact, tied) cuts of the classes above their ``quota`` (``__label, __need``), from rows ``__label, __v``.

    ``__v`` is a hex string of ``length`` digits. The rows are read for the counts of their first ``digits``
    (``histogram``, if the caller has it) and once more for the counts of the values under a cut."""
    if histogram is None:
        histogram = prefix_counts(values, digits)
    cuts = materialize(_cut(histogram, quota), "cuts")
    inexact = cuts.where("__need < __size").select("__label", "__cut")
    under = (values.join(inexact, "__label").where(F.substring("__v", 1, digits) == F.col("__cut"))
                   .groupBy("__label", "__v").agg(F.count(F.lit(1)).alias("__n")))
    under = materialize(under, "under_cuts")
    if stats is not None:
        stats["ranked_rows"] = int(under.agg(F.sum("__n")).first()[0] or 0)
    return refine(cuts, under, digits, length)


def prefix_counts(values: DataFrame, digits: int) -> DataFrame:
    return materialize(values.groupBy("__label", F.substring("__v", 1, digits).alias("__v"))
                             .agg(F.count(F.lit(1)).alias("__n")), "histogram")
