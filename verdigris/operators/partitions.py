"""Partitioning: profile, small-data guard and the partition-count sweep."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdigris.operators import evaluate as EV
from verdigris.operators.train import without_summaries

# --- fixed values ------------------------------------------------------------
SWEEP_COUNTS = (2, 4, 8, 16)
MIN_TRAIN_ROWS = 10
SKIP_REASON = "Only {n} training rows – too few"
# -----------------------------------------------------------------------------
SMALL_PART, FEW_PARTS, LARGE_PART = 16 << 20, 8, 128 << 20  # bytes, partitions, bytes
MOST_ROWS = 500_000  # in a partition; a forest of 20 trees caches some 200 bytes a row, however narrow

SWEEP_SCHEMA = T.StructType([
    T.StructField("n_partitions", T.IntegerType(), False),
    T.StructField("train_rows", T.LongType(), False),
    T.StructField("test_rows", T.LongType(), False),
    T.StructField("train_time_sec", T.DoubleType(), True),
    T.StructField("accuracy", T.DoubleType(), True),
    T.StructField("skipped", T.BooleanType(), False),
    T.StructField("reason", T.StringType(), True),
    T.StructField("min_partition_rows", T.LongType(), True),
    T.StructField("max_partition_rows", T.LongType(), True),
])


def partitions_for(df: DataFrame, features_col: str = "features") -> int:
    """Partitions for training rows, from their size as doubles alone: parts of
    ``SMALL_PART`` bytes up to ``FEW_PARTS`` of them, then of ``LARGE_PART`` bytes,
    and of ``MOST_ROWS`` rows at most.

    Trees shuffle statistics of all features per partition, so small tables are
    not cut fine; cores and session settings have no say."""
    vector = dict(df.dtypes)[features_col] == "vector"
    width = F.size(vector_to_array(features_col) if vector else F.col(features_col))
    rows, values = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.greatest(width, F.lit(0)).cast("long")), F.lit(0))).first()
    parts = lambda size: -(-8 * values // size)
    return max(1, min(FEW_PARTS, parts(SMALL_PART)), parts(LARGE_PART), -(-rows // MOST_ROWS))


def keyed_partitions(df: DataFrame, features_col: str = "features",
                     num_partitions: int | None = None) -> DataFrame:
    """Rows in ``num_partitions`` partitions (default: ``partitions_for`` them)
    by their own values, and in their order.

    A fit that samples by partition then depends on the rows, the seed and this
    number only: not on cores, caching or how the caller's rows were dealt."""
    n = num_partitions or partitions_for(df, features_col)
    vector = dict(df.dtypes)[features_col] == "vector"
    features = vector_to_array(features_col) if vector else F.col(features_col)
    plain = [c for c, t in df.dtypes if t != "vector" and not t.startswith(("array", "map", "struct"))]
    keyed = df.withColumn("__key", F.xxhash64(features, *plain))
    return keyed.repartition(n, "__key").sortWithinPartitions("__key", *plain).drop("__key")


def partition_sizes(df: DataFrame) -> DataFrame:
    """``partition, rows`` of every physical partition, empty ones included; no column is read."""
    def count(batches):
        from pyspark import TaskContext
        rows = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_pydict({"partition": [TaskContext.get().partitionId()], "rows": [rows]},
                                         pa.schema([("partition", pa.int32()), ("rows", pa.int64())]))

    return df.select(F.lit(True).alias("row")).mapInArrow(count, "partition int, rows long")


def partition_profile(df: DataFrame, n: int | None = None) -> DataFrame:
    """One row: ``n_partitions`` (empty ones count), ``total_rows``, smallest
    and largest partition and skew (largest / mean; NULL without rows).
    ``n`` repartitions first."""
    if n is not None:
        df = df.repartition(n)
    sizes = partition_sizes(df)
    return sizes.agg(
        F.count(F.lit(1)).cast("int").alias("n_partitions"),
        F.sum("rows").cast("long").alias("total_rows"),
        F.min("rows").alias("min_partition_rows"),
        F.max("rows").alias("max_partition_rows"),
        F.try_divide(F.max("rows"), F.avg("rows")).alias("skew"))


def guard_rows(df: DataFrame, split_col: str = "split", group_cols: Sequence[str] = (),
               min_rows: int = MIN_TRAIN_ROWS, train: str = "train",
               test: str = "test") -> DataFrame:
    """Per group: ``train_rows, test_rows, skipped, reason`` — a group with
    fewer than ``min_rows`` training rows is skipped, with the reason."""
    counts = df.groupBy(*group_cols).agg(
        F.count(F.when(F.col(split_col) == train, 1)).alias("train_rows"),
        F.count(F.when(F.col(split_col) == test, 1)).alias("test_rows"))
    skipped = F.col("train_rows") < min_rows
    prefix, suffix = SKIP_REASON.split("{n}")
    return (counts.withColumn("skipped", skipped)
                  .withColumn("reason", F.when(skipped, F.concat(
                      F.lit(prefix), F.col("train_rows").cast("string"), F.lit(suffix)))))


def sweep_guard(train_rows: int, min_rows: int = MIN_TRAIN_ROWS) -> str | None:
    """The reason a run is skipped, or None."""
    return SKIP_REASON.format(n=train_rows) if train_rows < min_rows else None


def partition_sweep(train: DataFrame, test: DataFrame,
                    make_pipeline: Callable[[], object],
                    counts: Sequence[int] = SWEEP_COUNTS, label_col: str = "label_index",
                    min_rows: int = MIN_TRAIN_ROWS, warmup: bool = True,
                    repeats: int = 1) -> DataFrame:
    """Train the same pipeline with the training rows spread over each
    partition count; record time, accuracy and partition balance.

    Rows are persisted (MEMORY_AND_DISK) and counted before the timer starts;
    one untimed warm-up fit removes first-fit JVM cost from the first count;
    ``repeats`` > 1 reports the median time.  Runs with too few training
    rows are recorded as skipped."""
    spark = train.sparkSession
    records = []
    warmed = not warmup
    for n in counts:
        tr = train.repartition(n).persist(StorageLevel.MEMORY_AND_DISK)
        te = test.repartition(n).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sizes = partition_sizes(tr).agg(F.min("rows"), F.max("rows"), F.sum("rows")).first()
            train_rows = int(sizes[2] or 0)
            test_rows = te.count()
            reason = sweep_guard(train_rows, min_rows)
            if reason:
                records.append((n, train_rows, test_rows, None, None, True, reason,
                                sizes[0], sizes[1]))
                continue
            if not warmed:
                make_pipeline().fit(tr)
                warmed = True
            times = []
            model = None
            for _ in range(max(1, repeats)):
                t0 = time.perf_counter()
                model = make_pipeline().fit(tr)
                times.append(time.perf_counter() - t0)
            times.sort()
            acc = EV.accuracy(without_summaries(model, spark).transform(te), label_col, "prediction", digits=4).first()[0]
            records.append((n, train_rows, test_rows, round(times[len(times) // 2], 2),
                            float(acc) if acc is not None else None, False, None,
                            sizes[0], sizes[1]))
        finally:
            tr.unpersist()
            te.unpersist()
    return spark.createDataFrame(records, SWEEP_SCHEMA).orderBy("n_partitions")
