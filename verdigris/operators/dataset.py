"""Dataset preparation operators: join, class statistics, balancing, splitting,
label indexing.  All randomness is keyed by a seed and a stable row key, so
results do not depend on partitioning.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigris.functions.labels import basename
from verdigris.operators.ranking import class_cuts, global_rank, prefix_counts
from verdigris.session import materialize

DEFAULT_SEED = 42
HASH_DIGITS, ROW_DIGITS = 32, 16  # hex digits of the order hash and of the hash of a whole row
HOT_SHARE = 1000  # a label with at least 1/HOT_SHARE of the rows is hot; there are at most so many


class EmptyResultError(RuntimeError):
    """Raised by ``require_rows`` (e.g. a join that matched nothing)."""


class DuplicateKeyError(RuntimeError):
    """Raised by a strict join when a key occurs more than once."""


# --------------------------------------------------------------------------
# small helpers
# --------------------------------------------------------------------------

def order_hash(key: str | Column, seed: int = DEFAULT_SEED) -> Column:
    """Lower-case hex md5 of ``"<seed>|<key>"``: a partition-independent
    pseudo-random order for sampling and splitting.  NULL keys hash as one
    key of their own, ``"<seed>|"`` followed by a NUL, so no row drops out."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(k.cast("string"), F.lit("\0"))))


def require_rows(df: DataFrame, message: str = "result is empty") -> DataFrame:
    """Guard: raise ``EmptyResultError`` when ``df`` has no rows (one short job)."""
    if df.isEmpty():
        raise EmptyResultError(message)
    return df


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by column name of any number of frames (no de-duplication)."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return functools.reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


# --------------------------------------------------------------------------
# filters and counts
# --------------------------------------------------------------------------

def labelled_only(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows whose label is known (NULL labels cannot be trained on)."""
    return df.where(F.col(label_col).isNotNull())


def class_slice(df: DataFrame, label_col: str, value) -> DataFrame:
    """Rows of one class."""
    return df.where(F.col(label_col) == F.lit(value))


def class_distribution(df: DataFrame, label_col: str = "label",
                       count_col: str = "n") -> DataFrame:
    """Rows per class; NULL is its own group."""
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias(count_col))


def class_distribution_top(df: DataFrame, label_col: str = "label", k: int = 20,
                           count_col: str = "n") -> DataFrame:
    """The ``k`` largest classes, ties broken by class name (a top-k report)."""
    return (class_distribution(df, label_col, count_col)
            .orderBy(F.col(count_col).desc(), F.col(label_col).asc_nulls_last())
            .limit(k))


def n_classes(df: DataFrame, label_col: str = "label", alias: str = "n_classes") -> DataFrame:
    """Number of distinct non-NULL classes (one row)."""
    return df.agg(F.count_distinct(F.col(label_col)).alias(alias))


def split_counts(df: DataFrame, split_col: str = "split", count_col: str = "n") -> DataFrame:
    """Rows per split value in one aggregation."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias(count_col))


def duplicate_keys(df: DataFrame, key_col: str, count_col: str = "n") -> DataFrame:
    """Audit: keys that occur more than once (NULL keys ignored)."""
    return (df.where(F.col(key_col).isNotNull())
              .groupBy(key_col).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


# --------------------------------------------------------------------------
# joins
# --------------------------------------------------------------------------

def first_row_per_key(df: DataFrame, key_col: str, order_col: str) -> DataFrame:
    """Exactly one row for every key: one with the smallest ``order_col``.

    One aggregation by key, so repeated keys, repeated order values and
    repeated rows can never fan out; the join on the key reuses its shuffle."""
    rest = [c for c in df.columns if c != key_col]
    row = F.struct(*[F.col(c) for c in rest])
    kept = df.where(F.col(key_col).isNotNull()).groupBy(key_col).agg(F.min_by(row, F.col(order_col)).alias("__row"))
    # the key itself stays, and with it the partitioning
    return kept.select(*[F.col(c) if c == key_col else F.col("__row")[c].alias(c) for c in df.columns])


def join_on_key(left: DataFrame, right: DataFrame, key_col: str,
                right_order_col: str, duplicates: str = "first") -> DataFrame:
    """Inner equi-join on ``key_col`` (already present on both sides).

    ``duplicates='first'``: the right side keeps one row per key (smallest
    ``right_order_col``), so every left row matches at most once and output
    never exceeds the left side.  ``'error'``: raise ``DuplicateKeyError``
    when either side repeats a key.  ``'unique'``: the caller guarantees
    unique keys (file paths), so no extra pass is spent.  NULL keys never join.
    """
    if duplicates not in ("first", "error", "unique"):
        raise ValueError("duplicates must be 'first', 'error' or 'unique'")
    if duplicates == "unique":
        # keys are unique by construction (e.g. paths of one file listing)
        right_one = right
    elif duplicates == "error":
        for side, name in ((left, "left"), (right, "right")):
            if not duplicate_keys(side, key_col).isEmpty():
                raise DuplicateKeyError(f"{name} side repeats values of {key_col!r}")
        right_one = right
    else:
        right_one = first_row_per_key(right, key_col, right_order_col)
    return left.where(F.col(key_col).isNotNull()).join(right_one, key_col, "inner")


def join_on_basename(meta: DataFrame, feats: DataFrame, path_col: str = "path",
                     duplicates: str = "first", decode: bool = True) -> DataFrame:
    """Metadata ⋈ features on the file's basename; output ``path`` is the
    metadata side's.  A path ending in ``/`` has no basename and never joins.
    """
    key = "__key"
    m = meta.withColumn(key, basename(path_col, empty_as_null=True, decode=decode))
    f = (feats.withColumnRenamed(path_col, "__rpath")
              .withColumn(key, basename("__rpath", empty_as_null=True, decode=decode)))
    return join_on_key(m, f, key, "__rpath", duplicates).drop(key, "__rpath")


# --------------------------------------------------------------------------
# balancing and splitting
# --------------------------------------------------------------------------

def rank_within_quota(df: DataFrame, label_col: str, key_col: str, quota,
                      seed: int = DEFAULT_SEED, bucket_bits: int = 14,
                      flag_col: str | None = None, stats: dict | None = None) -> DataFrame:
    """Rows whose rank inside their class, by ``order_hash(key)`` and then by a
    hash of the whole row, is at most the class's ``quota`` (``quota``: columns
    ``label_col, quota``, or a function from the per-class counts ``label_col,
    n`` to such a table; the counts then come from the histogram, without
    another pass).

    With ``flag_col`` every row is kept and the flag tells whether it is
    within the quota; otherwise only those rows are returned.

    Exact, and no rows are ranked: a class's cut, the hash up to which its quota
    reaches, is found by radix descent.  Counts per (class, first
    ``bucket_bits`` bits) name the bucket that holds the cut; counts of the
    hashes in that bucket, refined digit by digit, give the cut itself.  Rows
    that share their key share the hash (NULL keys, repeated keys): where the
    cut falls among them it goes on over the hashes of their rows, and of rows
    equal in every column any are as good as others.  Cost: two narrow passes
    (class and hash) and one wide pass that compares each row with the cut of
    its class; classes above their quota that end in one key's rows take one more.
    The cuts have one row per such class; Spark broadcasts them if their written
    size allows it.
    """
    if not 4 <= bucket_bits <= 24:
        raise ValueError("bucket_bits must be in [4, 24]")
    digits = (bucket_bits + 3) // 4
    columns = df.columns
    row_hash = F.lower(F.lpad(F.hex(F.xxhash64(*columns)), ROW_DIGITS, "0"))
    h = df.withColumn("__h", order_hash(key_col, seed))
    values = h.select(F.col(label_col).alias("__label"), F.col("__h").alias("__v"))
    histogram = prefix_counts(values, digits)
    if callable(quota):
        quota = quota(histogram.groupBy(F.col("__label").alias(label_col)).agg(F.sum("__n").alias("n")))
    quota = quota.select(F.col(label_col).alias("__label"), F.col("quota").alias("__need"))
    exact, tied = class_cuts(values, quota, digits, HASH_DIGITS, histogram, stats)

    none = F.lit(None)
    cuts = [exact.select("__label", "__cut", none.cast("string").alias("__row_cut"), none.cast("long").alias("__copies")),
            # a quota of 0 keeps nothing: a blank comes before every digit
            quota.where("__need <= 0").select("__label", F.lit(" ").alias("__cut"), none.cast("string"), none.cast("long"))]
    repeated = None
    if not tied.isEmpty():
        of_key = (h.withColumn("__label", F.col(label_col)).join(tied.select("__label", "__cut"), "__label")
                   .where(F.col("__h") == F.col("__cut")).select("__label", row_hash.alias("__v")))
        rows, repeated = class_cuts(of_key, tied.select("__label", "__need"), digits, ROW_DIGITS)
        both = tied.select("__label", "__cut")
        of_rows = rows.select("__label", F.col("__cut").alias("__row_cut"), none.cast("long").alias("__copies"))
        of_copies = repeated.select("__label", F.col("__cut").alias("__row_cut"), F.col("__need").alias("__copies"))
        cuts.append(both.join(of_rows.unionByName(of_copies), "__label").select("__label", "__cut", "__row_cut", "__copies"))
    cuts = materialize(functools.reduce(DataFrame.union, cuts), "class_cuts").withColumnRenamed("__label", label_col)

    def upto(value: Column, cut: Column) -> Column:
        return F.substr(value, F.lit(1), F.length(cut)) <= cut

    at_cut, row_cut = F.col("__h") == F.col("__cut"), F.col("__row_cut")
    inside = (F.when(F.col("__cut").isNull(), True)
               .when(row_cut.isNull() | ~at_cut, upto(F.col("__h"), F.col("__cut")))
               .when(F.col("__copies").isNull() | (row_hash != row_cut), upto(row_hash, row_cut)))  # NULL: some copies
    name = flag_col or "__in"
    marked = h.join(cuts, label_col, "left").withColumn(name, inside)
    out = marked.select(*columns, name)
    if repeated is not None and not repeated.isEmpty():
        copies = (marked.where(F.col(name).isNull()).groupBy(*columns, "__copies").agg(F.count(F.lit(1)).alias("__n"))
                        .withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))
                        .select(*columns, (F.col("__i") <= F.col("__copies")).alias(name)))
        out = out.where(F.col(name).isNotNull()).unionByName(copies)
    return out if flag_col else out.where(name).drop(name)


def first_n_per_class(df: DataFrame, label_col: str, key_col: str, quota,
                      seed: int = DEFAULT_SEED, bucket_bits: int = 14) -> DataFrame:
    """Only the rows within their class's quota (see ``rank_within_quota``)."""
    return rank_within_quota(df, label_col, key_col, quota, seed, bucket_bits)


def balance_exact(df: DataFrame, label_col: str = "label", key_col: str = "path",
                  factor: int = 2, seed: int = DEFAULT_SEED, bucket_bits: int = 14) -> DataFrame:
    """Cap every class at ``factor`` × the smallest class, exactly.

    Which rows survive is decided by ``order_hash(key, seed)``; NULL labels are
    excluded.  Classes at or under the cap keep every row."""
    labelled = labelled_only(df, label_col)

    def quota(counts: DataFrame) -> DataFrame:
        # one row per class; the cap is a single number
        smallest = counts.agg(F.min("n")).first()[0] or 0
        return counts.select(label_col, F.lit(int(smallest) * factor).cast("long").alias("quota"))

    return first_n_per_class(labelled, label_col, key_col, quota, seed, bucket_bits)


def balance_bernoulli(df: DataFrame, label_col: str = "label", factor: int = 2,
                      seed: int = DEFAULT_SEED) -> DataFrame:
    """The reference's sampling: each class above the cap is kept with
    probability cap / n (so the cap holds only on average); uses ``sampleBy``.
    Only one number per class reaches the driver."""
    labelled = labelled_only(df, label_col)
    counts = {r[0]: r[1] for r in class_distribution(labelled, label_col).collect()}
    if not counts:
        return labelled
    cap = min(counts.values()) * factor
    fractions = {k: min(1.0, cap / n) for k, n in counts.items()}
    return labelled.sampleBy(label_col, fractions, seed)


def balance_bernoulli_keyed(df: DataFrame, label_col: str = "label", key_col: str = "path", factor: int = 2,
                            seed: int = DEFAULT_SEED) -> DataFrame:
    """``balance_bernoulli`` by ``order_hash(key)``: a row is kept if its hash, as a share
    of all hashes, is below cap / n.  The kept rows depend on seed and key alone.
    One row per class is joined back; hot classes are broadcast with their rates."""
    labelled = labelled_only(df, label_col)
    counts = materialize(class_distribution(labelled, label_col, "__n"), "class_counts")
    size = counts.agg(F.min("__n").alias("least"), F.sum("__n").alias("rows")).first()
    cap, least = (size["least"] or 0) * factor, -(-(size["rows"] or 0) // HOT_SHARE)
    rates = counts.withColumn("__rate", F.least(F.lit(1.0), F.lit(float(cap)) / F.col("__n")))
    hot = F.broadcast(rates.where(F.col("__n") >= least).drop("__n"))  # at most HOT_SHARE classes
    rest = rates.where(F.col("__n") < least).drop("__n")
    rated = labelled.join(hot, label_col).unionByName(labelled.join(hot.select(label_col), label_col, "left_anti").join(rest, label_col))
    place = F.conv(F.substring(order_hash(key_col, seed), 1, 8), 16, 10).cast("long")
    return rated.where(place < F.col("__rate") * float(1 << 32)).select(*df.columns)


def split_threshold_hex(ratio: float) -> str:
    """First 8 hex digits below which a row goes to the first split."""
    return f"{int(ratio * 2 ** 32):08x}"


def hash_split(df: DataFrame, key_col: str, ratio: float = 0.8, seed: int = DEFAULT_SEED,
               split_col: str = "split", names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Add a ``split`` column: membership depends only on (seed, key), never on
    partitioning.  ``ratio`` of rows (in expectation) get ``names[0]``."""
    if ratio >= 1.0:
        return df.withColumn(split_col, F.lit(names[0]))
    if ratio <= 0.0:
        return df.withColumn(split_col, F.lit(names[1]))
    prefix = F.substring(order_hash(key_col, seed), 1, 8)
    return df.withColumn(split_col, F.when(prefix < F.lit(split_threshold_hex(ratio)),
                                           F.lit(names[0])).otherwise(F.lit(names[1])))


def stratified_hash_split(df: DataFrame, label_col: str, key_col: str, ratio: float = 0.8,
                          seed: int = DEFAULT_SEED, split_col: str = "split",
                          names: tuple[str, str] = ("train", "test"),
                          bucket_bits: int = 14) -> DataFrame:
    """Per class, exactly ``round(ratio × n_class)`` rows (first by
    ``order_hash``) go to ``names[0]`` (with 0.8, every class of three or more
    rows appears on both sides).  Rows with a NULL class go to ``names[0]``."""
    def quota(counts: DataFrame) -> DataFrame:
        return counts.select(label_col, F.round(F.col("n") * ratio).cast("long").alias("quota"))

    marked = rank_within_quota(df, label_col, key_col, quota, seed, bucket_bits,
                               flag_col="__first")
    return (marked.withColumn(split_col, F.when(F.col("__first"), F.lit(names[0]))
                              .otherwise(F.lit(names[1])))
                  .drop("__first"))


def random_split(df: DataFrame, ratio: float = 0.8, seed: int = DEFAULT_SEED,
                 split_col: str = "split", names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """The reference's split (``randomSplit``): Bernoulli per partition, so
    membership changes with partitioning.  Returned as one frame with a
    ``split`` column."""
    a, b = df.randomSplit([ratio, 1.0 - ratio], seed=seed)
    return a.withColumn(split_col, F.lit(names[0])).unionByName(
        b.withColumn(split_col, F.lit(names[1])))


# --------------------------------------------------------------------------
# label indexing
# --------------------------------------------------------------------------

def _ranked_labels(df: DataFrame, label_col: str) -> DataFrame:
    """``label, n, rank`` of every label: the most frequent first, ties by label."""
    counts = class_distribution(labelled_only(df, label_col), label_col).withColumnRenamed(label_col, "label")
    return global_rank(counts, [F.col("n").desc(), F.col("label").asc()])


def label_map(df: DataFrame, label_col: str = "label",
              index_col: str = "label_index") -> DataFrame:
    """``label_index, label``: most frequent class first, ties by name
    (``StringIndexer``'s frequencyDesc order); NULL is not a class.  One row
    per class, ranked without a task or a driver that holds all classes."""
    return _ranked_labels(df, label_col).select(F.col("rank").cast("double").alias(index_col), "label")


def index_by_rank(df: DataFrame, label_col: str = "label", index_col: str = "label_index",
                  hot_share: int = HOT_SHARE) -> DataFrame:
    """Add ``label_index`` as ``label_map`` gives it, for any number of labels
    (rows with NULL labels are dropped).

    Labels that hold at least 1/``hot_share`` of the rows, at most
    ``hot_share`` of them, are broadcast; the rows of the others are joined by a
    shuffle in which no label is hot."""
    ranked = materialize(_ranked_labels(df, label_col).select(
        F.col("label").alias(label_col), F.col("rank").cast("double").alias(index_col), "n"), "ranked_labels")
    least = -(-(ranked.agg(F.sum("n")).first()[0] or 0) // hot_share)
    hot = F.broadcast(ranked.where(F.col("n") >= least).drop("n"))
    rest = ranked.where(F.col("n") < least).drop("n")
    warm = df.join(hot, label_col)
    cold = df.join(hot.select(label_col), label_col, "left_anti").join(rest, label_col)
    columns = [*df.columns, index_col]
    return warm.select(columns).unionByName(cold.select(columns))


def fit_label_indexer(df: DataFrame, label_col: str = "label",
                      index_col: str = "label_index") -> StringIndexerModel:
    """``StringIndexer`` with frequency order; NULL / unseen labels are skipped."""
    return StringIndexer(inputCol=label_col, outputCol=index_col, handleInvalid="skip",
                         stringOrderType="frequencyDesc").fit(df)


def index_labels(df: DataFrame, label_col: str = "label",
                 index_col: str = "label_index") -> tuple[DataFrame, StringIndexerModel]:
    """Fit the indexer and add ``label_index`` (rows with NULL labels dropped)."""
    model = fit_label_indexer(df, label_col, index_col)
    return model.transform(df), model


def indexer_label_map(model: StringIndexerModel, index_col: str = "label_index") -> DataFrame:
    """The fitted indexer's classes as a ``label_index, label`` table."""
    spark = SparkSession.active()
    return spark.createDataFrame([(float(i), lab) for i, lab in enumerate(model.labels)],
                                 f"{index_col} double, label string")
