"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

A document of a source with target/size ratio f is copied floor(f) times, and
once more with probability f - floor(f). The pivotal method rounds these
probabilities: two documents of similar size meet, mass moves between them at
random until one is integral, and the other goes on. Blocks of about
``BLOCK`` rows are rounded independently and hand one unresolved document up a
reduction tree, so every group is small and the copies of a source add up to
their expectation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.llm.common import join_hot, word_count
from verdigris.session import materialize

BLOCK = 64
EPS = 1e-9
WEIGHTS = (5, 2, 1)
NO_SOURCE = "\U0010ffff"


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """Target of every source: its weight's part of ``share`` times all sizes.

    Sources in code-point order (null last) take ``weights`` in turn; a target
    stops at ``most`` times its source's size, and what is over is shared anew
    by weight until none is above. Input: one row per (has_source, source) with
    ``source_size``; the few rows of this table are all that is ordered at once.
    """
    order = Window.orderBy(F.desc("has_source"), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = (sizes.withColumn("__w", weight).withColumn("__cap", F.col("source_size") * F.lit(float(most)))
         .withColumn("__full", F.col("__cap") / F.col("__w")))
    # sources fill up in the order of cap/weight: the level at which source i would fill is
    # reached if the rest, shared by weight, still gives it its cap
    fill = Window.orderBy("__full", F.desc("has_source"), "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = (s.withColumn("__goal", F.lit(float(share)) * F.sum("source_size").over(everything))
         .withColumn("__capped", F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
         .withColumn("__rest", F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
         .withColumn("__level", (F.col("__goal") - F.col("__capped")) / F.col("__rest"))
         .withColumn("__free", F.col("__level") < F.col("__full")))
    level = F.min(F.when(F.col("__free"), F.struct(F.col("__full"), F.col("__level")))).over(everything)["__level"]
    return s.select("has_source", "source", "source_size",
                    F.least(F.col("__cap"), F.coalesce(level * F.col("__w"), F.col("__cap"))).alias("target"))


def _uniform(seed: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _pivot(seed: int) -> Column:
    """Round the sorted array ``block``: decisions and the one document left over."""
    item = "struct<size:bigint,key:bigint,p:double>"
    start = F.struct(F.lit(None).cast(item).alias("open"),
                     F.array().cast("array<struct<key:bigint,take:int>>").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        a, b = acc["open"]["p"], x["p"]
        total = a + b
        u = _uniform(seed, acc["open"]["key"], x["key"])
        under = total < 1 - EPS
        # under 1 one of them drops to 0, else one of them rises to 1; the other goes on with the rest
        first_goes_on = F.when(under, u * total < a).otherwise(u * (2 - total) >= 1 - b)
        rest = F.when(under, total).otherwise(total - 1)
        fixed = F.when(under, F.lit(0)).otherwise(F.lit(1))
        goes_on = F.when(first_goes_on, acc["open"]).otherwise(x)
        settled = F.when(first_goes_on, x["key"]).otherwise(acc["open"]["key"])
        both = F.struct(
            F.when((rest > EPS) & (rest < 1 - EPS), goes_on.withField("p", rest)).alias("open"),
            F.concat(acc["done"], F.array(F.struct(settled.alias("key"), fixed.alias("take"))),
                     F.when((rest > EPS) & (rest < 1 - EPS),
                            F.array().cast("array<struct<key:bigint,take:int>>"))
                     .otherwise(F.array(F.struct(goes_on["key"].alias("key"),
                                                 F.round(rest).cast("int").alias("take"))))).alias("done"))
        alone = F.struct(x.alias("open"), acc["done"].alias("done"))
        return F.when(acc["open"].isNull(), alone).otherwise(both)

    return F.aggregate("block", start, step)


def pivotal_round(rows: DataFrame, group: str, seed: int, block: int = BLOCK) -> DataFrame:
    """0/1 decision ``take`` for every ``key`` (long, unique) with probability ``p`` in (0, 1).

    Input columns: ``group``, ``key``, ``size``, ``p``. Within a group the
    decisions sum to the sum of ``p`` rounded up or down. Blocks of about
    ``block`` keys are contiguous in the order of sizes, the largest first, so mass
    moves between keys of nearly one size and a block leaves one of its
    smallest open. The tree has log_block(rows) levels; a level reads only what the
    level below left open.
    """
    rows = materialize(rows.select(group, "key", F.col("size").cast("long").alias("size"), F.col("p").cast("double").alias("p")), "pivot_rows")
    # a key's place: after the larger sizes, and somewhere among its own
    larger = Window.partitionBy(group).orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(group, "size").agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(larger), F.lit(0)))
    place = F.col("__before") + F.floor(_uniform(seed, F.col("key")) * F.col("__n"))
    open_ = materialize(join_hot(rows, sizes, [group, "size"], "inner").select(
        group, F.floor(place / block).cast("long").alias("__block"), F.struct("size", "key", "p").alias("item")), "pivot_places")
    top = open_.agg(F.max("__block")).first()[0]
    if top is None:
        return rows.select("key", F.lit(0).alias("take"))
    decided = []
    while True:
        level = (open_.groupBy(group, "__block").agg(F.sort_array(F.collect_list("item"), asc=False).alias("block"))
                 .withColumn("r", _pivot(seed + len(decided)))
                 .select(group, "__block", F.col("r.open").alias("item"), F.col("r.done").alias("done")))
        level = materialize(level, "pivot")
        decided.append(level.select(F.explode("done").alias("d")).select("d.*"))
        left = level.where(F.col("item").isNotNull())
        if top == 0:
            u = _uniform(seed - 1, F.col("item.key"))
            decided.append(left.select(F.col("item.key").alias("key"), (u < F.col("item.p")).cast("int").alias("take")))
            break
        top //= block  # parents: neighbouring blocks
        open_ = left.select(group, F.floor(F.col("__block") / block).cast("long").alias("__block"), "item")
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out


def mix(docs: DataFrame, seed: int = 8) -> DataFrame:
    """Copies of every document so that its source comes near its target.

    Returns doc_id, size, source_size, target, copies, taken, and ``__row``,
    the hash of (doc_id, source, text) by which copies are joined back. A null
    or empty text has size 0 and takes no words; a null source is a source of
    its own, the last; identical rows share one decision; an empty table gives
    no rows. Every run decides alike, whatever the partitioning.
    """
    rows = materialize(docs.select(
        "doc_id", F.col("source").isNotNull().alias("has_source"),
        F.coalesce("source", F.lit(NO_SOURCE)).alias("source"), word_count(F.col("text")).alias("size"),
        F.xxhash64("doc_id", F.lit("|"), "source", F.lit("|"), "text").alias("__row")), "mix_sizes")
    sizes = rows.groupBy("has_source", "source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(sizes), "mix_targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + EPS)
    rated = (join_hot(rows, targets, ["has_source", "source"], "inner")
             .withColumn("__whole", whole).withColumn("__p", F.greatest(ratio - whole, F.lit(0.0))))
    rated = materialize(rated, "mix_rated")
    # identical rows (one __row) are decided once; the size in the draw is theirs together
    fractional = (rated.where((F.col("__p") > EPS) & (F.col("size") > 0))
                  .groupBy("has_source", "source", "__row")
                  .agg(F.sum("size").alias("size"), F.max("__p").alias("p"))
                  .select(F.concat(F.col("has_source").cast("string"), "source").alias("group"),
                          F.col("__row").alias("key"), "size", "p"))
    takes = pivotal_round(fractional, "group", seed).select(F.col("key").alias("__row"), "take")
    copies = (F.col("__whole") + F.coalesce("take", F.lit(0))).cast("int")
    return (rated.join(takes, "__row", "left").withColumn("copies", copies)
            .select("doc_id", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).cast("long").alias("taken"), "__row"))
