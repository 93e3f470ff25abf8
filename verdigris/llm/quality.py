"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Every rule rejects a document whose ratio is above a cutoff. Cutoffs come from
a fixed grid. Labelled documents are halved by the CRC of their id: the tuning
half tells how many bad documents a cutoff catches, the holdout half certifies
it. A cutoff is certified in a stratum if the exact (Clopper-Pearson) upper
bound of its false-rejection rate among good holdout documents lies under the
rule's share of ``risk``; the confidence is Bonferroni-corrected for all rules,
cutoffs and strata. Of the certified cutoffs the one that catches most bad
tuning documents is taken, the laxest among equals; a rule that none
is certified for, or that catches nothing, rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdigris.llm.common import SEPARATOR, join_hot, let, words_of
from verdigris.session import materialize

RISK, DELTA = 0.05, 0.05
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
NO_STRATUM = "\U0010ffff"

#: rule -> (numerator, denominator, cutoffs in thousandths): rejected if 1000 * numerator > cutoff * denominator
RULES = {
    "symbols": ("n_symbols", "word_chars", (5, 10, 20, 50, 100, 200)),
    "capitals": ("n_capitals", "word_chars", (100, 200, 300, 500, 700)),
    "dup_lines": ("n_dup_lines", "n_lines", (100, 200, 300, 500, 700)),
    "repeats": ("n_repeat_words", "n_words", (100, 200, 300, 400)),
    "long_words": ("word_chars", "n_words", (6000, 7000, 8000, 10000, 15000)),
}


def _repeat_words(words: Column) -> Column:
    """Words covered by three-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hashes. Equal windows become neighbours by
    sorting (hash, position); the repeated positions, sorted, cover three words
    each, less where the next one starts sooner.
    """
    windows = let(words, lambda w: F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
        .otherwise(F.array().cast("array<bigint>")))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        repeated = let(pairs, lambda s: F.transform(
            F.filter(F.transform(s, lambda x, i: F.struct(
                x["i"].alias("i"),
                (((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                 | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
                lambda x: x["twice"]), lambda x: x["i"]))
        spread = let(F.sort_array(repeated), lambda p: F.transform(
            p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))))
        return F.aggregate(spread, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint"))
               .otherwise(covered(h)))


def text_measures(docs: DataFrame) -> DataFrame:
    """The documents' columns without ``text`` plus one struct ``m`` of measures of the whole text."""
    text = F.coalesce("text", F.lit(""))

    def measures(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, SEPARATOR, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                          (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup")))
            .alias("lines"),
            _repeat_words(w).alias("n_repeat_words"))

    return docs.withColumn("m", let(words_of(F.col("text")), measures)).drop("text")


def _rejects(rule: str, cutoff: Column | int) -> Column:
    above, below, _ = RULES[rule]
    return F.col(above) * 1000 > F.col(below) * cutoff


def binomial_below(n: Column, x: Column, p: float) -> Column:
    """P(Binomial(n, p) <= x) by summing its terms in logarithms; 1 where x >= n * p."""
    start = n * F.lit(math.log1p(-p))
    odds = math.log(p / (1 - p))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] + F.log((n - k + 1) / k) + F.lit(odds)
        high, low = F.greatest(acc["sum"], term), F.least(acc["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    summed = F.aggregate(F.sequence(F.lit(1).cast("long"), x),
                         F.struct(start.alias("term"), start.alias("sum")), step)["sum"]
    return F.when(x >= n * F.lit(p), F.lit(1.0)).when(x == 0, F.exp(start)).otherwise(F.exp(summed))


def certified_cutoffs(measured: DataFrame, labels: DataFrame, risk: float = RISK,
                      delta: float = DELTA) -> DataFrame:
    """One row per stratum and rule with the chosen ``cutoff`` (thousandths).

    ``measured`` has doc_id, stratum and the measures; ``labels`` doc_id and
    quality (1 good, 0 bad; null is no label; of repeated labels the worst counts).
    """
    truth = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = (measured.join(truth, "doc_id").where(F.col("quality").isin(0, 1))
             .withColumn("__held", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0))
    good = F.col("__held") & (F.col("quality") == 1)
    bad = ~F.col("__held") & (F.col("quality") == 0)
    counts = known.groupBy("stratum").agg(
        F.count_if(good).alias("n"),
        *[F.count_if(good & _rejects(r, c)).alias(f"good_{r}_{c}") for r, (_, _, cs) in RULES.items() for c in cs],
        *[F.count_if(bad & _rejects(r, c)).alias(f"bad_{r}_{c}") for r, (_, _, cs) in RULES.items() for c in cs])
    counts = materialize(counts, "quality_counts")
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).cast("long").alias("cutoff"),
                              F.col(f"good_{r}_{c}").alias("x"), F.col(f"bad_{r}_{c}").alias("caught"))
                     for r, (_, _, cs) in RULES.items() for c in cs])
    # a rule's cutoffs are nested, so they are tested in one order, from lax to strict, until the first that fails: only
    # rules and strata share the risk of error
    tests = max(1, counts.count()) * len(RULES)
    tried = (counts.select("stratum", "n", F.explode(grid).alias("t")).select("stratum", "n", "t.*")
             .withColumn("bound", binomial_below(F.col("n"), F.col("x"), risk / len(RULES))))
    return (tried.where((F.col("bound") <= delta / tests) & (F.col("caught") > 0))
            .groupBy("stratum", "rule")
            .agg(F.max_by("cutoff", F.struct("caught", "cutoff")).alias("cutoff")))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK,
                  delta: float = DELTA) -> DataFrame:
    """Measures and verdict of every document.

    Null and empty texts have no words and fail the base rules; a null stratum
    is a stratum of its own; without labels nothing is certified and only the
    base rules reject; repeated rows are judged alike. ``labels`` may hold ids
    without document. ``__row`` is the row's hash by which it is joined back.
    """
    measured = materialize(
        text_measures(docs.select("doc_id", "text", F.coalesce(stratum, F.lit(NO_STRATUM)).alias("stratum"),
                                  F.xxhash64("doc_id", F.lit("|"), stratum, F.lit("|"), "text").alias("__row")))
        .select("doc_id", "stratum", "__row", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_capitals",
                F.col("m.lines.n").alias("n_lines"), F.col("m.lines.dup").alias("n_dup_lines"),
                "m.n_repeat_words"), "quality")
    cutoffs = certified_cutoffs(measured, labels, risk, delta)
    wide = cutoffs.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RULES])
    wide = materialize(wide, "quality_cutoffs")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    failed = F.array_compact(F.array(*[F.when(_rejects(r, F.col(f"cut_{r}")), F.lit(r)) for r in RULES]))
    return (join_hot(measured, wide, ["stratum"], "left")
            .withColumn("base_failed", base_failed)
            .withColumn("failed_rules", F.array_join(failed, ","))
            .withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == "")))
