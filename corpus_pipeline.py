"""Corpus pipeline: quality, near-duplicates, secrets, source mix, packing.

Every stage takes the documents that its predecessor kept, written as Parquet
and read again, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdigris.llm import mixing, ngram_join, packing, quality, secrets
from verdigris.llm.common import table
from verdigris.session import materialize

WORDS, PERCENT = 5, 80  # of the near-duplicate stage; op7's own contract has other values
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _row(*columns: str) -> Column:
    """The row hash by which ``quality_rules`` and ``mix`` let rows be joined back."""
    return F.xxhash64(*[c for name in columns for c in (F.col(name), F.lit("|"))][:-1])


def _same_row() -> Column:
    """A row and its decision (``__of_id``, ``__of_row``); rows without doc_id have theirs too."""
    return F.col("doc_id").eqNullSafe(F.col("__of_id")) & (F.col("__row") == F.col("__of_row"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs.

    Null and empty texts go; repeated rows and rows without doc_id are judged like all others.
    """
    docs = docs.select(*COLUMNS)
    judged = quality.quality_rules(docs, table(spark, sf_dir, "labels"))
    kept = judged.where("kept").select(F.col("doc_id").alias("__of_id"), F.col("__row").alias("__of_row")).distinct()
    return docs.withColumn("__row", _row("doc_id", "lang", "text")).join(kept, _same_row(), "left_semi").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: the one of smallest id. Near are ``PERCENT`` of shingles of ``WORDS`` words.

    Documents are compared by their texts, not their ids: different texts under one id all stay, and of copies
    one stays even if none has an id. A text without words is near to nothing.
    """
    return ngram_join.one_of_each(docs.select(*COLUMNS), words=WORDS, percent=PERCENT)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; a null text stays null."""
    model = secrets.train(docs)
    found = secrets.find_secrets(docs, model, ["doc_id", "lang", "source"], clean="text")
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it; repeated rows are taken alike, each by itself."""
    docs = docs.select(*COLUMNS)
    mixed = mixing.mix(docs).select(F.col("doc_id").alias("__of_id"), F.col("__row").alias("__of_row"), "copies")
    mixed = materialize(mixed.distinct(), "copies")
    return (docs.withColumn("__row", _row("doc_id", "source", "text")).join(mixed.where("copies > 0"), _same_row())
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), "copies"))).select(*COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in the training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("jaccard_join", near_duplicate_stage),
    ("secret_scan", secret_stage),
    ("pivotal_mix", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: the stages' hashes, models and tokenizer are not expressible in SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``; each result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
