"""Helpers shared by the corpus operators: skew-safe joins and distributed numbering."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verdigris.session import materialize

#: word separators of the corpus contracts: space, tab, LF, VT, FF, CR
WORD = r"[^\x20\x09-\x0D]+"
SEPARATOR = r"[\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a query (and its DuckDB SQL) to the subpackage's catalogue."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once: inside a lambda a plain expression would be evaluated per element."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text as an array; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def number_within(df: DataFrame, keys: list[str], spread: list[str], out: str,
                  rows_per_block: int = 4096) -> DataFrame:
    """Gapless numbers from 0 within each key, without gathering a key in one task.

    Rows of a key are dealt into hashed blocks of about ``rows_per_block`` rows;
    block sizes give every block its first number, and only a block is ranked.
    ``df`` is read twice, so pass a written table.
    """
    blocks = max(1, -(-df.count() // rows_per_block))
    dealt = df.withColumn("__block", F.pmod(F.xxhash64(*spread), F.lit(blocks)))
    by = [*keys, "__block"]
    first = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
              .select(*by, F.coalesce(F.sum("__n").over(first), F.lit(0)).alias("__first")))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*spread)) - 1
    return (dealt.withColumn("__in_block", rank).join(starts, by)
            .withColumn(out, (F.col("__first") + F.col("__in_block")).cast("long"))
            .drop("__block", "__in_block", "__first"))


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
             share: int = 1000) -> DataFrame:
    """Join ``left`` to ``right`` (one row per key, non-null keys) whatever the skew of ``left``.

    A key with at least 1/``share`` of the left rows is hot; there are at most
    ``share`` such keys, so their right rows are broadcast. All other keys are
    joined by a shuffle in which no key holds more than 1/``share`` of the rows.
    ``left`` is read three times, so pass a written table.
    """
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    least = max(2, -(-left.count() // share))
    hot = materialize(counts.where(F.col("__n") >= least).select(*keys), "hot_keys")
    hot_right = F.broadcast(right.join(F.broadcast(hot), keys, "left_semi"))
    warm = left.join(F.broadcast(hot), keys, "left_semi").join(hot_right, keys, how)
    cold = left.join(F.broadcast(hot), keys, "left_anti").join(right, keys, how)
    return warm.unionByName(cold)
