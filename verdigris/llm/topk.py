"""Exact top-k inner products over integer components by MaxScore.

A component is a term. A shard of candidates has two postings lists per term, for
queries with a positive and with a negative weight: the rows whose value lies
above a base that three quarters of the rows do not exceed, with how far. A score
is at most the query's sum over the bases and over the impacts of the lists that
hold the row. Terms are ordered by their largest contribution; the smallest ones,
which cannot reach the threshold together, are not essential. The essential lists
are traversed; of the rows found, the other terms are probed, largest first, while
a row can still reach the threshold, and what is left is scored exactly.

The first shard has no threshold and scores all its rows. The k-th best score that
it finds for a query is the threshold that the query brings to the others.
Vectors are sent to their shard once, queries to every shard; shards' results are
merged by one aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.session import materialize

SHARD_ROWS, FIRST_QUERIES = 16384, 4096  # rows of a shard, and queries of a task of the first shard, about
BASE = 0.75
EXACT = 1 << 52  # sums up to here are exact in doubles
FOUND = "query_id long, vec_id long, score long"


def impacts(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null unless all components are finite numbers."""
    x = F.transform(vector, lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(F.coalesce(sound, F.lit(False)), F.transform(x, lambda v: F.floor(v * scale)))


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows as int64; shorter vectors are filled up with zeros."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Shard:
    """Candidates and their postings: by sign and term the rows above the base, and their impacts."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.signed = (rows, -rows)
        self.base = np.stack([np.quantile(x, BASE, axis=0, method="lower") for x in self.signed]).astype(np.int64)
        self.docs, self.impacts = [], []
        for x, base in zip(self.signed, self.base):
            over = x - base
            at = [np.flatnonzero(over[:, t] > 0) for t in range(x.shape[1])]
            self.docs.append(at)
            self.impacts.append([over[d, t] for t, d in enumerate(at)])
        self.top = np.array([[i.max(initial=0) for i in lists] for lists in self.impacts], dtype=np.int64).reshape(self.base.shape)
        self.largest = int(np.abs(rows).max(initial=0))

    def candidates(self, query: np.ndarray, threshold: int) -> np.ndarray:
        """Rows that may score ``threshold`` or more; all that do are among them."""
        terms = np.flatnonzero(query)
        sign, weight = (query[terms] < 0).astype(int), np.abs(query[terms])
        base, most = int(weight @ self.base[sign, terms]), weight * self.top[sign, terms]
        order = np.argsort(most, kind="stable")
        upto = base + np.cumsum(most[order])
        split = int(np.searchsorted(upto, threshold, side="left"))  # the terms before it cannot reach the threshold
        essential, others = order[split:], order[:split]
        if not split and base >= threshold:  # rows that no list holds may reach it too
            return np.arange(len(self.ids))
        if not len(essential):
            return np.empty(0, dtype=np.int64)
        docs = [self.docs[sign[i]][terms[i]] for i in essential]
        gains = [self.impacts[sign[i]][terms[i]] * weight[i] for i in essential]
        found = np.bincount(np.concatenate(docs), weights=np.concatenate(gains), minlength=len(self.ids)).astype(np.int64)
        alive = np.flatnonzero(found)
        rest = int(most[others].sum())
        for i in [None, *others[::-1]]:
            if i is not None:
                x = self.signed[sign[i]][alive, terms[i]] - self.base[sign[i], terms[i]]
                found[alive] += weight[i] * np.maximum(x, 0)
                rest -= int(most[i])
            alive = alive[base + found[alive] + rest >= threshold]
        return alive

    def best(self, query: np.ndarray, k: int, own: int, threshold: int | None) -> list[tuple[int, int]]:
        """The k best (score, id) that reach the threshold, ties to smaller ids, without rows of the id ``own``."""
        rows = slice(None)
        if threshold is not None and int(np.abs(query).sum()) * self.largest * 2 < EXACT:
            rows = self.candidates(query, threshold)
        score, ids = self.rows[rows] @ query, self.ids[rows]
        at = np.flatnonzero((ids != own) & (score >= (np.iinfo(np.int64).min if threshold is None else threshold)))
        if len(at) > 4 * k:
            at = at[score[at] >= np.partition(score[at], -k)[-k]]  # with all ties
        at = at[np.lexsort((ids[at], -score[at]))[:k]]
        return list(zip(score[at].tolist(), ids[at].tolist()))


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = 5, scale: int = 256) -> DataFrame:
    """The k best other rows of every query row: query_id, rank, vec_id, score.

    Rows with a null id, a null vector or a null or non-finite component take
    no part. A query's own id is never its candidate, so neither are further
    rows of that id; every other row is a candidate, also if it repeats another.
    Of a query id's different vectors the smallest asks. Shorter vectors are filled
    up with zeros. Fewer candidates than k give fewer rows; an empty table none.
    """
    scaled = materialize(
        vectors.select(F.col(id_col).cast("long").alias("id"), impacts(F.col(vector_col), scale).alias("v"),
                       F.coalesce(is_query, F.lit(False)).alias("q"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull()).withColumn("row", F.monotonically_increasing_id()), "topk_vectors")
    size = scaled.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q"), F.max(F.size("v")).alias("w")).first()
    shards, width = max(1, -(-size["n"] // SHARD_ROWS)), size["w"] or 0
    rows = scaled.select(F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), "id", "v",
                         F.lit(None).cast("long").alias("least"))
    queries = materialize(scaled.where("q").groupBy("id").agg(F.min("v").alias("v")), "topk_queries")
    asked = lambda q, shard, least: q.select(shard.alias("shard"), F.lit(True).alias("asks"), "id", "v", least.alias("least"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, held, shard = None, [], [], None
        for b in batches:
            out = []
            columns = [b[c].to_pylist() for c in ("part", "asks", "id", "v", "least")]
            for part, asks, i, v, least in zip(*columns):
                if part != here:
                    here, ids, held, shard = part, [], [], None
                if not asks:
                    ids.append(i)
                    held.append(v)
                elif held:
                    if shard is None:
                        shard = Shard(np.array(ids), _matrix(held, width))
                    out += [(i, found, score) for score, found in shard.best(_matrix([v], width)[0], k, i, least)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 3)], ["query_id", "vec_id", "score"])

    def run(parts: DataFrame) -> DataFrame:
        return parts.repartition("part").sortWithinPartitions("part", "asks").select("part", "asks", "id", "v", "least").mapInArrow(search, FOUND)

    # the first shard, for some of the queries a task
    blocks = max(1, -(-size["q"] // FIRST_QUERIES))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    copies = rows.where("shard = 0").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    first = materialize(run(copies.unionByName(asked(queries, F.lit(0), F.lit(None).cast("long")).withColumn("part", block))), "topk_first")
    found = first
    if shards > 1:
        # the k-th best score so far; without k results there is none
        least = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
        known = queries.join(least.withColumnRenamed("query_id", "id"), "id", "left")
        everywhere = asked(known, F.explode(F.sequence(F.lit(1), F.lit(shards - 1))), F.col("least"))
        found = found.unionByName(run(rows.where("shard > 0").unionByName(everywhere).withColumn("part", F.col("shard"))))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
