"""Sharding by a k-d tree over document metadata (DataFrame functions only).

A node with k leaves is split at the weighted quantile floor(k/2)/k of its
bytes along its widest dimension. The quantile is found exactly by descending
a 48-bit position twelve bits at a time: each step is one aggregation to at
most 4,096 buckets per node, so no node is ever sorted or gathered, and only
one row per node reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdigris.llm.common import number_within
from verdigris.session import materialize

GRID_BITS, STEP_BITS = 16, 12
HASH_BITS, ROW_BITS = 32, 12  # of a tie: by the values of the row; among rows with equal values by a number of the row
TIE_BITS = HASH_BITS + ROW_BITS
POSITION_BITS = GRID_BITS + TIE_BITS


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _grid(name: str, kind: str, low, high) -> Column:
    """Grid coordinate of a dimension, 0 to 65,535; nulls lie at 0."""
    top = (1 << GRID_BITS) - 1
    if kind == "hash":
        cell = F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(top + 1))
    elif low is None or high is None or high <= low:
        cell = F.lit(0)
    else:
        x = F.col(name).cast("double")
        cell = F.floor((x - F.lit(float(low))) / F.lit(float(high) - float(low)) * top)
    return F.coalesce(cell.cast("long"), F.lit(0))


def _by_node(values: list) -> Column:
    """The entry of a constant list that belongs to the row's node."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("__node"))


def _split_level(rows: DataFrame, leaves: list[int], dims: list[str]) -> tuple[DataFrame, list[int]]:
    """Split every node that still has more than one leaf; new rows and leaves per node."""
    spans = {r["__node"]: r for r in rows.groupBy("__node").agg(
        F.sum("__size").alias("bytes"), *[(F.max(d) - F.min(d)).alias(d) for d in dims]).collect()}
    nodes = range(len(leaves))
    busy = [leaves[i] > 1 and i in spans for i in nodes]
    widest = [max(range(len(dims)), key=lambda d: spans[i][dims[d]]) if i in spans else 0 for i in nodes]
    goal = [spans[i]["bytes"] * (leaves[i] // 2) / leaves[i] if i in spans else 0.0 for i in nodes]
    prefix, below, last = [0] * len(leaves), [0] * len(leaves), [0] * len(leaves)
    position = F.shiftleft(F.get(F.array(*dims), _by_node(widest)), TIE_BITS) + F.col("__tie")
    placed = rows.withColumn("__pos", position)
    cum = Window.partitionBy("__node").orderBy("__bucket")
    for shift in range(POSITION_BITS - STEP_BITS, -1, -STEP_BITS):
        steps = (placed.where(_by_node(busy) & (F.shiftright("__pos", shift + STEP_BITS) == _by_node(prefix)))
                 .groupBy("__node", F.shiftright("__pos", shift).alias("__bucket"))
                 .agg(F.sum("__size").alias("__w"))
                 .withColumn("__cum", F.sum("__w").over(cum))
                 .where(F.col("__cum") >= _by_node([float(g - b) for g, b in zip(goal, below)]))
                 .groupBy("__node").agg(F.min(F.struct("__bucket", "__cum", "__w")).alias("s")))
        for r in steps.collect():
            i, s = r["__node"], r["s"]
            prefix[i], last[i] = s["__bucket"], s["__w"]
            below[i] += s["__cum"] - s["__w"]
    # the last position goes to the side that it brings nearer the goal
    cut = [prefix[i] + int(goal[i] - below[i] > last[i] / 2) for i in nodes]
    low, high, children = [], [], []
    for n in leaves:
        low.append(len(children))
        children += [n] if n == 1 else [n // 2, n - n // 2]
        high.append(len(children) - 1)
    child = F.when(F.col("__pos") < _by_node(cut), _by_node(low)).otherwise(_by_node(high))
    return materialize(placed.withColumn("__node", child).drop("__pos"), "kd_rows"), children


def kd_shards(df: DataFrame, size: Column, dims: dict[str, str], tie: list[str],
              target_bytes: int | None = None, n_shards: int | None = None,
              keep: dict[str, Column] | None = None) -> DataFrame:
    """Shard of every row by a k-d tree over ``dims``.

    ``dims`` maps a metadata column to ``"range"`` (numeric) or ``"hash"``
    (categories, equal values stay side by side); ``tie`` columns split rows of
    equal metadata, so a value held by a third of all rows is still cut in
    proportion. Give ``target_bytes`` of a leaf or the number of leaves.
    Returns the ``keep`` columns with ``size`` and ``shard``. Null dimensions
    lie at the low end; an empty table gives no rows; fewer rows than leaves
    leave some shards empty; repeated rows, which nothing tells apart, are dealt out
    as any others.
    """
    ranged = [d for d, kind in dims.items() if kind == "range"]
    seen = df.agg(F.count(F.lit(1)).alias("n"), *[F.min(F.col(d).cast("double")).alias(f"lo_{d}") for d in ranged],
                  *[F.max(F.col(d).cast("double")).alias(f"hi_{d}") for d in ranged]).first()
    names = {d: f"__dim{i}" for i, d in enumerate(dims)}
    narrow = df.select(
        *[c.alias(n) for n, c in (keep or {}).items()], size.alias("__size"),
        *[_grid(d, kind, seen[f"lo_{d}"] if kind == "range" else None,
                seen[f"hi_{d}"] if kind == "range" else None).alias(names[d]) for d, kind in dims.items()],
        (F.shiftleft(F.pmod(F.xxhash64(*tie), F.lit(1 << HASH_BITS)), ROW_BITS)
         + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << ROW_BITS))).alias("__tie"), F.lit(0).alias("__node"))
    rows = materialize(narrow, "kd_rows")
    if n_shards is None:
        total = rows.agg(F.sum("__size")).first()[0] or 0
        n_shards = max(1, math.ceil(total / target_bytes))
    leaves = [n_shards]
    while max(leaves) > 1:
        rows, leaves = _split_level(rows, leaves, list(names.values()))
    return rows.select(*(keep or {}), F.col("__size").alias("size"), F.col("__node").alias("shard"))


def shard_documents(docs: DataFrame, n_shards: int) -> DataFrame:
    """Documents in ``n_shards`` shards of nearly equal bytes, with gapless slots.

    Law ``bytes``: a shard's bytes differ from the mean by little more than one
    document. ``text_crc32`` of a null text is null. ``grown_shard`` is null,
    as it belongs to the law ``key``.
    """
    text = F.col("text")
    placed = kd_shards(
        docs, text_bytes(text), {"doc_id": "range", "n_chars": "range", "source": "hash", "lang": "hash"},
        ["doc_id", "text"], n_shards=n_shards,
        keep={"doc_id": F.col("doc_id"), "text_crc32": F.crc32(text.cast("binary"))})
    placed = materialize(placed, "kd_shards")
    slots = number_within(placed, ["shard"], ["doc_id", "text_crc32"], "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
