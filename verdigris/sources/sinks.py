"""Sinks: table writes (any format, counted, by step), JSON exports of small tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, **options) -> None:
    """Write ``df`` (overwrite by default); ``partition_by`` enables partition
    pruning on read (e.g. ``split``)."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_counted(df: DataFrame, path: str, counts: dict[str, Column], fmt: str = "parquet",
                  mode: str = "overwrite", partition_by: Sequence[str] | None = None) -> dict:
    """Write ``df`` and return ``counts`` (name -> aggregate) of its rows, observed
    by the writing job itself: no further pass over the data."""
    seen = Observation()
    write_table(df.observe(seen, *[c.alias(n) for n, c in counts.items()]), path, fmt, mode, partition_by)
    return seen.get


def write_step(df: DataFrame, path: str, step: str | int, column: str = "step",
               partition_by: Sequence[str] = ()) -> None:
    """Write one step's rows as their own part of a table, replacing what an
    earlier attempt of the same step left and nothing else.

    A step that failed or was lost can be run again: its rows are there once, and
    none of the earlier attempt's if it has none now.  Steps are told apart by
    ``column``, a partition column of the table; a step's name holds letters,
    digits, ``_``, ``.`` and ``-``."""
    if not re.fullmatch(r"[\w.-]+", str(step)):
        raise ValueError(f"not a name of a step: {step!r}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path.rstrip('/')}/{column}={step}")


def write_json_map(df: DataFrame, path: str, key: str = "label_index",
                   value: str = "label") -> None:
    """Write a key -> value table as one JSON object ``{"0": "RS_LB", ...}``.

    Built with ``map_from_entries`` in one aggregation; meant for tables bounded
    by the number of classes.
    """
    entries = F.struct(F.col(key).cast("int").alias("k"), F.col(value).alias("v"))
    obj = (df.select(entries.alias("e"))
             .agg(F.sort_array(F.collect_list("e")).alias("es"))
             .select(F.to_json(F.map_from_entries(F.transform(
                 "es", lambda e: F.struct(e["k"].cast("string"), e["v"])))).alias("value")))
    obj.coalesce(1).write.mode("overwrite").text(path)


def export_results(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Append (or overwrite) a results table such as model metrics or a
    partition sweep; one small file per call."""
    df.coalesce(1).write.format(fmt).mode(mode).save(path)


def write_json_object(df: DataFrame, key_col: str, path: str, order_col: str | None = None) -> None:
    """Write a small table (one row per model or class) as one JSON object
    ``{key: {other columns...}, ...}``; built with ``map_from_entries`` in one
    aggregation.  Entries come in the order of ``order_col`` (default: by key),
    which is not written itself."""
    order = order_col or key_col
    values = [c for c in df.columns if c not in (key_col, order_col)]
    entry = F.struct(F.col(order).alias("o"), F.col(key_col).cast("string").alias("k"), F.struct(*values).alias("v"))
    obj = (df.select(entry.alias("e"))
             .agg(F.array_sort(F.collect_list("e"), lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)).alias("es"))
             .select(F.to_json(F.map_from_entries(F.transform("es", lambda e: F.struct(e["k"], e["v"])))).alias("value")))
    obj.coalesce(1).write.mode("overwrite").text(path)
