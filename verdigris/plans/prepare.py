"""Prepare: metadata ⋈ features -> balanced -> indexed -> split.

Returns one table with a ``split`` column (write it partitioned by split) and
the label map.  The labelled rows are written once before balancing, so no
later action re-runs the pixel pass or the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdigris.operators import dataset as D
from verdigris.session import materialize
from verdigris.sources.sinks import write_json_map, write_table


@dataclass
class Prepared:
    data: DataFrame        # path, label, features, label_index, split
    label_map: DataFrame   # label_index, label


def join_metadata_features(meta: DataFrame, feats: DataFrame, key: str = "path",
                           duplicates: str | None = None) -> DataFrame:
    """Labelled metadata ⋈ features (for metadata kept in a separate store).

    ``key='path'`` joins on the canonical full path, unique within a file
    listing, so it is a single shuffle join; ``key='basename'`` joins on the
    file name and keeps one feature row per name (``duplicates='first'``)."""
    labelled = D.labelled_only(meta.select("path", "label"))
    if key == "path":
        f = feats.withColumnRenamed("path", "__fpath").withColumn("path", F.col("__fpath"))
        joined = D.join_on_key(labelled, f, "path", "__fpath",
                               duplicates or "unique").drop("__fpath")
    elif key == "basename":
        # both sides hold canonical (already decoded) paths
        joined = D.join_on_basename(labelled, feats, "path", duplicates or "first", decode=False)
    else:
        raise ValueError("key must be 'path' or 'basename'")
    return joined


def prepare(meta: DataFrame | None, feats: DataFrame, key: str = "path", ratio: float = 0.8,
            factor: int = 2, seed: int = D.DEFAULT_SEED, stratify: bool = False,
            balance: bool = True) -> Prepared:
    """Balance, index and split labelled features.

    With ``meta=None`` the features already carry ``label`` (see
    ``featurize(..., with_label=True)``) and no join is needed; otherwise the
    metadata table is joined in first."""
    if meta is None:
        joined = D.labelled_only(feats)
    else:
        joined = join_metadata_features(meta, feats, key)
    joined = D.require_rows(joined, "no labelled feature rows: featurize and label first")
    # write the labelled rows once: balancing reads its input more than once
    # and must not recompute pixels or the join; the balanced result is then a
    # cheap deterministic query over the written table
    joined = materialize(joined, "labelled")
    rows = D.balance_exact(joined, "label", "path", factor, seed) if balance else joined
    indexer = D.fit_label_indexer(rows, "label", "label_index")
    indexed = indexer.transform(rows)
    if stratify:
        data = D.stratified_hash_split(indexed, "label", "path", ratio, seed)
    else:
        data = D.hash_split(indexed, "path", ratio, seed)
    return Prepared(data, D.indexer_label_map(indexer))


def write_prepared(prep: Prepared, out: str) -> None:
    """``out/data`` partitioned by split, ``out/label_map`` (Parquet) and
    ``out/label_map.json``."""
    write_table(prep.data, f"{out}/data", partition_by=["split"])
    write_table(prep.label_map, f"{out}/label_map")
    write_json_map(prep.label_map, f"{out}/label_map.json")


def read_split(spark, out: str, split: str) -> DataFrame:
    """One split; the ``split`` filter prunes partitions at the scan."""
    return spark.read.parquet(f"{out}/data").where(F.col("split") == split)
