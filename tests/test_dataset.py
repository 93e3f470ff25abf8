import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from verdigris.operators import dataset as D


def _skewed(spark, n_hot=3000, others=(400, 120, 37)):
    rows = [(i, "hot") for i in range(n_hot)]
    start = n_hot
    for k, n in enumerate(others):
        rows += [(start + i, f"c{k}") for i in range(n)]
        start += n
    return spark.createDataFrame(rows, "key long, label string")


def _brute_first_n(df, quota_by_label, seed=42):
    w = Window.partitionBy("label").orderBy(D.order_hash("key", seed), "key")
    ranked = df.withColumn("r", F.row_number().over(w))
    q = df.sparkSession.createDataFrame(list(quota_by_label.items()), "label string, quota long")
    return {r[0] for r in ranked.join(q, "label").where("r <= quota").select("key").collect()}


@pytest.mark.parametrize("bits", [4, 8, 14])
def test_first_n_per_class_equals_window_rank(spark, bits):
    df = _skewed(spark)
    quota = {"hot": 74, "c0": 400, "c1": 5, "c2": 0}
    qdf = spark.createDataFrame(list(quota.items()), "label string, quota long")
    got = {r[0] for r in D.first_n_per_class(df, "label", "key", qdf, 42, bits)
           .select("key").collect()}
    assert got == _brute_first_n(df, quota)


def test_balance_exact_meets_cap_exactly(spark):
    # S6: cap = 2 x smallest class, met exactly; small classes keep every row
    df = _skewed(spark)
    out = D.balance_exact(df, "label", "key")
    counts = {r["label"]: r["n"] for r in D.class_distribution(out).collect()}
    assert counts == {"hot": 74, "c0": 74, "c1": 74, "c2": 37}
    # same rows whatever the partitioning
    again = D.balance_exact(df.repartition(7), "label", "key")
    assert sorted(r[0] for r in out.select("key").collect()) == \
        sorted(r[0] for r in again.select("key").collect())


def test_balance_drops_null_labels(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "key long, label string")
    assert D.balance_exact(df, "label", "key").where("label is null").count() == 0


def test_balance_bernoulli_keeps_small_classes(spark):
    df = _skewed(spark)
    out = D.balance_bernoulli(df, "label")
    counts = {r["label"]: r["n"] for r in D.class_distribution(out).collect()}
    assert counts["c2"] == 37
    assert 20 < counts["hot"] < 140


def test_hash_split_is_partition_independent(spark):
    # S13 fixed: membership depends on (seed, key) only
    df = spark.range(5000).withColumnRenamed("id", "key")
    a = D.hash_split(df, "key").where("split = 'train'").select("key")
    b = D.hash_split(df.repartition(3), "key").where("split = 'train'").select("key")
    c = D.hash_split(df.repartition(11), "key").where("split = 'train'").select("key")
    sa = {r[0] for r in a.collect()}
    assert sa == {r[0] for r in b.collect()} == {r[0] for r in c.collect()}
    assert 0.77 < len(sa) / 5000 < 0.83
    assert D.split_threshold_hex(0.8) == "cccccccc"


def test_stratified_split_puts_every_class_on_both_sides(spark):
    df = _skewed(spark, 500, (50, 10, 3))
    out = D.stratified_hash_split(df, "label", "key", 0.8)
    c = {(r["label"], r["split"]): r["n"]
         for r in out.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    assert c[("hot", "train")] == 400 and c[("c1", "train")] == 8 and c[("c2", "train")] == 2
    assert c[("c2", "test")] == 1


def test_label_order_matches_string_indexer(spark):
    # S8: frequency desc, ties by code point (RS_LB < RS_Late)
    labels = ["RS_Late", "RS_Late", "RS_LB", "RS_LB", "a", "a", "b", "b", "Z", None]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    m = [r["label"] for r in D.label_map(df).orderBy("label_index").collect()]
    assert m == ["RS_LB", "RS_Late", "a", "b", "Z"]
    indexed, model = D.index_labels(df)
    assert model.labels == m
    assert indexed.count() == 9  # the NULL row is dropped


def test_join_on_basename_first_and_strict(spark):
    meta = spark.createDataFrame(
        [("file:/a/x.png", "A"), ("file:/b/x.png", "B"), ("file:/c/", "C"), ("file:/a/y.png", "Y")],
        "path string, label string")
    feats = spark.createDataFrame(
        [("file:/z/x.png", 1), ("file:/q/x.png", 2), ("file:/z/y.png", 3), ("file:/z/", 4)],
        "path string, f int")
    out = D.join_on_basename(meta, feats)
    got = sorted((r["path"], r["f"]) for r in out.collect())
    # every metadata row matches at most once (lowest feature path wins); "" never joins
    assert got == [("file:/a/x.png", 2), ("file:/a/y.png", 3), ("file:/b/x.png", 2)]
    with pytest.raises(D.DuplicateKeyError):
        D.join_on_basename(meta, feats, duplicates="error")


def test_require_rows_and_union(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(D.EmptyResultError):
        D.require_rows(empty)
    one = spark.createDataFrame([(1,)], "a int")
    assert D.union_all([one, one, one]).count() == 3


def test_first_n_per_class_without_broadcast(spark):
    df = _skewed(spark)
    quota = {"hot": 74, "c0": 400, "c1": 5, "c2": 0}
    qdf = spark.createDataFrame(list(quota.items()), "label string, quota long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r[0] for r in D.first_n_per_class(df, "label", "key", qdf, 42, 8)
               .select("key").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == _brute_first_n(df, quota)


def test_first_n_per_class_with_repeated_keys_meets_quota(spark):
    rows = [(i % 50, "a") for i in range(300)] + [(i, "b") for i in range(40)]
    df = spark.createDataFrame(rows, "key long, label string")
    q = spark.createDataFrame([("a", 77), ("b", 10)], "label string, quota long")
    out = D.first_n_per_class(df, "label", "key", q, 42, 4)
    counts = {r["label"]: r["n"] for r in D.class_distribution(out).collect()}
    assert counts == {"a": 77, "b": 10}
    flagged = D.rank_within_quota(df, "label", "key", q, 42, 4, flag_col="keep")
    assert flagged.count() == 340 and flagged.where("keep").count() == 87


def test_hot_class_is_never_ranked_whole(spark):
    # one class holds a third of 150k rows; only its cut bucket is windowed
    n = 150_000
    df = spark.range(n).select(F.col("id").alias("key"),
                               F.when(F.col("id") % 3 == 0, "hot")
                                .otherwise(F.concat(F.lit("c"), (F.col("id") % 97).cast("string")))
                                .alias("label"))
    stats = {}
    out = D.rank_within_quota(df, "label", "key",
                              D.class_distribution(df, "label").select(
                                  "label", F.lit(700).cast("long").alias("quota")),
                              stats=stats)
    counts = {r["label"]: r["n"] for r in D.class_distribution(out).collect()}
    assert counts["hot"] == 700 and all(v <= 700 for v in counts.values())
    assert stats["ranked_rows"] < 200  # vs 50,000 rows in the hot class


def test_balance_exact_same_rows_for_any_bucket_resolution(spark):
    df = _skewed(spark)
    a = {r[0] for r in D.balance_exact(df, "label", "key").select("key").collect()}
    b = {r[0] for r in D.balance_exact(df, "label", "key", bucket_bits=24).select("key").collect()}
    c = {r[0] for r in D.balance_exact(df, "label", "key", bucket_bits=4).select("key").collect()}
    assert a == b == c


def test_exact_balance_keeps_null_keys_within_the_cap(spark):
    df = spark.createDataFrame([("a", None if i % 5 == 0 else f"k{i}") for i in range(200)]
                               + [("b", f"b{i}") for i in range(30)], "label string, key string")
    kept = {r["label"]: r["n"] for r in D.balance_exact(df, "label", "key", factor=2).groupBy("label")
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert kept == {"a": 60, "b": 30}


def test_first_join_never_fans_out(spark):
    right = spark.createDataFrame([("a", 1, 10), ("a", 2, 11), ("b", 2, 12), ("b", 3, 13), ("c", 1, 14), ("c", 1, 15)],
                                  "key string, ord int, v int")
    left = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "key string")
    got = sorted((r["key"], r["ord"]) for r in D.join_on_key(left, right, "key", "ord").collect())
    assert got == [("a", 1), ("b", 2), ("c", 1)]


def test_cut_among_repeated_keys_depends_on_rows_only(spark):
    """The cut falls among rows of one key, and among equal rows: the same rows whatever the partitioning."""
    rows = ([("a", None, i % 40) for i in range(400)] + [("a", "k", 1)] * 30 + [("b", "x", i) for i in range(45)]
            + [("b", "x", 7)] * 15 + [("c", "z", 0)] * 20)
    df = spark.createDataFrame(rows, "label string, key string, v int")
    picked = [sorted(map(tuple, D.balance_exact(df.repartition(n), "label", "key", bucket_bits=bits).collect()), key=repr)
              for n, bits in ((1, 14), (5, 4), (11, 8))]
    assert picked[0] == picked[1] == picked[2]
    assert [sum(r[0] == x for r in picked[0]) for x in "abc"] == [40, 40, 20]
    flagged = D.rank_within_quota(df, "label", "key", spark.createDataFrame([("a", 33), ("c", 0)], "label string, quota long"), flag_col="keep")
    assert sorted(map(tuple, flagged.drop("keep").collect()), key=repr) == sorted(rows, key=repr)
    assert {r[0]: r[1] for r in flagged.where("keep").groupBy("label").count().collect()} == {"a": 33, "b": 60}


def test_global_rank(spark):
    from verdigris.operators.ranking import global_rank
    df = spark.range(5000).select((F.col("id") % 700).alias("a"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("b")).repartition(6)
    got = global_rank(df, [F.col("a").desc(), F.col("b").asc_nulls_last()]).orderBy("rank").collect()
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert [r["rank"] for r in got] == list(range(5000)) and [(r["a"], r["b"]) for r in got] == want
    assert global_rank(df.limit(0), [F.col("a")]).count() == 0


def test_index_by_rank_equals_string_indexer(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 > 0, F.concat(F.lit("l"), F.col("id") % 1500))
                                  .alias("label"))
    want, _ = D.index_labels(df)
    got = D.index_by_rank(df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().toString() + D.label_map(df)._jdf.queryExecution().toString()
    assert "Window" not in plan
    assert D.index_by_rank(df.where("label IS NULL")).count() == 0
