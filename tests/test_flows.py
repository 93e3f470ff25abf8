"""Streams that are ended and run again, writes that are repeated, JSON rows, merged statistics."""

import glob
import json
import os

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from verdigris import catalog
from verdigris.operators import evaluate as EV
from verdigris.operators import merged as MG
from verdigris.operators import train as TR
from verdigris.plans.ingest import append_new
from verdigris.sources import json_rows, label_map_rows, write_counted, write_json_object, write_step
from verdigris.streaming import ingest_once, read_scored, score_to_tables


def _lose_last_commit(progress):
    """As if the driver was lost after the last batch had been written, before it was committed."""
    last = max((p for p in glob.glob(f"{progress}/commits/*") if os.path.basename(p).isdigit()), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def test_score_to_tables_survives_a_lost_commit(spark, tmp_path):
    images = catalog.embeddings_as_images(catalog.table(spark, "/root/testdata/sf0.001", "embeddings"), corrupt=True).withColumn(
        "label_index", F.col("label").cast("double"))
    arrivals, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    train = spark.createDataFrame([(float(i % 2), Vectors.dense([((i * 7 + j) % 5) / 5 for j in range(64)])) for i in range(40)],
                                  ["label_index", "features"])
    model = TR.fit_preset(TR.NAIVE_BAYES, train).model
    names = spark.createDataFrame([(0.0, "a"), (1.0, "b")], "label_index double, label string")
    rows = images.select("vec_id", "image")

    def run():
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(arrivals)
        score_to_tables(stream, model, names, "NB", out, progress, size=8, keep=("vec_id",)).awaitTermination()

    for third in range(3):
        rows.where(F.col("vec_id") % 3 == third).repartition(2).write.mode("append").parquet(arrivals)
        run()
        _lose_last_commit(progress)
    run()
    scores, rejects = read_scored(spark, out, "scores"), read_scored(spark, out, "rejects")
    bad = images.where("label IN (0, 1)").count()
    assert scores.count() == scores.select("vec_id").distinct().count() == images.count() - bad
    assert rejects.count() == rejects.select("vec_id").distinct().count() == bad
    assert {r[0] for r in scores.select("prediction_label").distinct().collect()} <= {"a", "b"}
    assert {r[0] for r in rejects.select("reason").distinct().collect()} == {"size_mismatch", "unsupported_channels"}
    assert scores.where("confidence IS NULL").count() == 0 and "reason" in rejects.columns


@pytest.mark.parametrize("watermark", [None, "arrived"])
def test_ingest_once(spark, tmp_path, watermark):
    """Repeats in one file, in the next batch, long after the watermark, and a re-delivered file: each key once."""
    arrivals, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "key string, v int, arrived timestamp"
    drops = [[("a", 1, "2024-01-01 00:00:00"), ("a", 2, "2024-01-01 00:00:01"), ("b", 3, "2024-01-01 00:10:00"), (None, 4, "2024-01-01 00:00:00")],
             [("a", 5, "2024-01-01 00:20:00"), ("c", 6, "2024-01-03 00:00:00")],
             [("d", 7, "2024-01-04 00:00:00"), ("b", 8, "2024-01-04 00:00:01")]]
    for drop in [*drops, drops[0]]:
        rows = spark.createDataFrame([(k, v, str(t)) for k, v, t in drop], "key string, v int, arrived string")
        rows.withColumn("arrived", F.to_timestamp("arrived")).coalesce(1).write.mode("append").parquet(arrivals)
        for lost in (True, False):
            stream = spark.readStream.schema(schema).parquet(arrivals)
            ingest_once(stream, out, progress, "key", "v", watermark).awaitTermination()
            if lost:
                _lose_last_commit(progress)
    got = spark.read.parquet(out)
    assert sorted(r["key"] for r in got.collect()) == ["a", "b", "c", "d"]
    assert got.where("key = 'b'").first()["v"] == 3


def test_append_new_run_again(spark, tmp_path):
    out = str(tmp_path / "t")
    rows = lambda *ks: spark.createDataFrame([(k, i) for i, k in enumerate(ks)], "path string, v int")
    for _ in range(2):
        append_new(rows("a", "b", "a", None), out, "path", "v", 0)
    for _ in range(2):
        append_new(rows("b", "c", "c", "d"), out, "path", "v", 1)
    append_new(rows("a", "b"), out, "path", "v", 2)  # nothing new
    append_new(rows("a", "b", "x"), out, "path", "v", 0)  # another first attempt replaces the first step alone
    got = sorted((r["step"], r["path"], r["v"]) for r in spark.read.parquet(out).collect())
    assert got == [(0, "a", 0), (0, "b", 1), (0, "x", 2), (1, "c", 1), (1, "d", 3)]


def test_a_step_that_fails_half_way_runs_again(spark, tmp_path):
    out = str(tmp_path / "steps")
    rows = spark.range(100).repartition(4)
    write_step(rows.where("id < 50"), out, "one")
    half = rows.where("id >= 50").withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_step(half, out, "two")
    for _ in range(2):
        write_step(rows.where("id >= 50"), out, "two")
    write_step(rows.where("id < 50"), out, "one")
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(100))
    write_step(rows.limit(0), out, "two")  # now it has no rows
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(50))
    with pytest.raises(ValueError):
        write_step(rows, out, "a/b")


def test_counted_write(spark, tmp_path):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    seen = write_counted(df, str(tmp_path / "t"), {"n": F.count(F.lit(1)), "zeros": F.count_if(F.col("k") == 0)}, partition_by=["k"])
    assert seen == {"n": 1000, "zeros": 334}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_json_objects_as_rows(spark, tmp_path):
    df = spark.createDataFrame([("z", 0, 0.5, [[1, 2], [0, 3]]), ("a", 1, None, [[1]]), ("é \"q\"", 2, 0.25, [])],
                               "model string, ord int, accuracy double, confusion_matrix array<array<long>>")
    write_json_object(df, "model", str(tmp_path / "r.json"), order_col="ord")
    obj = json.loads(spark.read.text(str(tmp_path / "r.json")).first()[0])
    assert list(obj) == ["z", "a", "é \"q\""] and obj["z"] == {"accuracy": 0.5, "confusion_matrix": [[1, 2], [0, 3]]}
    back = json_rows(spark, str(tmp_path / "r.json"), "struct<accuracy: double, confusion_matrix: array<array<bigint>>>", "model")
    assert [tuple(r) for r in back.orderBy("pos").collect()] == [
        (0, "z", 0.5, [[1, 2], [0, 3]]), (1, "a", None, [[1]]), (2, "é \"q\"", 0.25, [])]
    with open(tmp_path / "map.json", "w") as f:
        json.dump({"0": "RS_LB", "10": "UF"}, f, indent=2)
    assert sorted(map(tuple, label_map_rows(spark, str(tmp_path / "map.json")).collect())) == [(0.0, "RS_LB"), (10.0, "UF")]


def test_matrix_over_a_whole_label_map(spark):
    """Classes that occur neither as truth nor as prediction have a row and a column of zeros."""
    cells = EV.confusion_cells(spark.createDataFrame([(1.0, 1.0), (1.0, 3.0), (3.0, 1.0)], "label_index double, prediction double"))
    names = spark.createDataFrame([(float(i), f"c{i}") for i in range(4)], "label_index double, label string")
    r = EV.confusion_grid(cells, names).first()
    assert r["classes"] == ["c0", "c1", "c2", "c3"]
    assert r["confusion_matrix"] == [[0, 0, 0, 0], [0, 1, 0, 1], [0, 0, 0, 0], [0, 1, 0, 0]]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(3, 2, (500, 6)) * [1, 1e-4, 1e5, 1, 0, 2] + [0, 1e4, 0, 0, 7, 0]
    y = rng.integers(0, 3, 500)
    rows = [(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(y, x))] + [(900, 1, None), (901, None, [0.0] * 6)]
    return x, y, spark.createDataFrame(rows, "id int, label int, v array<double>")


def test_scaler_state_of_any_parts(spark, vectors, monkeypatch):
    x, _, df = vectors
    monkeypatch.setattr(MG, "FAN_IN", 3)  # a tree of several levels
    df = df.where("id <> 901")
    states = [MG.scaler_state(df.repartition(20), "v"),
              MG.merge_scaler_states(MG.scaler_state(df.where("id < 17"), "v"), MG.scaler_state(df.where("id < 0"), "v"),
                                     MG.scaler_state(df.where("id >= 17").repartition(5), "v"))]
    for state in states:
        r = state.collect()
        assert len(r) == 1 and r[0]["n"] == 500
        np.testing.assert_allclose(r[0]["lo"], x.min(axis=0))
        np.testing.assert_allclose(r[0]["hi"], x.max(axis=0))
        np.testing.assert_allclose(np.array(r[0]["m2"]) / 499, x.var(axis=0, ddof=1), rtol=1e-9, atol=1e-20)
    u = np.where(np.ptp(x, axis=0) > 0, (x - x.min(axis=0)) / np.where(np.ptp(x, axis=0) > 0, np.ptp(x, axis=0), 1), 0.5)
    sd = u.std(axis=0, ddof=1)
    want = np.where(sd > 1e-12, u / np.where(sd > 1e-12, sd, 1), 0.0)
    got = np.array([r["scaled_features"] for r in MG.scale_by_state(df, states[0], "v").where("v IS NOT NULL").orderBy("id").collect()])
    np.testing.assert_allclose(got, want, atol=1e-9)
    mm = np.array([r["u"] for r in MG.scale_by_state(df, states[0], "v", "minmax", out_col="u").orderBy("id").collect()])
    np.testing.assert_allclose(mm, u, atol=1e-12)
    assert MG.scaler_state(df.where("id < 0"), "v").count() == 0


def test_naive_bayes_follows_new_rows(spark, vectors):
    """Fitted on a part and brought up to date by the rest: as MLlib's pipeline fitted on all rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes

    from verdigris.functions.vectors import to_vector
    from verdigris.operators.features import minmax_stage
    _, _, df = vectors
    old, new = df.where("id < 40"), df.where("id >= 40 AND id <> 901")
    state = MG.merge_scaler_states(MG.scaler_state(old, "v"), MG.scaler_state(new, "v"))
    statistics = MG.merge_nb_statistics(MG.nb_statistics(old, "v", "label"), MG.nb_statistics(new, "v", "label"))
    known = df.where("v IS NOT NULL AND label IS NOT NULL")
    got = {r["id"]: r["prediction"] for r in MG.nb_predict(known, MG.nb_model(statistics, state), ["id"], "v").collect()}
    rows = known.select("id", F.col("label").cast("double").alias("label_index"), to_vector("v").alias("features"))
    fit = Pipeline(stages=[minmax_stage(), NaiveBayes(featuresCol="features_mm", labelCol="label_index", smoothing=1.0)]).fit(rows)
    assert got == {r["id"]: r["prediction"] for r in fit.transform(rows).collect()}


def test_rule_oracles_tell_models_apart(spark):
    """A model fitted on shuffled labels does not give the rule that the queries are checked against."""
    lines = catalog.table(spark, "/root/testdata/sf0.001", "lineitem").select(
        "l_orderkey", (F.col("l_linenumber") >= 4).cast("double").alias("truth"),
        catalog.to_vector(F.array(*[F.col(c).cast("double") for c in ("l_linenumber", "l_quantity", "l_discount")])).alias("features"))
    shuffled = lines.withColumn("label_index", (F.pmod(F.xxhash64("l_orderkey", "features"), F.lit(3)) == 0).cast("double"))
    for name in (TR.LOGISTIC_REGRESSION, TR.DECISION_TREE, TR.RANDOM_FOREST):
        out = TR.fit_preset(name, shuffled).model.transform(lines)
        assert out.where("prediction <> truth").count() > 0


def test_copartitioned_join_shuffles_nothing(spark, tmp_path):
    from verdigris.operators import dataset as D
    from verdigris.sources import write_bucketed
    rows = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 900).alias("path"), F.col("id").alias("v"))
    left = rows.withColumnRenamed("v", "a")
    want = sorted(map(tuple, D.join_on_key(left, rows, "path", "v").collect()))
    a = write_bucketed(left, str(tmp_path / "a"), "path", 4)
    b = write_bucketed(rows, str(tmp_path / "b"), "path", 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("first", "unique"):
            joined = D.join_on_key(a, b, "path", "v", how)
            assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
            if how == "first":
                assert sorted(map(tuple, joined.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_keyed_sampling_depends_on_keys_only(spark):
    from verdigris.operators import dataset as D
    df = spark.range(20000).select("id", F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 2 == 0, "half").otherwise("most").alias("label"))
    picked = [sorted(r["id"] for r in D.balance_bernoulli_keyed(df.repartition(n), "label", "id").collect()) for n in (2, 7)]
    assert picked[0] == picked[1]
    counts = {r[0]: r[1] for r in D.balance_bernoulli_keyed(df, "label", "id").groupBy("label").count().collect()}
    assert counts["rare"] == 2000 and all(3700 < counts[c] < 4300 for c in ("half", "most"))
