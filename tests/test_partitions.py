from pyspark.sql import functions as F
from pyspark.ml.functions import array_to_vector
from verdigris.operators import train as TR
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from verdigris.operators import partitions as PT


def test_profile_totals(spark):
    df = spark.range(1000)
    p = PT.partition_profile(df, 8).first()
    assert p["n_partitions"] == 8 and p["total_rows"] == 1000
    assert p["max_partition_rows"] >= p["min_partition_rows"]


def test_guard_reason_text():
    assert PT.sweep_guard(9) == "Only 9 training rows – too few"
    assert PT.sweep_guard(10) is None


def test_sweep_records_and_skips(spark):
    rows = [(float(i % 2), Vectors.dense([float(i % 2), 1.0])) for i in range(40)]
    train = spark.createDataFrame(rows, ["label_index", "features"])
    test = train.limit(6)

    def pipe():
        return Pipeline(stages=[LogisticRegression(maxIter=5, regParam=0.1)
                                .setLabelCol("label_index")])

    out = PT.partition_sweep(train, test, pipe, (2, 4), warmup=False).collect()
    assert [r["n_partitions"] for r in out] == [2, 4]
    assert all(not r["skipped"] and r["train_rows"] == 40 and r["accuracy"] == 1.0 for r in out)
    tiny = PT.partition_sweep(train.limit(9), test, pipe, (2,), warmup=False).first()
    assert tiny["skipped"] and tiny["reason"] == "Only 9 training rows – too few"
    assert tiny["train_time_sec"] is None


def test_guard_rows_per_group(spark):
    df = spark.createDataFrame([("a", "train")] * 12 + [("b", "train")] * 3 + [("b", "test")],
                               "g string, split string")
    out = {r["g"]: r for r in PT.guard_rows(df, "split", ("g",)).collect()}
    assert not out["a"]["skipped"] and out["b"]["skipped"]
    assert out["b"]["reason"] == "Only 3 training rows – too few" and out["b"]["test_rows"] == 1


def test_profile_counts_empty_partitions(spark):
    narrow = spark.range(0, 1000, numPartitions=1)
    p = PT.partition_profile(narrow, 4).first()
    assert p["n_partitions"] == 4 and p["total_rows"] == 1000 and p["skew"] >= 1.0
    one = narrow.repartition(8, F.lit(1))  # every row in one of eight partitions
    p = PT.partition_profile(one).first()
    assert (p["n_partitions"], p["min_partition_rows"], p["max_partition_rows"]) == (8, 0, 1000)
    assert p["skew"] == 8.0


def test_fit_depends_on_rows_and_parameters_only(spark):
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("path"), (F.col("id") % 3).cast("double").alias("label_index"),
        array_to_vector(F.array(*[(F.xxhash64("id", F.lit(i)) % 100 / 100.0) for i in range(8)])).alias("features"))
    base = rows.persist()

    def predictions(train):
        model = TR.fit_preset(TR.RANDOM_FOREST, train, num_partitions=4).model
        return [r[0] for r in model.transform(rows).orderBy("path").select("prediction").collect()]

    want = predictions(rows)
    assert predictions(base) == want
    assert predictions(rows.repartition(3)) == want
    assert predictions(rows.repartition(11)) == want
    base.unpersist()


def test_partitions_follow_the_size_of_the_rows_alone(spark, monkeypatch):
    from verdigris.operators import partitions as PT
    from verdigris.operators import train as TR
    df = spark.range(1000).select(F.col("id").alias("path"), (F.col("id") % 2).cast("double").alias("label_index"),
                                  array_to_vector(F.array(*[(F.col("id") * k % 7).cast("double") for k in range(8)])).alias("features"))
    assert PT.partitions_for(df) == PT.partitions_for(df.repartition(9)) == 1 and PT.partitions_for(df.limit(0)) == 1
    monkeypatch.setattr(PT, "SMALL_PART", 20_000)  # 64,000 bytes
    assert PT.partitions_for(df) == 4
    monkeypatch.setattr(PT, "FEW_PARTS", 2)
    assert PT.partitions_for(df) == 2
    monkeypatch.setattr(PT, "LARGE_PART", 10_000)
    assert PT.partitions_for(df) == 7
    assert PT.keyed_partitions(df).rdd.getNumPartitions() == 7
    assert TR.fit_preset(TR.NAIVE_BAYES, df).num_partitions == 7


def test_narrow_training_rows_are_cut_by_their_number(spark):
    df = spark.range(1_200_000).select("id", array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    assert PT.partitions_for(df.limit(500_000)) == 1 and PT.partitions_for(df) == 3  # 9.6 MB of doubles
    sizes = PT.partition_profile(PT.keyed_partitions(df)).first()
    assert sizes["n_partitions"] == 3 and sizes["total_rows"] == 1_200_000
    assert sizes["max_partition_rows"] <= 1.1 * PT.MOST_ROWS


def test_sweep_after_an_observed_write(spark, tmp_path):
    from verdigris.sources import write_counted
    write_counted(spark.range(5).toDF("k"), str(tmp_path / "t"), {"n": F.count(F.lit(1))})
    train = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i % 2), 1.0])) for i in range(40)], ["label_index", "features"])
    for pipe in (lambda: LogisticRegression(labelCol="label_index"), lambda: Pipeline(stages=[LogisticRegression(labelCol="label_index")])):
        assert [r["accuracy"] for r in PT.partition_sweep(train, train, pipe, (2,), warmup=False).collect()] == [1.0]
