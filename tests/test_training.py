import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from verdigris import catalog
from verdigris.operators import dataset as D
from verdigris.operators import evaluate as EV
from verdigris.operators import train as TR
from verdigris.operators.decode import add_confidence


def test_confidence_rounding_and_missing_probability(spark):
    # S21
    df = spark.createDataFrame([(Vectors.dense([0.2, 0.7049, 0.0951]),)], ["probability"])
    assert add_confidence(df).first()["confidence"] == 70.5
    none = spark.createDataFrame([(1.0,)], "prediction double")
    assert add_confidence(none).first()["confidence"] is None


@pytest.fixture(scope="module")
def emb_split(spark):
    """``embeddings`` vectors with a learnable target: the position of the
    largest of the first 10 components.  (The table's own labels carry no
    signal: every preset scores at chance on held-out rows.)"""
    emb = catalog.table(spark, SF_CHECK, "embeddings")
    head = F.slice("embedding", 1, 10)
    feats = emb.select("vec_id",
                       (F.array_position(head, F.array_max(head)) - 1).cast("double")
                       .alias("label_index"),
                       catalog.to_vector("embedding").alias("features"))
    split = D.hash_split(feats, "vec_id", 0.8, 42).cache()
    return split.where("split = 'train'"), split.where("split = 'test'")


@pytest.mark.parametrize("name", TR.PRESET_ORDER)
def test_presets_beat_majority_rate(emb_split, name):
    train, test = emb_split
    majority = (test.groupBy("label_index").count().agg(F.max("count")).first()[0]
                / test.count())
    fit = TR.fit_preset(name, train)
    acc = EV.accuracy(fit.model.transform(test)).first()["accuracy"]
    assert acc > majority
    assert fit.train_time_sec > 0


def test_save_load_predicts_the_same(emb_split, tmp_path):
    train, test = emb_split
    model = TR.fit_preset(TR.LOGISTIC_REGRESSION, train).model
    model.write().overwrite().save(str(tmp_path / "lr"))
    again = PipelineModel.load(str(tmp_path / "lr"))
    a = {r["vec_id"]: (r["prediction"], tuple(r["probability"])) for r in
         model.transform(test).select("vec_id", "prediction", "probability").collect()}
    b = {r["vec_id"]: (r["prediction"], tuple(r["probability"])) for r in
         again.transform(test).select("vec_id", "prediction", "probability").collect()}
    assert a == b


def test_nb_pipeline_accepts_unseen_range(spark):
    # test rows outside the training min/max are clipped, so NB never sees negatives
    train = spark.createDataFrame([(0.0, Vectors.dense([1.0, 2.0])), (1.0, Vectors.dense([3.0, 1.0]))],
                                  ["label_index", "features"])
    test = spark.createDataFrame([(0.0, Vectors.dense([-5.0, 9.0]))], ["label_index", "features"])
    model = TR.fit_preset(TR.NAIVE_BAYES, train).model
    assert model.transform(test).count() == 1


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(sizes=st.lists(st.integers(1, 60), min_size=1, max_size=4),
       quotas=st.lists(st.integers(0, 70), min_size=4, max_size=4),
       seed=st.integers(0, 1000))
def test_rank_within_quota_matches_brute_force(spark, sizes, quotas, seed):
    rows, k = [], 0
    for c, n in enumerate(sizes):
        rows += [(k + i, f"c{c}") for i in range(n)]
        k += n
    df = spark.createDataFrame(rows, "key long, label string")
    q = spark.createDataFrame([(f"c{c}", quotas[c]) for c in range(len(sizes))],
                              "label string, quota long")
    got = {r[0] for r in D.first_n_per_class(df, "label", "key", q, seed, 4).select("key").collect()}
    w = Window.partitionBy("label").orderBy(D.order_hash("key", seed), "key")
    want = {r[0] for r in df.withColumn("r", F.row_number().over(w)).join(q, "label")
            .where("r <= quota").select("key").collect()}
    assert got == want
