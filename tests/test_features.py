import pytest
from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors

from verdigris.functions.vectors import to_array
from verdigris.operators import features as FE


@pytest.fixture()
def vecs(spark):
    return spark.createDataFrame([(Vectors.dense([1, 5, 0]),), (Vectors.dense([3, 5, 0]),),
                                  (Vectors.dense([4, 5, 2]),)], ["features"])


def test_constant_feature_minmax_half_standard_zero(vecs):
    # S12
    mm = FE.minmax_stage("features", "mm").fit(vecs).transform(vecs)
    assert {r[0][1] for r in mm.select(to_array("mm")).collect()} == {0.5}
    st = FE.standard_stage("features", "st").fit(vecs).transform(vecs)
    assert {r[0][1] for r in st.select(to_array("st")).collect()} == {0.0}


def test_unit_clip_and_persistence(spark, vecs, tmp_path):
    clip = FE.UnitClip(inputCol="features", outputCol="c")
    out = [r[0] for r in clip.transform(vecs).select(to_array("c")).collect()]
    assert all(0.0 <= v <= 1.0 for row in out for v in row)
    model = Pipeline(stages=[clip]).fit(vecs)
    model.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel
    again = PipelineModel.load(str(tmp_path / "m")).transform(vecs)
    assert [r[0] for r in again.select(to_array("c")).collect()] == out


def test_scale_columns_matches_formula(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (5.0, 7.0)], "a double, b double")
    out = FE.scale_columns(df, ["a", "b"], "minmax").orderBy("a").collect()
    assert [r["a_mm"] for r in out] == [0.0, 0.5, 1.0]
    assert [r["b_mm"] for r in out] == [0.5, 0.5, 0.5]
    st = FE.scale_columns(df, ["a"], "standard").orderBy("a").collect()
    assert [r["a_std"] for r in st] == [0.5, 1.5, 2.5]
