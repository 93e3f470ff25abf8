import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import write_png
from verdigris.operators import train as TR
from verdigris.plans.featurize import featurize
from verdigris.plans.ingest import image_metadata, label_counts
from verdigris.plans.prepare import prepare, read_split, write_prepared
from verdigris.plans.registry import ModelRegistry
from verdigris.plans.score import score_images
from verdigris.plans.training import as_training_rows, train_and_compare
from verdigris.sources.files import image_files
from verdigris.streaming import ingest_stream, score_stream, stream_throughput


@pytest.fixture(scope="module")
def two_class_dir(tmp_path_factory):
    """40 gray 8x8 images, bright on the left (RS_Bright) or on the right
    (RS_Dark) half, plus one unlabelled image."""
    d = tmp_path_factory.mktemp("two")
    rng = np.random.default_rng(3)
    for i in range(40):
        bright = i % 2 == 0
        base = np.full((8, 8), 40)
        if bright:
            base[:, :4] = 200
        else:
            base[:, 4:] = 200
        px = np.clip(base + rng.integers(-30, 30, (8, 8)), 0, 255).astype(np.uint8)
        name = f"img{i:02d}___{'RS_Bright' if bright else 'RS_Dark'} {i}.png"
        write_png(str(d / ("day" if i < 20 else "night") / name), px)
    write_png(str(d / "misc" / "nolabel.png"), np.zeros((8, 8), np.uint8))
    return str(d)


@pytest.fixture(scope="module")
def trained(spark, two_class_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    meta = image_metadata(spark, two_class_dir)
    feats, rejects = featurize(spark, two_class_dir, size=8)
    prep = prepare(meta, feats, key="path", ratio=0.75, stratify=True)
    write_prepared(prep, f"{out}/prepared")
    train = as_training_rows(read_split(spark, f"{out}/prepared", "train"))
    test = as_training_rows(read_split(spark, f"{out}/prepared", "test"))
    reg = ModelRegistry(spark, f"{out}/registry")
    metrics, fits = train_and_compare(train, test, (TR.NAIVE_BAYES, TR.LOGISTIC_REGRESSION), reg)
    reg.save_label_map(prep.label_map)
    return dict(out=out, meta=meta, prep=prep, reg=reg, metrics=metrics, fits=fits)


def test_metadata_labels(trained):
    counts = {r["label"]: r["n"] for r in label_counts(trained["meta"]).collect()}
    assert counts == {"RS_Bright": 20, "RS_Dark": 20, None: 1}


def test_prepared_table_and_label_map(spark, trained):
    data = trained["prep"].data
    assert data.count() == 40  # the unlabelled image is dropped; classes are balanced
    split = {r["split"]: r["n"] for r in data.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert split == {"train": 30, "test": 10}
    labels = {r["label"] for r in trained["prep"].label_map.collect()}
    assert labels == {"RS_Bright", "RS_Dark"}
    text = spark.read.text(f"{trained['out']}/prepared/label_map.json").first()[0]
    assert set(json.loads(text).values()) == labels


def test_training_registry_and_best_model(trained):
    m = {r["model"]: r for r in trained["metrics"].collect()}
    assert m[TR.NAIVE_BAYES]["accuracy"] == 1.0
    assert m[TR.LOGISTIC_REGRESSION]["accuracy"] == 1.0
    reg = trained["reg"]
    assert reg.list() == ["Logistic_Regression", "Naive_Bayes"]
    assert reg.best().first()["model"] == TR.NAIVE_BAYES  # tie -> first registered


def test_batch_and_stream_scoring_agree(spark, two_class_dir, trained, tmp_path):
    reg = trained["reg"]
    model = reg.load(TR.NAIVE_BAYES)
    lm = reg.label_map()
    images = image_files(spark, two_class_dir)
    batch = score_images(images, model, lm, "Naive_Bayes", size=8)
    rows = {r["path"]: r for r in batch.collect()}
    assert len(rows) == 41
    for p, r in rows.items():
        if "___" in p:
            assert r["prediction_label"] == ("RS_Bright" if "Bright" in p else "RS_Dark")
        assert 50.0 <= r["confidence"] <= 100.0 and r["model_used"] == "Naive_Bayes"
    q = score_stream(spark, two_class_dir, model, lm, "Naive_Bayes", str(tmp_path / "scored"),
                     str(tmp_path / "ckpt"), size=8, max_files_per_trigger=15)
    q.awaitTermination()
    progress = stream_throughput(spark, q).collect()
    assert sum(r["input_rows"] for r in progress) == 41 and len(progress) >= 3
    streamed = spark.read.parquet(str(tmp_path / "scored"))
    assert {(r["path"], r["prediction_label"]) for r in streamed.collect()} == \
        {(p, r["prediction_label"]) for p, r in rows.items()}
    # a restarted stream finds nothing new and writes nothing twice
    q2 = score_stream(spark, two_class_dir, model, lm, "Naive_Bayes", str(tmp_path / "scored"),
                      str(tmp_path / "ckpt"), size=8)
    q2.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "scored")).count() == 41


def test_ingest_stream(spark, two_class_dir, tmp_path):
    q = ingest_stream(spark, two_class_dir, str(tmp_path / "meta"), str(tmp_path / "ck"),
                      max_files_per_trigger=10)
    q.awaitTermination()
    meta = spark.read.parquet(str(tmp_path / "meta"))
    assert meta.count() == 41
    assert meta.where("label is null").count() == 1
    assert set(meta.columns) == {"path", "label", "length", "modificationTime"}


def test_scoring_unknown_index_falls_back(spark):
    from verdigris.operators.decode import decode_prediction
    pred = spark.createDataFrame([(0.0,), (7.0,)], "prediction double")
    lm = spark.createDataFrame([(0.0, "RS_LB")], "label_index double, label string")
    out = {r["class_index"]: r["prediction_label"] for r in decode_prediction(pred, lm).collect()}
    assert out == {"0": "RS_LB", "7": "class_7"}
    assert os  # keep import


def test_prepare_without_metadata_join(spark, two_class_dir):
    from verdigris.plans.featurize import features_minmax_check
    feats, _ = featurize(spark, two_class_dir, size=8, with_label=True)
    prep = prepare(None, feats, ratio=0.75, stratify=True)
    assert prep.data.count() == 40
    assert {r["label"] for r in prep.label_map.collect()} == {"RS_Bright", "RS_Dark"}
    chk = features_minmax_check(feats).first()
    assert 0.0 <= chk["min_value"] <= chk["max_value"] <= 1.0 and chk["values"] == 41 * 64


def test_parallel_training_gives_the_same_metrics(spark, trained, two_class_dir):
    from verdigris.plans.prepare import read_split
    out = trained["out"]
    train = as_training_rows(read_split(spark, f"{out}/prepared", "train"))
    test = as_training_rows(read_split(spark, f"{out}/prepared", "test"))
    m, _ = train_and_compare(train, test, (TR.NAIVE_BAYES, TR.DECISION_TREE), parallel=2)
    seq, _ = train_and_compare(train, test, (TR.NAIVE_BAYES, TR.DECISION_TREE))
    pick = lambda df: sorted((r["model"], r["accuracy"], r["weighted_f1"]) for r in df.collect())
    assert pick(m) == pick(seq)


def test_build_and_train_flow(spark, two_class_dir, tmp_path):
    from verdigris.plans.flow import build_and_train
    res = build_and_train(spark, two_class_dir, str(tmp_path / "flow"), size=8,
                          presets=(TR.NAIVE_BAYES, TR.RANDOM_FOREST), stratify=True)
    m = {r["model"]: r for r in res.metrics.collect()}
    assert set(m) == {TR.NAIVE_BAYES, TR.RANDOM_FOREST}
    assert len(m[TR.NAIVE_BAYES]["confusion_matrix"]) == 2
    assert res.rejects.count() == 0
    assert res.registry.best().first()["accuracy"] >= 0.9
    saved = spark.read.json(str(tmp_path / "flow" / "results"))
    assert saved.count() == 2
    obj = json.loads(spark.read.text(str(tmp_path / "flow" / "results.json")).first()[0])
    assert list(obj) == [TR.NAIVE_BAYES, TR.RANDOM_FOREST]  # as registered
    assert list(obj[TR.NAIVE_BAYES]) == ["accuracy", "precision", "recall", "f1", "confusion_matrix", "train_time_sec"]


def test_scoring_reports_unreadable_images(spark, trained, tmp_path):
    d = tmp_path / "mixed"
    write_png(str(d / "ok___RS_Dark 1.png"), np.full((8, 8), 40, np.uint8))
    with open(d / "broken___RS_Dark 2.png", "wb") as f:
        f.write(b"not a png")
    reg = trained["reg"]
    out = score_images(image_files(spark, str(d)), reg.load(TR.NAIVE_BAYES), reg.label_map(),
                       "Naive_Bayes", size=8, include_rejects=True)
    rows = {os.path.basename(r["path"]): r for r in out.collect()}
    assert rows["broken___RS_Dark 2.png"]["reason"] == "undecodable"
    assert rows["broken___RS_Dark 2.png"]["prediction_label"] is None
    assert rows["ok___RS_Dark 1.png"]["reason"] is None
    assert rows["ok___RS_Dark 1.png"]["prediction_label"] in {"RS_Bright", "RS_Dark"}


def test_metadata_and_features_join_for_odd_file_names(spark, tmp_path):
    from verdigris.plans.prepare import join_metadata_features
    d = tmp_path / "odd"
    for name in ("a b___RS_LB 1.png", "p%20q___RS_LB 2.png", "plus+sign___RS_LB 3.png"):
        write_png(str(d / name), np.full((4, 4), 9, np.uint8))
    meta = image_metadata(spark, str(d))
    feats, _ = featurize(spark, str(d), size=4)
    joined = join_metadata_features(meta, feats)
    assert joined.count() == 3
    assert join_metadata_features(meta, feats, key="basename").count() == 3
