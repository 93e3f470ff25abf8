import os

import numpy as np
import pytest

from tests.conftest import write_png
from verdigris.operators import pixels as PX
from verdigris.plans.featurize import featurize
from verdigris.sources.files import image_files


@pytest.fixture(scope="module")
def image_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("imgs")
    rng = np.random.default_rng(7)
    write_png(str(d / "a" / "u1___RS_HL 0474.png"), rng.integers(0, 256, (4, 4, 3), dtype=np.uint8))
    write_png(str(d / "a" / "g___JR_B 1.png"), rng.integers(0, 256, (5, 3), dtype=np.uint8))
    write_png(str(d / "a" / "rgba___RS_LB 2.png"), rng.integers(0, 256, (6, 9, 4), dtype=np.uint8))
    write_png(str(d / "a" / "one___RS_LB 3.png"), np.full((1, 1, 3), 200, dtype=np.uint8))
    write_png(str(d / "a" / "flat___RS_LB 4.png"), np.full((64, 64), 77, dtype=np.uint8))
    write_png(str(d / "a" / "nolabel.png"), rng.integers(0, 256, (8, 8), dtype=np.uint8))
    os.makedirs(d / "a", exist_ok=True)
    with open(d / "a" / "bad___RS_HL 1.png", "wb") as f:
        f.write(b"this is not an image")
    return str(d)


def test_luma_fixed_point():
    bgr = np.array([[[0, 0, 255], [0, 255, 0], [255, 0, 0], [255, 255, 255], [0, 0, 0]]],
                   dtype=np.uint8)
    assert PX.luma(bgr).tolist() == [[76, 150, 29, 255, 0]]
    # alpha ignored
    bgra = np.concatenate([bgr, np.full((1, 5, 1), 9, np.uint8)], axis=2)
    assert PX.luma(bgra).tolist() == PX.luma(bgr).tolist()


def test_resize_properties():
    flat = np.full((37, 23), 131, dtype=np.uint8)
    for f in ("bicubic", "box"):
        assert (PX.resize_gray(flat, 64, 64, f) == 131).all()      # constant stays constant
    img = np.arange(64, dtype=np.uint8).reshape(8, 8)
    assert (PX.resize_gray(img, 8, 8) == img).all()                   # identity
    box = PX.resize_gray(img, 4, 4, "box").astype(int)
    blocks = img.astype(int).reshape(4, 2, 4, 2).sum(axis=(1, 3))
    assert (box == (blocks + 2) // 4).all()
    one = np.array([[200]], dtype=np.uint8)
    assert (PX.resize_gray(one, 64, 64) == 200).all()                 # up-scaling a 1x1
    # weights are normalised and symmetric
    w = PX.resample_weights(100, 64)
    assert np.allclose(w.sum(axis=1), 1.0)
    assert np.allclose(w, w[::-1, ::-1])


def test_bicubic_overshoot_is_clipped():
    step = np.zeros((1, 16), dtype=np.uint8)
    step[:, 8:] = 255
    out = PX.resize_gray(np.repeat(step, 4, axis=0), 4, 40)
    assert out.min() == 0 and out.max() == 255


def test_image_source_and_features(spark, image_dir):
    images = image_files(spark, image_dir)
    assert images.count() == 7
    rej = {os.path.basename(r["origin"]): r["reason"]
           for r in PX.image_rejects(images).collect()}
    assert rej == {"bad___RS_HL%201.png": "undecodable"}
    feats, rejects = featurize(spark, image_dir, size=64)
    rows = {os.path.basename(r["path"]): r["features"] for r in feats.collect()}
    assert len(rows) == 6 and all(len(v) == 4096 for v in rows.values())
    assert all(0.0 <= x <= 1.0 for v in rows.values() for x in v)
    assert set(rows["flat___RS_LB 4.png"]) == {np.float32(77) / np.float32(255)}
    assert set(rows["one___RS_LB 3.png"]) == {np.float32(200) / np.float32(255)}
    # raw path form (space, not %20) so it joins the binaryFile metadata
    assert "u1___RS_HL 0474.png" in rows
    assert [r["reason"] for r in rejects.collect()] == ["undecodable"]


def test_grayscale_operator_keeps_schema(spark, image_dir):
    g = PX.grayscale(image_files(spark, image_dir))
    r = {os.path.basename(x["image"]["origin"]): x["image"] for x in g.collect()}
    im = r["rgba___RS_LB%202.png"]
    assert (im["height"], im["width"], im["nChannels"], im["mode"]) == (6, 9, 1, PX.MODE_GRAY)
    assert len(im["data"]) == 54
    small = PX.resize(image_files(spark, image_dir), (3, 5), "box")
    assert {x["image"]["width"] for x in small.collect()} == {5}


def test_features_of_equals_kernel_chain():
    rng = np.random.default_rng(11)
    imgs = [rng.integers(0, 256, shape, dtype=np.uint8)
            for shape in [(30, 41, 3)] * 5 + [(7, 9, 1)] * 3 + [(64, 64, 4), (1, 1, 3)]]
    for f in ("bicubic", "box"):
        batched = PX.features_of(imgs, (16, 12), f)
        for img, got in zip(imgs, batched):
            want = PX.normalise(PX.resize_gray(PX.luma(img), 16, 12, f))
            assert np.array_equal(got, want)


def test_fixed_point_bicubic_close_to_float_reference():
    # two 8-bit passes in fixed point differ from one float resample by at most 1
    rng = np.random.default_rng(5)
    img = rng.integers(0, 256, (50, 70), dtype=np.uint8)
    got = PX.resize_gray(img, 20, 24).astype(int)
    wy, wx = PX.resample_weights(50, 20), PX.resample_weights(70, 24)
    ref = np.clip(np.floor(wy @ img.astype(float) @ wx.T + 0.5), 0, 255)
    assert np.abs(got - ref).max() <= 1


def test_featurize_to_decodes_once_and_keeps_rejects(spark, image_dir, tmp_path):
    from verdigris.plans.featurize import featurize_to
    feats, rejects = featurize_to(spark, image_dir, str(tmp_path / "f"), size=16, with_label=True)
    assert feats.count() == 6 and feats.where("features is null").count() == 0
    assert [r["reason"] for r in rejects.collect()] == ["undecodable"]
    labels = {r["label"] for r in feats.collect()}
    assert labels == {"RS_HL", "JR_B", "RS_LB", None}
    assert {len(r["features"]) for r in feats.collect()} == {256}


def test_a_batch_leaves_in_runs_of_bounded_size(spark, monkeypatch):
    import pandas as pd
    from pyspark.sql import functions as F

    runs = []
    frame = type(spark.range(0))
    keep = frame.mapInPandas
    monkeypatch.setattr(frame, "mapInPandas", lambda self, f, schema: runs.append(f) or keep(self, f, schema))
    image = F.struct(F.concat(F.lit("v"), "id").alias("origin"), F.lit(2).alias("height"), F.lit(2).alias("width"),
                     F.lit(1).alias("nChannels"), F.lit(0).alias("mode"), F.unhex(F.lit("00FF00FF")).alias("data"))
    df = spark.range(0, 3000, numPartitions=1).select("id", image.alias("image"))
    PX.image_features(df)
    PX.resize(df, 1024)
    n = 700  # at 64 x 64 pixels, 11 MB
    batch = pd.DataFrame({"id": range(n), "__origin": "v", "__height": 2, "__width": 2, "__nChannels": 1, "__mode": 0,
                          "__data": [b"\0\xff\0\xff"] * n})
    parts = list(runs[0](iter([batch, batch.iloc[:0]])))
    assert [i for p in parts for i in p["id"]] == list(range(n))
    assert len(parts) == 3 and max(sum(f.nbytes for f in p["features"]) for p in parts) <= PX.OUT_BATCH_BYTES
    parts = list(runs[1](iter([batch.iloc[:9]])))  # 1 MB each
    assert [i for p in parts for i in p["id"]] == list(range(9)) and [len(p) for p in parts] == [4, 4, 1]


def test_runs_keep_rows_that_are_large_or_have_no_image(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(PX, "OUT_BATCH_BYTES", 10)
    batch = pd.DataFrame({"__data": [None, b"", b"123", b"x" * 50, b"1", None, b"123456789"]})
    assert [list(r.index) for r in PX._runs(batch, None, 1)] == [[0, 1, 2], [3, 4, 5], [6]]
    assert [list(r.index) for r in PX._runs(batch, 11, 4)] == [[i] for i in range(7)]
    assert list(PX._runs(batch.iloc[:0], None, 1)) == []
