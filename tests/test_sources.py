import io
import json
from contextlib import redirect_stdout

import numpy as np

from tests.conftest import SF_SMALL, write_png
from verdigris.functions import labels as L
from verdigris.operators import train as TR
from verdigris.plans.ingest import image_metadata
from verdigris.plans.registry import ModelRegistry
from verdigris.sources import export_results, json_table, read_table, rows_table, write_json_map
from verdigris.sources.files import binary_files
from verdigris.sources.tables import map_table


def plan_of(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_read_table_prunes_and_declares(spark):
    df = read_table(spark, f"{SF_SMALL}/documents.parquet", columns=["doc_id", "lang"])
    assert df.columns == ["doc_id", "lang"]
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan_of(df)
    lab = read_table(spark, f"{SF_SMALL}/labels.parquet",
                     schema="doc_id bigint, quality int, toxic int")
    assert lab.count() > 0


def test_metadata_scan_does_not_read_file_bodies(spark, tmp_path):
    write_png(str(tmp_path / "a" / "x___RS_LB 1.png"), np.zeros((2, 2), np.uint8))
    meta = image_metadata(spark, str(tmp_path))
    read_schema = plan_of(meta).split("ReadSchema:")[1].split("\n")[0]
    assert "content" not in read_schema and "path" in read_schema
    assert meta.first()["label"] == "RS_LB"
    assert binary_files(spark, str(tmp_path), glob="*.jpg").count() == 0


def test_label_map_json_round_trip(spark, tmp_path):
    lm = rows_table(spark, [(0.0, "RS_LB"), (1.0, "RS_Late"), (10.0, "UF")],
                    "label_index double, label string")
    write_json_map(lm, str(tmp_path / "lm.json"))
    obj = json.loads(spark.read.text(str(tmp_path / "lm.json")).first()[0])
    assert obj == {"0": "RS_LB", "1": "RS_Late", "10": "UF"}
    with open(tmp_path / "side.json", "w") as f:
        json.dump(obj, f, indent=2)
    side = json_table(spark, str(tmp_path / "side.json"))
    assert side.first()["10"] == "UF"
    back = map_table(spark, obj)
    assert {r["label"] for r in back.collect()} == {"RS_LB", "RS_Late", "UF"}


def test_export_results_appends(spark, tmp_path):
    df = rows_table(spark, [("LR", 0.2)], "model string, accuracy double")
    export_results(df, str(tmp_path / "res"))
    export_results(df, str(tmp_path / "res"))
    assert spark.read.parquet(str(tmp_path / "res")).count() == 2


def test_registry_keeps_latest_row_per_model(spark, tmp_path):
    from pyspark.ml.linalg import Vectors
    train = spark.createDataFrame([(float(i % 2), Vectors.dense([i % 2, 1.0])) for i in range(20)],
                                  ["label_index", "features"])
    fit = TR.fit_preset(TR.NAIVE_BAYES, train)
    reg = ModelRegistry(spark, str(tmp_path / "reg"))
    reg.save(TR.NAIVE_BAYES, fit.model, {"accuracy": 0.5}, 3)
    reg.save(TR.NAIVE_BAYES, fit.model, {"accuracy": 0.9}, 3)
    t = reg.table().collect()
    assert len(t) == 1 and t[0]["accuracy"] == 0.9 and t[0]["model_key"] == "Naive_Bayes"
    loaded = reg.load("Naive Bayes")
    assert loaded.transform(train).count() == 20
    assert L  # keep import


def test_write_metadata_overwrites_with_declared_file_count(spark, tmp_path):
    from verdigris.plans.ingest import write_metadata
    for i in range(3):
        write_png(str(tmp_path / "img" / f"f{i}___RS_LB {i}.png"), np.zeros((2, 2), np.uint8))
    meta = image_metadata(spark, str(tmp_path / "img"))
    out = str(tmp_path / "meta")
    write_metadata(meta, out, num_files=2)
    write_metadata(meta, out, num_files=2)          # overwrite, not append
    back = read_table(spark, out)
    assert back.count() == 3 and len(back.inputFiles()) == 2
    assert set(back.columns) == {"path", "label", "length", "modificationTime"}
