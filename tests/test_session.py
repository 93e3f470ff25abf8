import os

from verdigris import session
from verdigris.session import CHECKPOINT_CONF, ensure_checkpoint_dir, materialize, release_scratch


def test_materialize_writes_under_the_session_checkpoint_folder(spark):
    base = ensure_checkpoint_dir(spark)
    configured = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        assert configured.rstrip("/").split(":")[-1] in base
    df = materialize(spark.range(10).withColumnRenamed("id", "x"), "unit")
    files = df.inputFiles()
    assert files and all(base.rstrip("/").split(":")[-1] in f for f in files)
    assert df.count() == 10


def test_checkpoint_is_reliable_not_local(spark):
    base = ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == base
    assert spark.range(5).checkpoint().count() == 5


def test_release_scratch_deletes_own_tables_only(spark, tmp_path, monkeypatch):
    own, other = str(tmp_path / "own"), tmp_path / "other"
    monkeypatch.setattr(session, "_own_tables", lambda s: own)
    materialize(spark.range(3), "unit")
    spark.range(3).write.parquet(str(other))
    assert os.path.isdir(own)
    release_scratch(spark)
    assert not os.path.exists(own) and other.is_dir()
    release_scratch(spark)  # nothing left to delete
