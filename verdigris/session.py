"""Session helpers.

Library code never creates a session: every operator takes DataFrames and uses
``df.sparkSession``.  ``local_session`` exists for tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "verdigris", extra_conf: dict | None = None) -> SparkSession:
    """A local session configured like a small cluster profile (tests, bench)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # a 64x64 image row is ~16 KB of pixels; keep Arrow batches small
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .config("spark.driver.memory", os.environ.get("VERDIGRIS_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder shared by the cluster")
        # local runs only (tests, benchmark): a scratch folder on this machine
        configured = tempfile.mkdtemp(prefix="verdigris-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for a written table."""
    return f"{_own_tables(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _own_tables(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/tables-{spark.sparkContext.applicationId}"


def release_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application has written with ``materialize``.

    For the end of a job: results that read them can no longer be used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_tables(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet in the shared checkpoint folder.

    The written table survives executor loss (unlike cached blocks) and later
    jobs re-read it instead of recomputing upstream shuffles.
    """
    spark = df.sparkSession
    path = scratch_table_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
