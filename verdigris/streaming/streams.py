"""File-stream ingest and scoring.

Each micro-batch is the batch plan applied to newly arrived files; the checkpoint
records which files were processed, so a restarted query neither skips nor
repeats a file.  One output table is the Parquet sink's, which is exactly-once.
Where a batch goes to several tables, or is compared with what is written, it is
written under its batch id: a batch that runs again replaces its own rows.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from verdigris.functions.labels import LABEL_PATTERN
from verdigris.operators import pixels as PX
from verdigris.plans.ingest import append_new, metadata_from_files
from verdigris.plans.score import PREDICTED, score_images
from verdigris.sources.files import BINARY_SCHEMA, IMAGE_SCHEMA
from verdigris.sources.sinks import write_step


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    if interval:
        return writer.trigger(processingTime=interval)
    return writer


def image_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 glob: str | None = None) -> DataFrame:
    reader = spark.readStream.format("image").schema(IMAGE_SCHEMA) \
        .option("recursiveFileLookup", "true").option("dropInvalid", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def score_stream(spark: SparkSession, in_dir: str, model: PipelineModel,
                 label_map: DataFrame, model_name: str, out_dir: str, checkpoint: str,
                 size: int = PX.DEFAULT_SIZE, max_files_per_trigger: int | None = None,
                 available_now: bool = True, interval: str | None = None,
                 include_rejects: bool = True) -> StreamingQuery:
    """Score images as they arrive in ``in_dir``; append to Parquet ``out_dir``.
    Unreadable images are rows with their ``reason`` and no prediction (left
    out with ``include_rejects=False``); every image is decoded once."""
    scored = score_images(image_stream(spark, in_dir, max_files_per_trigger), model,
                          label_map, model_name, size=size, include_rejects=include_rejects)
    writer = (scored.writeStream.format("parquet").outputMode("append")
                    .option("checkpointLocation", checkpoint))
    return _trigger(writer, available_now, interval).start(out_dir)


def score_to_tables(images: DataFrame, model: PipelineModel, label_map: DataFrame, model_name: str,
                    out_dir: str, checkpoint: str, size: int = PX.DEFAULT_SIZE,
                    keep: tuple[str, ...] = (), available_now: bool = True,
                    interval: str | None = None) -> StreamingQuery:
    """Score a stream of image rows into two tables, ``scores`` and ``rejects``
    (see ``read_scored``), from one decode and one write a batch.

    The write of a batch replaces the batch's own part, so a batch that failed
    half way and runs again, or a restarted query, leaves every image once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = score_images(batch, model, label_map, model_name, size=size, keep=keep, include_rejects=True)
        kind = F.when(F.col("reason").isNull(), F.lit("scores")).otherwise(F.lit("rejects"))
        write_step(rows.withColumn("kind", kind), out_dir, batch_id, "batch", partition_by=["kind"])

    writer = images.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, interval).start()


def read_scored(spark: SparkSession, out_dir: str, kind: str) -> DataFrame:
    """``scores`` (predictions) or ``rejects`` (reasons) of ``score_to_tables``; the other's files are not read."""
    if kind not in ("scores", "rejects"):
        raise ValueError("kind must be 'scores' or 'rejects'")
    rows = spark.read.parquet(out_dir).where(F.col("kind") == kind)
    return rows.drop("kind", "reason") if kind == "scores" else rows.drop("kind", *PREDICTED)


def ingest_once(rows: DataFrame, out_dir: str, checkpoint: str, key: str, order_col: str,
                event_time: str | None = None, delay: str = "1 hour", available_now: bool = True,
                interval: str | None = None) -> StreamingQuery:
    """Append the rows of a stream to ``out_dir``, every ``key`` once whatever is delivered again.

    Repeats that arrive within ``delay`` of event time are dropped by the
    stream's own state, which the watermark bounds; later ones, and whole
    re-delivered files, are dropped by an anti-join with the keys written by
    earlier batches.  Rows without a key are left out."""
    if event_time:
        rows = rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])

    def write(batch: DataFrame, batch_id: int) -> None:
        append_new(batch, out_dir, key, order_col, batch_id, "batch")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, available_now, interval).start()


def ingest_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                  pattern: str = LABEL_PATTERN, max_files_per_trigger: int | None = None,
                  available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """Append metadata rows for newly arrived files (bodies are not read)."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_SCHEMA) \
        .option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.load(in_dir).select("path", "length", "modificationTime")
    meta = metadata_from_files(files, "name", pattern)
    writer = (meta.writeStream.format("parquet").outputMode("append")
                  .option("checkpointLocation", checkpoint))
    return _trigger(writer, available_now, interval).start(out_dir)


def stream_throughput(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Per micro-batch progress of a stream: ``batch_id, input_rows,
    input_rows_per_sec, processed_rows_per_sec, duration_ms`` (from the
    query's progress reports, i.e. measured execution, not planning time)."""
    rows = []
    for p in query.recentProgress:
        rows.append((int(p["batchId"]), int(p.get("numInputRows") or 0),
                     float(p.get("inputRowsPerSecond") or 0.0),
                     float(p.get("processedRowsPerSecond") or 0.0),
                     int((p.get("durationMs") or {}).get("triggerExecution") or 0)))
    return spark.createDataFrame(rows, "batch_id long, input_rows long, input_rows_per_sec double, "
                                       "processed_rows_per_sec double, duration_ms long")
