"""Structured Streaming over landed change files.

* T1/T2/S5: a file stream of raw lines; each micro-batch goes through
  ``process_batch`` in ``foreachBatch``. The checkpoint records which
  files were read (incremental "bookmark"); checkpoint and epoch make the
  ledger's batch id, so a replayed epoch is skipped or re-applied
  idempotently, and another checkpoint's epochs are batches of their own. A
  failed sink fails the epoch, so the query replays it when started again.
* T3: replayed events dropped against the silver table by event key, however
  old they are (a watermark would drop late first-time events too).
* T5: 5-minute tumbling counts with a watermark, append mode.

Checkpoints live under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import hashlib
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.plans.batch_job import JobConfig, process_batch
from rowtide.sources.changelog import parse_change_lines, split_glued
from rowtide.operators.envelope import flatten_envelope
from rowtide.sinks.log import append_silver


def change_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def run_to_tables(spark: SparkSession, source: str, cfg: JobConfig, checkpoint: str,
                  max_files_per_trigger: int | None = None, available_now: bool = True,
                  processing_time: str | None = None):
    """Apply every new file to the sink tables; returns the query handle."""
    lines = change_line_stream(spark, source, max_files_per_trigger)
    cfg = replace(cfg, lease_seconds=0)  # the checkpoint admits one run, so what an earlier one holds is left over
    stream_id = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def apply(batch: DataFrame, epoch_id: int) -> None:
        process_batch(spark, batch, f"{stream_id}-epoch-{epoch_id}", cfg, raise_on_error=True)

    w = lines.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "15 minutes")
    return w.start()


def event_stream(spark: SparkSession, source: str, pk_columns, max_files_per_trigger: int | None = None) -> DataFrame:
    """Flat change rows of a file stream, with ``event_time`` (timestamp)."""
    lines = change_line_stream(spark, source, max_files_per_trigger)
    flat = flatten_envelope(parse_change_lines(split_glued(lines)), pk_columns)
    return flat.withColumn("event_time", F.timestamp_millis("ts_ms"))


def run_to_silver(flat_stream: DataFrame, root: str, checkpoint: str):
    """Drain the stream into the silver table, each event once; the query handle."""
    q = (flat_stream.writeStream.foreachBatch(lambda batch, _: append_silver(batch.drop("event_time"), root))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def windowed_stream_counts(flat_stream: DataFrame, every: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """T5: tumbling-window event counts, emitted once the watermark passes."""
    return (
        flat_stream.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", every).alias("w"), "op")
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "op", "n_events")
    )


def stream_alarms(flat_stream: DataFrame, threshold_ms: int, every: str = "5 minutes", span: str = "15 minutes", periods: int = 3, delay: str = "10 minutes") -> DataFrame:
    """T5 + A9: an alarm when the mean lag of ``periods`` consecutive windows is above the threshold.

    Two chained stateful aggregations in append mode: windows first, then a sliding
    span over closed windows; state holds open windows and spans only.
    """
    windows = flat_stream.withWatermark("event_time", delay).groupBy(F.window("event_time", every).alias("w")).agg(
        F.sum(F.col("ts_ms") - F.col("source_ts_ms")).alias("lag_ms_sum"), F.count("*").alias("n_events"))
    breach = (F.col("lag_ms_sum") > threshold_ms * F.col("n_events")).cast("int")
    spans = windows.select(F.window_time("w").alias("t"), breach.alias("breach")).groupBy(F.window("t", span, every).alias("s")).agg(
        F.sum("breach").alias("breaches"))
    return spans.filter(F.col("breaches") == periods).select(F.col("s.start").alias("span_start"), F.col("s.end").alias("span_end"))


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Drain a streaming DataFrame into Parquet with ``availableNow``."""
    q = (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
