"""K1, K5, K6: staged batches, the append-only change log, the silver table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowtide.functions.time import ms_to_ntz
from rowtide.sinks import fs

LOG_PARTITIONS = ("db_name", "table_name", "dt")
EVENT_KEY_COLUMNS = ("db_name", "table_name", "pk_hash", "op", "ts_ms", "binlog_file", "binlog_pos")


def stage_batch(df: DataFrame, root: str, batch_id: str) -> str:
    """K1: write a batch under its own id (overwrite: a retry replaces it)."""
    path = f"{root.rstrip('/')}/{batch_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def stage_counted(df: DataFrame, path: str, counts: Mapping[str, Column], *partition_by: str) -> dict:
    """K1, A1: write rows that several readers need, once, and count on the way.

    The aggregates are observed by the write's own tasks, each output partition
    once however often its task ran, so no job runs for them.

    No dictionaries: lines and row images hardly repeat as a whole, and the tables of
    them that a task builds cost more than the rest of the write.
    """
    seen = Observation()
    df.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.mode("overwrite").option("parquet.enable.dictionary", "false") \
        .partitionBy(*partition_by).parquet(path)
    return {n: seen.get[n] for n in counts}


def with_log_columns(flat: DataFrame) -> DataFrame:
    """Flat changes + ``dt`` partition + ``event_key`` (unambiguous, NULL-safe)."""
    key = F.sha2(F.to_json(F.array(*[F.col(c).cast("string") for c in EVENT_KEY_COLUMNS])), 256)
    return flat.withColumn("dt", F.to_date(ms_to_ntz("ts_ms"))).withColumn("event_key", key)


def append_log(flat: DataFrame, root: str) -> None:
    """K5: append changes; deletes are appended as tombstone rows."""
    fs.for_partitioned_write(with_log_columns(flat), *LOG_PARTITIONS).write.mode("append") \
        .partitionBy(*LOG_PARTITIONS).parquet(root)


def new_events(flat: DataFrame, root: str) -> DataFrame:
    """K6: events of the batch not yet in the silver table.

    Looks the event key up in the partitions that the batch touches, then
    deduplicates what is left of the batch: a replayed batch leaves nothing to do. Spark prunes partitions for a semi
    join but not for an anti join, so the existing table first meets the
    batch's (db, table, date) list, one row per partition and broadcast.

    The batch is shuffled and sorted once, on the event key, for both: tasks do not sort it
    before the shuffle, and the join is on the event key alone (which holds the date).
    """
    batch = with_log_columns(flat).repartition("event_key")
    spark = flat.sparkSession
    if not fs.exists(spark, root):
        return batch.dropDuplicates(["event_key"])
    touched = F.broadcast(with_log_columns(flat).select(*LOG_PARTITIONS).distinct())  # without the batch's shuffle
    existing = spark.read.parquet(root).join(touched, list(LOG_PARTITIONS), "left_semi").select("event_key", F.lit(True).alias("_old"))
    # an outer join and a filter: an anti join would be moved below a union, to shuffle each of its sides
    return batch.join(existing, "event_key", "left").filter(F.col("_old").isNull()).select(*batch.columns).dropDuplicates(["event_key"])


def append_silver(flat: DataFrame, root: str) -> None:
    """K6; no dictionaries of the two digests, of which tasks would build tables in vain."""
    fs.for_partitioned_write(new_events(flat, root), *LOG_PARTITIONS).write.mode("append") \
        .option("parquet.enable.dictionary#event_key", "false").option("parquet.enable.dictionary#pk_hash", "false") \
        .partitionBy(*LOG_PARTITIONS).parquet(root)
