"""Batch ledger: processed / started / finished marks.

The ledger is an append-only table of attempts. The current status of a
batch is its latest row (W3). Only SUCCESS blocks a batch; a FAILED or
stale STARTED batch may be retried with the next attempt number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
ERROR_LIMIT = 1000  # fixed value: error text is cut to 1000 characters
TTL_DAYS = 30  # fixed value: ledger rows expire after 30 days


def _status_rank() -> Column:
    return F.when(F.col("status") == STARTED, 0).otherwise(1)


def ledger_current(ledger: DataFrame) -> DataFrame:
    """One row per (job, batch): highest attempt, finish after start."""
    w = Window.partitionBy("job_name", "batch_id").orderBy(
        F.col("attempt").desc(), _status_rank().desc(),
        F.coalesce(F.col("completed_at"), F.col("started_at")).desc(),
    )
    return ledger.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def processed(ledger: DataFrame) -> DataFrame:
    """L1: (job, batch) that finished successfully."""
    return ledger_current(ledger).filter(F.col("status") == SUCCESS).select("job_name", "batch_id")


def pending_batches(batches: DataFrame, ledger: DataFrame) -> DataFrame:
    """Batches not yet processed (anti join against SUCCESS)."""
    return batches.join(processed(ledger), ["job_name", "batch_id"], "left_anti")


def start_marks(batches: DataFrame, ledger: DataFrame, started_at: Column) -> DataFrame:
    """L2: STARTED rows for batches that may run, with the next attempt number.

    SUCCESS blocks; FAILED and STARTED (crashed) batches get attempt + 1.
    """
    cur = ledger_current(ledger).select("job_name", "batch_id", F.col("attempt").alias("_last"), F.col("status").alias("_st"))
    j = batches.join(cur, ["job_name", "batch_id"], "left").filter(
        F.col("_st").isNull() | (F.col("_st") != SUCCESS))
    return j.select(
        "job_name", "batch_id",
        (F.coalesce(F.col("_last"), F.lit(0)) + 1).cast("int").alias("attempt"),
        F.lit(STARTED).alias("status"),
        started_at.cast("timestamp_ntz").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        F.lit(None).cast("bigint").alias("row_count"),
        F.lit(None).cast("string").alias("error_message"),
    )


def finish_marks(started: DataFrame, completed_at: Column, row_count: Column | None = None,
                 error: Column | None = None) -> DataFrame:
    """L3: SUCCESS (no error) or FAILED (error, cut to 1000 chars) rows."""
    err = error if error is not None else F.lit(None).cast("string")
    return started.select(
        "job_name", "batch_id", "attempt",
        F.when(err.isNull(), SUCCESS).otherwise(FAILED).alias("status"),
        "started_at",
        completed_at.cast("timestamp_ntz").alias("completed_at"),
        (row_count if row_count is not None else F.lit(None)).cast("bigint").alias("row_count"),
        F.substring(err, 1, ERROR_LIMIT).alias("error_message"),
    )


def expire(ledger: DataFrame, as_of: Column, ttl_days: int = TTL_DAYS) -> DataFrame:
    """L4: rows younger than the TTL."""
    return ledger.filter(F.col("started_at") >= as_of - F.make_interval(days=F.lit(ttl_days)))


def success_rate(ledger: DataFrame, period: Column, by: Sequence[str] = ()) -> DataFrame:
    """Finished attempts and the share that succeeded, per period (and ``by``)."""
    done = ledger.filter(F.col("status").isin(SUCCESS, FAILED))
    return done.groupBy(*by, period.alias("period")).agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum(F.when(F.col("status") == SUCCESS, 1).otherwise(0)).cast("bigint").alias("succeeded"),
    ).withColumn("success_rate", F.col("succeeded") / F.col("runs"))
