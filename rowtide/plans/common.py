"""Shared building blocks of the catalog: the events change log and SQL CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.contracts import REGISTRY
from rowtide.operators.envelope import flatten_envelope
from rowtide.sources.changelog import parse_change_lines
from rowtide.sources.fixtures import event_envelope_lines, load_events

USERS = REGISTRY["app.users"]
ORDERS = REGISTRY["tpch.orders"]
CUSTOMER = REGISTRY["tpch.customer"]
PART = REGISTRY["tpch.part"]
LINEITEM = REGISTRY["tpch.lineitem"]

# Fixed values of the fixtures: the events log is replayed as two batches
# split at this instant; SCD2 snapshots of customer tiers are taken at these
# dates.
BATCH_SPLIT = "2024-01-16 00:00:00"
TIER_FIRST = "1998-01-01 00:00:00"
TIER_SECOND = "2001-09-01 00:00:00"
HISTORY_START = "1995-01-01 00:00:00"


def staged(batch: DataFrame) -> DataFrame:
    """K1 as a job does it: materialize a batch once before merging it.

    A reliable checkpoint under the session's ``spark.checkpoint.dir``
    (shared storage on a cluster); the merge then reads it instead of
    deriving the batch once for each side that uses it.
    """
    return batch.checkpoint(eager=True)


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events log as JSON envelope lines; encoding and parsing them is
    the heavy per-row work, so the scan is spread over the cores first."""
    return event_envelope_lines(load_events(spark, sf_dir))


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → JSON envelope text → parsed → flat change rows."""
    return flatten_envelope(parse_change_lines(event_lines(spark, sf_dir)), USERS.primary_keys)


# DuckDB side: the same flat change log written directly in SQL.
SQL_FLAT_EVENTS = """
ev AS (
  SELECT e.*,
    CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'u' WHEN 'purchase' THEN 'u'
                    WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' END AS op,
    epoch_us(ts) // 1000 AS ts_ms
  FROM events e
),
flat AS (
  SELECT 'app' AS db_name, 'users' AS table_name, op, ts_ms,
    ts_ms - CAST(floor(value * 1000) AS BIGINT) AS source_ts_ms,
    op = 'r' AS is_snapshot,
    'mysql-bin.' || lpad(CAST(day(ts) AS VARCHAR), 6, '0') AS binlog_file,
    CAST(day(ts) AS BIGINT) AS file_seq,
    event_id AS binlog_pos,
    sha256(CAST(user_id AS VARCHAR)) AS pk_hash,
    user_id, CAST(value AS DECIMAL(12,2)) AS dvalue, value, props, event_type, event_id, ts
  FROM ev
)
"""


def with_flat(sql: str) -> str:
    return "WITH " + SQL_FLAT_EVENTS.strip() + ",\n" + sql.strip()


def epoch_ms(ts: str) -> int:
    """Epoch milliseconds of a UTC ``YYYY-MM-DD HH:MM:SS`` literal."""
    import datetime as _dt

    d = _dt.datetime.strptime(ts, "%Y-%m-%d %H:%M:%S").replace(tzinfo=_dt.timezone.utc)
    return int(d.timestamp() * 1000)
