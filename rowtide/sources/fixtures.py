"""Change envelopes derived from the driver's tables.

``events`` is read as a change log of an ``app.users`` table; the other
tables can be turned into snapshot (``r``) changes. Everything is a
projection of the input, so it scales with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.time import ntz_to_ms
from rowtide.schemas import ROW_IMAGE

# event_type → change op of the events fixture.
EVENT_OPS = {"signup": "c", "click": "u", "purchase": "u", "view": "r", "error": "d"}

USERS_DB, USERS_TABLE = "app", "users"
BINLOG_PREFIX = "mysql-bin."


# Rows of a task that encodes and parses change lines: an event becomes a line and its
# payload, about a kilobyte in memory.
SPREAD_ROWS = 200_000


def spread(df: DataFrame, *by: str, rows: int = SPREAD_ROWS) -> DataFrame:
    """Give a table scanned in too few splits one partition per core, or more if
    one of them would hold over ``rows`` rows.

    A Parquet file with one row group is one split, so everything up to the
    first shuffle (JSON encoding and parsing of the change log included)
    would run in a single task; and a narrow table's splits hold millions of
    rows, whose lines would be one task's to sort. The rows are counted from the
    file footers. Filters and column pruning still reach the scan below the
    exchange. Dealt by the columns ``by``; without them round-robin, which is deterministic
    on retry (Spark sorts before a round-robin repartition).
    """
    target = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(target, *by) if df.rdd.getNumPartitions() < target else df


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table for queries that make change lines of it. Behind a filter that keeps a part of
    the rows, the tasks are as many and smaller."""
    return spread(load(spark, sf_dir, "events"), "event_id", "ts")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_op(event_type: Column) -> Column:
    expr = None
    for k, v in EVENT_OPS.items():
        expr = (F.when(event_type == k, v) if expr is None else expr.when(event_type == k, v))
    return expr


def _image(pairs: list[tuple[str, Column]]) -> Column:
    args = []
    for k, v in pairs:
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)


def event_payload() -> Column:
    """One ``payload`` struct per event (the wrapped envelope's content).

    Key ``user_id``; event time ``ts``; commit time ``ts - floor(value s)``;
    binlog file = day of month, position = ``event_id``; ``u`` carries the
    key in ``before``, ``d`` the full image; ``props`` keys join the image.
    """
    op = event_op(F.col("event_type"))
    ts_ms = ntz_to_ms("ts")
    base = _image(
        [
            ("user_id", F.col("user_id")),
            ("value", F.col("value").cast("decimal(12,2)")),
            ("props", F.col("props")),
            ("event_type", F.col("event_type")),
        ]
    )
    image = F.map_concat(base, F.from_json(F.col("props"), ROW_IMAGE))
    key_only = _image([("user_id", F.col("user_id"))])
    source = F.struct(
        F.lit("mysql").alias("connector"),
        F.lit(USERS_DB).alias("db"),
        F.lit(USERS_TABLE).alias("table"),
        (ts_ms - F.floor(F.col("value") * 1000)).alias("ts_ms"),
        F.when(op == "r", "true").otherwise("false").alias("snapshot"),
        F.lit(None).cast("string").alias("version"),
        F.concat(F.lit(BINLOG_PREFIX), F.lpad(F.dayofmonth("ts").cast("string"), 6, "0")).alias("file"),
        F.col("event_id").alias("pos"),
        F.lit(1).cast("bigint").alias("server_id"),
    )
    payload = F.struct(
        F.when(op == "d", image).when(op == "u", key_only).alias("before"),
        F.when(op != "d", image).alias("after"),
        source.alias("source"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
    )
    return payload


def event_payloads(events: DataFrame) -> DataFrame:
    return events.select(event_payload().alias("payload"))


def event_envelope_lines(events: DataFrame) -> DataFrame:
    """JSON Lines text of the events change log (column ``value``)."""
    return event_payloads(events).select(F.to_json(F.struct("payload")).alias("value"))


def snapshot_payloads(rows: DataFrame, db: str, table: str, ts_ms: Column, op: str = "r") -> DataFrame:
    """Every row of a table as a snapshot change (``r``) of ``db.table``."""
    image = _image([(c, F.col(c)) for c in rows.columns])
    source = F.struct(
        F.lit("mysql").alias("connector"),
        F.lit(db).alias("db"),
        F.lit(table).alias("table"),
        ts_ms.alias("ts_ms"),
        F.lit("true").alias("snapshot"),
        F.lit(None).cast("string").alias("version"),
        F.lit(None).cast("string").alias("file"),
        F.lit(None).cast("bigint").alias("pos"),
        F.lit(1).cast("bigint").alias("server_id"),
    )
    payload = F.struct(
        (image if op == "d" else F.lit(None).cast(ROW_IMAGE)).alias("before"),
        (F.lit(None).cast(ROW_IMAGE) if op == "d" else image).alias("after"),
        source.alias("source"),
        F.lit(op).alias("op"),
        ts_ms.alias("ts_ms"),
    )
    return rows.select(payload.alias("payload"))


def dirty_event_lines(events: DataFrame, keep=()) -> DataFrame:
    """The events log as a landing batch with the faults real feeds show.

    Fault rules keyed on ``value`` (fixed values of the fixture):
    ``value < 1`` → line cut in half (malformed JSON); ``1 <= value < 2`` →
    bare envelope without the ``payload`` wrapper (valid); ``2 <= value < 3``
    → object with neither shape; ``3 <= value < 4`` → unknown op ``t``;
    ``4 <= value < 5`` → table without a contract (``app.sessions``); every
    other line is a normal wrapped envelope. Column ``value`` is the line.
    """
    pay = event_payload()
    v = F.col("value")
    # behind generators the payload and its text are made once per event, however often they are used
    made = F.col("_p")
    made = F.when((v >= 3) & (v < 4), made.withField("op", F.lit("t"))) \
        .when((v >= 4) & (v < 5), made.withField("source.table", F.lit("sessions"))).otherwise(made)
    both = F.array(F.struct(F.to_json(F.struct(made.alias("payload"))).alias("_w"), F.to_json(made).alias("_b")))
    cut = F.expr("substring(_w, 1, cast(length(_w) / 2 as int))")
    line = (
        F.when(v < 1, cut)
        .when(v < 2, F.col("_b"))
        .when(v < 3, F.to_json(F.struct(F.col("event_id").alias("heartbeat"))))
        .otherwise(F.col("_w"))
    )
    return events.select("*", F.explode(F.array(pay)).alias("_p")).select("*", F.inline(both)).select(line.alias("value"), *keep)


# Fixed values of the ledger fixture: job name, failure rule, timings.
LEDGER_JOB = "apply_changes"
FAIL_VALUE = 200.0


def hourly_batches(events: DataFrame) -> DataFrame:
    """One batch per event hour: (job_name, batch_id, hour, n_events, fails)."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    return events.groupBy(hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.bool_or((F.col("event_type") == "error") & (F.col("value") > FAIL_VALUE)).alias("fails"),
    ).select(
        F.lit(LEDGER_JOB).alias("job_name"),
        F.date_format("hour", "yyyy-MM-dd-HH").alias("batch_id"),
        "hour", "n_events", "fails",
    )


def ledger_rows(batches: DataFrame) -> DataFrame:
    """Ledger of the batches: attempt 1 starts at the hour's end and fails
    when the hour holds an error event above FAIL_VALUE; a failed batch is
    retried 5 minutes later and succeeds."""
    end = F.col("hour") + F.expr("INTERVAL 1 HOUR")
    plus = lambda m: end + F.make_interval(mins=F.lit(m))

    def row(attempt, status, started, completed, count, err):
        return F.struct(
            F.lit(attempt).cast("int").alias("attempt"), status.alias("status"),
            started.cast("timestamp_ntz").alias("started_at"),
            completed.cast("timestamp_ntz").alias("completed_at"),
            count.cast("bigint").alias("row_count"), err.cast("string").alias("error_message"),
        )

    fails = F.col("fails")
    none = F.lit(None)
    rows = F.array(
        row(1, F.lit("STARTED"), end, none, none, none),
        row(1, F.when(fails, "FAILED").otherwise("SUCCESS"), end, plus(1),
            F.when(~fails, F.col("n_events")), F.when(fails, F.lit("sink write failed: error event in batch"))),
        F.when(fails, row(2, F.lit("STARTED"), plus(5), none, none, none)),
        F.when(fails, row(2, F.lit("SUCCESS"), plus(5), plus(6), F.col("n_events"), none)),
    )
    return batches.select("job_name", "batch_id", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r")).select(
        "job_name", "batch_id", "r.*")
