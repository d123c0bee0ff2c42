"""Queries that write and read back: sources (S2–S7, R1), sinks (K1–K7), streams.

They write under the session's checkpoint directory (shared storage on a
cluster), each call into a fresh folder.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rowtide.functions.time import ntz_to_ms
from rowtide.operators.envelope import current_state
from rowtide.operators.metrics import run_totals
from rowtide.contracts import ColumnRule
from rowtide.plans.batch_job import JobConfig, process_batch, read_current, read_drift, read_scd2, stored_table
from rowtide.plans.common import BATCH_SPLIT, CUSTOMER, PART, USERS, event_lines, flat_events, with_flat
from rowtide.plans.q_envelope import SQL_CURRENT_USERS
from rowtide.plans.registry import query
from rowtide.session import scratch_path
from rowtide.sinks import ledger_store
from rowtide.sinks.log import append_log, append_silver, stage_batch
from rowtide.sinks.search import index_name, indexed, read_bulk, search_actions
from rowtide.sinks.versioned import VersionedTable
from rowtide.sources import landing
from rowtide.sources.changelog import parse_change_lines, read_change_events, read_change_lines
from rowtide.sources.fixtures import event_envelope_lines, event_payload, hourly_batches, ledger_rows, load, load_events, snapshot_payloads
from rowtide.operators.envelope import flatten_envelope
from rowtide.streaming import stream as S

# Fixed values of the replay/retention fixtures.
REPLAY_START, REPLAY_END = "2024-01-10", "2024-01-12"
RETENTION_AS_OF = "2024-04-20"


def _landed(spark, sf_dir):
    root = scratch_path(spark, "landing")
    landing.land_lines(event_lines(spark, sf_dir), root, root + "-errors")
    return root


@query("replay_scan", f"""
SELECT CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_events,
  count(DISTINCT user_id) AS n_keys
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{REPLAY_START}' AND DATE '{REPLAY_END}' GROUP BY 1, 2
""")
def q_replay_scan(spark, sf_dir):
    """Land the log partitioned, replay a date range with pruning."""
    root = _landed(spark, sf_dir)
    lines = landing.range_scan(spark, root, REPLAY_START, REPLAY_END, [("app", "users")])
    flat = flatten_envelope(parse_change_lines(lines.select("value", "dt", "hour")), USERS.primary_keys,
                            keep=["dt", "hour"])
    return flat.groupBy("dt", "hour").agg(F.count(F.lit(1)).alias("n_events"),
                                          F.count_distinct("pk_hash").alias("n_keys"))


@query("replay_plan", """
WITH r AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events)
SELECT 'app' AS db_name, 'users' AS table_name, CAST(d AS DATE) AS dt, CAST(h AS INTEGER) AS hour
FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM r), generate_series(0, 23) AS s(h)
""")
def q_replay_plan(spark, sf_dir):
    """Hours × tables of the landed range; tables and dates come from the landed files."""
    parts = landing.touched_partitions(landing.landed_files(spark, _landed(spark, sf_dir)))
    span = parts.agg(F.min("dt").cast("string"), F.max("dt").cast("string")).first()  # one row
    return landing.replay_plan(parts.select("db_name", "table_name").distinct(), *span)


@query("touched_partitions", """
SELECT DISTINCT 'app' AS db_name, 'users' AS table_name, CAST(ts AS DATE) AS dt, CAST(hour(ts) AS INTEGER) AS hour
FROM events
""")
def q_touched_partitions(spark, sf_dir):
    root = _landed(spark, sf_dir)
    return landing.touched_partitions(landing.landed_files(spark, root))


@query("retention_plan", f"""
SELECT DISTINCT 'app' AS db_name, 'users' AS table_name, CAST(ts AS DATE) AS dt FROM events
WHERE CAST(ts AS DATE) < DATE '{RETENTION_AS_OF}' - INTERVAL 90 DAY
""")
def q_retention_plan(spark, sf_dir):
    root = _landed(spark, sf_dir)
    parts = landing.touched_partitions(landing.landed_files(spark, root))
    return landing.retention_plan(parts, F.lit(RETENTION_AS_OF))


@query("retention_applied", f"""
SELECT 'app' AS db_name, 'users' AS table_name, CAST(ts AS DATE) AS dt, count(*) AS n_events FROM events
WHERE CAST(ts AS DATE) >= DATE '{RETENTION_AS_OF}' - INTERVAL 90 DAY GROUP BY 3
""")
def q_retention_applied(spark, sf_dir):
    """What is left in the landing folder after old dates were deleted."""
    root = _landed(spark, sf_dir)
    landing.apply_retention(spark, root, F.lit(RETENTION_AS_OF))
    return landing.read_landed(spark, root).groupBy("db_name", "table_name", "dt").agg(F.count("*").alias("n_events"))


def _parts(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    return p.select(*[F.col(c).cast(PART.type_of(c)).alias(c) for c in PART.columns])


@query("search_actions", """
WITH p AS (
  SELECT p.*, NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey) AS gone FROM part p
)
SELECT CAST(p_partkey AS VARCHAR) AS _id,
  '{"index":{"_index":"cdc-tpch-part","_id":"' || CAST(p_partkey AS VARCHAR) || '"}}' AS action,
  '{"p_name":' || to_json(p_name) || ',"p_brand":' || to_json(p_brand) || ',"p_type":' || to_json(p_type)
  || ',"p_size":' || CAST(p_size AS VARCHAR) || ',"p_retailprice":' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)
  || ',"p_partkey":' || CAST(p_partkey AS VARCHAR) || ',"deleted_at":'
  || CASE WHEN gone THEN '"2001-09-01T00:00:00.000"' ELSE 'null' END || '}' AS document
FROM p
""")
def q_search_actions(spark, sf_dir):
    """K4: index actions for parts; parts never ordered are soft-deleted."""
    parts = _parts(spark, sf_dir)
    ordered = load(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct()
    flagged = parts.join(ordered.withColumn("_sold", F.lit(True)), "p_partkey", "left")
    return search_actions(flagged, PART, deleted=F.col("_sold").isNull(),
                          deleted_at=F.lit("2001-09-01 00:00:00").cast("timestamp_ntz"))


@query("append_log", with_flat("""
SELECT t.log, db_name, table_name, CAST(ts AS DATE) AS dt, op, pk_hash, ts_ms, binlog_file, binlog_pos, CAST(n AS BIGINT) AS n_copies
FROM flat, (VALUES ('log', 2), ('silver', 1)) t(log, n)
"""))
def q_append_log(spark, sf_dir):
    """K5/K6: the log appended twice; the change log keeps both, the silver table one of each."""
    root = scratch_path(spark, "appended")
    flat = spark.read.parquet(stage_batch(flat_events(spark, sf_dir).drop("before", "after"), root + "-stage", "b1"))  # four appends read it
    parts = []
    for name, append in (("log", append_log), ("silver", append_silver)):
        append(flat, f"{root}-{name}")
        append(flat, f"{root}-{name}")
        parts.append(spark.read.parquet(f"{root}-{name}").withColumn("log", F.lit(name)))
    return parts[0].unionByName(parts[1]).groupBy(
        "log", "db_name", "table_name", "dt", "op", "pk_hash", "ts_ms", "binlog_file", "binlog_pos").agg(F.count("*").alias("n_copies"))


@query("versioned_table", with_flat(SQL_CURRENT_USERS))
def q_versioned_table(spark, sf_dir):
    """K1/K2: the log staged under its batch id, its current state written as a table, read back."""
    root = scratch_path(spark, "users")
    staged = spark.read.parquet(stage_batch(flat_events(spark, sf_dir), root + "-stage", "b1"))
    t = VersionedTable(spark, root, USERS.primary_keys)
    t.overwrite(current_state(staged, USERS))
    return t.read()


@query("batch_job", with_flat("""
latest AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1)
SELECT s.sink, user_id, dvalue AS value, props, event_type, ts_ms AS updated_ts_ms
FROM latest, (VALUES ('warehouse'), ('rowstore')) s(sink) WHERE op <> 'd'
"""))
def q_batch_job(spark, sf_dir):
    """The whole log as one batch to every sink, both sinks read back."""
    cfg = JobConfig(root=scratch_path(spark, "job"))
    process_batch(spark, event_lines(spark, sf_dir), "batch-1", cfg)
    return _both_sinks(spark, cfg)


def _both_sinks(spark, cfg):
    """The stored rows of the users in both state sinks."""
    parts = []
    for sink in ("warehouse", "rowstore"):
        state = VersionedTable(spark, cfg.table_root(sink, USERS), USERS.primary_keys).read().filter(F.col("_op") != "d")
        parts.append(state.select(F.lit(sink).alias("sink"), *USERS.columns, F.col("_ts_ms").alias("updated_ts_ms")))
    return parts[0].unionByName(parts[1])


SQL_BOTH_SINKS = """
latest AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1)
SELECT s.sink, user_id, dvalue AS value, props, event_type, ts_ms AS updated_ts_ms
FROM latest, (VALUES ('warehouse'), ('rowstore')) s(sink) WHERE op <> 'd'
"""


@query("run_totals", with_flat("""
latest AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1)
SELECT CAST(2 * count(*) FILTER (WHERE op <> 'd') AS BIGINT) AS upserted, CAST(2 * count(*) FILTER (WHERE op = 'd') AS BIGINT) AS deleted,
  CAST(1 AS BIGINT) AS tables, false AS any_error FROM latest
"""))
def q_run_totals(spark, sf_dir):
    """A3: totals over the write results of a job."""
    cfg = JobConfig(root=scratch_path(spark, "job"))
    results = process_batch(spark, event_lines(spark, sf_dir), "batch-1", cfg, raise_on_error=False)
    return run_totals(results).drop("first_errors")


@query("versioned_merge", with_flat(SQL_CURRENT_USERS))
def q_versioned_merge(spark, sf_dir):
    """K2: the log merged as three batches, the middle one twice, then read back."""
    cfg = JobConfig(root=scratch_path(spark, "merge"), enabled_sinks=("warehouse",))
    ev = load_events(spark, sf_dir)
    for k, part in enumerate((0, 2, 1, 2)):  # out of order: late batches must not win
        rows = ev.filter(F.pmod(F.dayofyear("ts"), F.lit(3)) == part)
        process_batch(spark, event_envelope_lines(rows), f"batch-{k}", cfg)
    state = VersionedTable(spark, cfg.table_root("warehouse", USERS), USERS.primary_keys).read()
    return state.filter(F.col("_op") != "d").select(*USERS.columns, F.col("_ts_ms").alias("updated_ts_ms"))


@query("schema_evolution", with_flat("""
latest AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1)
SELECT user_id, dvalue AS value, props, event_type,
  CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN json_extract_string(props, '$.k') END AS k
FROM latest WHERE op <> 'd'
"""))
def q_schema_evolution(spark, sf_dir):
    """Q2: the contract gains a column between two batches of a job that keeps no unknown columns; older rows have NULL."""
    cfg = JobConfig(root=scratch_path(spark, "evolution"), enabled_sinks=("warehouse",), keep_unknown=False)
    wider = replace(USERS, attribute_columns=(*USERS.attribute_columns, "k"))
    ev, split = load_events(spark, sf_dir), F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    process_batch(spark, event_envelope_lines(ev.filter(F.col("ts") < split)), "before", cfg)
    after = replace(cfg, registry={**cfg.registry, USERS.fqn: wider})
    process_batch(spark, event_envelope_lines(ev.filter(F.col("ts") >= split)), "after", after)
    state = VersionedTable(spark, cfg.table_root("warehouse", USERS), USERS.primary_keys).read()
    return state.filter(F.col("_op") != "d").select(*wider.columns)


@query("rowstore_keeps_columns", with_flat("""
latest AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1)
SELECT user_id, dvalue AS value, props, event_type,
  CASE WHEN EXISTS (SELECT 1 FROM flat f WHERE f.user_id = latest.user_id AND f.ts < TIMESTAMP '2024-01-16 00:00:00')
       THEN 'note ' || CAST(user_id AS VARCHAR) END AS note
FROM latest WHERE op <> 'd'
"""))
def q_rowstore_keeps_columns(spark, sf_dir):
    """A column that others write in the row store survives later batches."""
    cfg = JobConfig(root=scratch_path(spark, "rowstore"), enabled_sinks=("rowstore",))
    ev, split = load_events(spark, sf_dir), F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    process_batch(spark, event_envelope_lines(ev.filter(F.col("ts") < split)), "before", cfg)
    table = VersionedTable(spark, cfg.table_root("rowstore", USERS), USERS.primary_keys)
    keys = table.read().select("user_id")
    table.merge(keys, lambda target, _: target.withColumn("note", F.concat(F.lit("note "), F.col("user_id").cast("string"))))
    process_batch(spark, event_envelope_lines(ev.filter(F.col("ts") >= split)), "after", cfg)
    state = VersionedTable(spark, cfg.table_root("rowstore", USERS), USERS.primary_keys).read()
    return state.filter(F.col("_op") != "d").select(*USERS.columns, "note")


@query("job_quarantine", """
SELECT CASE WHEN event_id // 10 % 2 = 0 THEN 'first' ELSE 'second' END AS job_name, CASE WHEN event_id % 10 = 0 THEN 'key_conflict' ELSE 'schema_conflict' END AS reason,
  CASE WHEN event_id % 10 = 0 THEN 'user_id' ELSE 'value' END AS detail, event_id AS log_position,
  CASE WHEN event_id % 10 = 0 THEN 'abc' ELSE '9.9x' END AS told
FROM events WHERE event_id % 10 IN (0, 1) AND event_type <> 'error'
""")
def q_job_quarantine(spark, sf_dir):
    """Q3/Q4 in the job: lines whose values or keys do not cast, in the stored quarantine of
    two jobs that give their different lines the same batch id; the first job fails and is retried."""
    cfg = JobConfig(root=scratch_path(spark, "quarantine"))
    ev = load_events(spark, sf_dir)
    digit = F.pmod(F.col("event_id"), F.lit(10))
    live = F.col("event_type") != "error"
    pay = event_payload()
    bad_key = pay.withField("after", F.map_concat(F.map_filter(pay["after"], lambda k, _: k != "user_id"), F.create_map(F.lit("user_id"), F.lit("abc"))))
    bad_value = pay.withField("after", F.map_concat(F.map_filter(pay["after"], lambda k, _: k != "value"), F.create_map(F.lit("value"), F.lit("9.9x"))))
    line = F.when(live & (digit == 0), bad_key).when(live & (digit == 1), bad_value).otherwise(pay)
    half = F.pmod(F.floor(F.col("event_id") / 10), F.lit(2))
    first, second = (ev.filter(half == k).select(F.to_json(F.struct(line.alias("payload"))).alias("value")) for k in (0, 1))
    process_batch(spark, first, "batch-1", replace(_with_failing_sink(cfg), job_name="first"), raise_on_error=False)
    process_batch(spark, second, "batch-1", replace(cfg, job_name="second"))
    process_batch(spark, first, "batch-1", replace(cfg, job_name="first"))  # a retry quarantines nothing twice
    told = F.expr("get_json_object(raw, concat('$.payload.after.', detail))")
    place = F.get_json_object("raw", "$.payload.source.pos").cast("bigint").alias("log_position")
    return spark.read.parquet(cfg.quarantine_root).select("job_name", "reason", "detail", place, told.alias("told"))


@query("ledger_two_jobs", """
WITH n AS (SELECT count(DISTINCT user_id) AS n FROM events)
SELECT job, 'b1' AS batch_id, attempt, status, CASE WHEN status <> 'STARTED' THEN n END AS row_count, CAST(CASE WHEN status = 'FAILED' THEN 1000 END AS INTEGER) AS error_chars
FROM n, (VALUES ('first', 1, 'STARTED'), ('first', 1, 'SUCCESS'), ('second', 1, 'STARTED'), ('second', 1, 'FAILED'),
  ('second', 2, 'STARTED'), ('second', 2, 'SUCCESS')) v(job, attempt, status) WHERE n > 0
""")
def q_ledger_two_jobs(spark, sf_dir):
    """L2/L3: two jobs with a batch of the same id, one of which fails and is retried; attempts,
    row counts and the length of the cut error text in the stored ledger. A batch that succeeded is not run again."""
    cfg = JobConfig(root=scratch_path(spark, "two-jobs"), enabled_sinks=("warehouse",))
    lines = spark.read.text(_stream_source(spark, sf_dir))  # landed once: all attempts read the same lines
    process_batch(spark, lines, "b1", replace(_with_failing_sink(cfg, "warehouse"), job_name="second"), raise_on_error=False)
    for job in ("first", "second", "first"):
        process_batch(spark, lines, "b1", replace(cfg, job_name=job))
    ledger = ledger_store.read_ledger(spark, cfg.ledger_root)
    return ledger.select(F.col("job_name").alias("job"), "batch_id", "attempt", "status", "row_count",
                         F.length("error_message").alias("error_chars")).filter(F.col("row_count").isNull() | (F.col("row_count") > 0))


@query("empty_batch", """
WITH n AS (SELECT count(DISTINCT user_id) AS n FROM events)
SELECT batch_id, status, CASE WHEN batch_id = 'all' THEN 2 * n ELSE 0 END AS row_count, CAST(2 AS INTEGER) AS states
FROM n, (VALUES ('all', 'SUCCESS'), ('none', 'SUCCESS')) v(batch_id, status)
""")
def q_empty_batch(spark, sf_dir):
    """A1, A4: a batch without lines succeeds with no rows and writes no sink."""
    cfg, ev = JobConfig(root=scratch_path(spark, "empty")), load_events(spark, sf_dir)
    for batch_id, rows in (("all", ev), ("none", ev.filter("event_id < 0"))):
        process_batch(spark, event_envelope_lines(rows), batch_id, cfg, raise_on_error=True)
    states = stored_table(spark, cfg, "warehouse", USERS).version()  # the empty first one and that of the first batch
    ledger = ledger_store.read_ledger(spark, cfg.ledger_root).filter("status <> 'STARTED'")
    return ledger.select("batch_id", "status", "row_count", F.lit(states).cast("int").alias("states"))


def _failing(spark, contract, typed, batch_id):
    raise OSError(f"{contract.fqn}: this sink is down" + ", still" * 300)


def _with_failing_sink(cfg, *sinks):
    """The job with a user's sink that fails behind the named sinks of the users table."""
    users = replace(USERS, sinks=(*sinks, "down"))
    return replace(cfg, registry={**cfg.registry, USERS.fqn: users}, extra_sinks={"down": _failing})


@query("stream_retry", with_flat(SQL_BOTH_SINKS))
def q_stream_retry(spark, sf_dir):
    """The row store fails in the first run; the restarted stream replays the epoch into both sinks."""
    src, root, ckpt = _stream_source(spark, sf_dir), scratch_path(spark, "retry-job"), scratch_path(spark, "retry-ckpt")
    cfg = JobConfig(root=root)
    first = S.run_to_tables(spark, src, _with_failing_sink(cfg, "warehouse"), ckpt)
    try:
        first.awaitTermination()
        raise AssertionError("the failed sink did not fail the stream")
    except StreamingQueryException:
        pass
    S.run_to_tables(spark, src, cfg, ckpt).awaitTermination()
    return _both_sinks(spark, cfg)


@query("stream_two_checkpoints", with_flat(SQL_BOTH_SINKS))
def q_stream_two_checkpoints(spark, sf_dir):
    """Two streams into one root, each with epochs from 0, lose nothing."""
    cfg = JobConfig(root=scratch_path(spark, "two-job"))
    ev = load_events(spark, sf_dir)
    for part in (0, 1):
        src = scratch_path(spark, "two-src")
        event_envelope_lines(ev.filter(F.pmod(F.col("event_id"), F.lit(2)) == part)).write.text(src)
        S.run_to_tables(spark, src, cfg, scratch_path(spark, "two-ckpt")).awaitTermination()
    return _both_sinks(spark, cfg)


SQL_FULL_HISTORY = """
k AS (
  SELECT user_id, op, dvalue, event_type, ts_ms, file_seq, binlog_pos,
    lag(op) OVER w AS prev_op, lag(dvalue) OVER w AS prev_value, lag(event_type) OVER w AS prev_type FROM flat
  WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, file_seq, binlog_pos)
), v AS (
  SELECT *, lead(ts_ms) OVER (PARTITION BY user_id ORDER BY ts_ms, file_seq, binlog_pos) AS next_ms FROM k
  WHERE (op = 'd' AND prev_op <> 'd')
     OR (op <> 'd' AND (prev_op IS NULL OR prev_op = 'd' OR dvalue IS DISTINCT FROM prev_value OR event_type IS DISTINCT FROM prev_type))
)
SELECT user_id, dvalue AS value, event_type, make_timestamp(ts_ms * 1000) AS valid_from, make_timestamp(next_ms * 1000) AS valid_to,
  next_ms IS NULL AS is_current
FROM v WHERE op <> 'd'
"""


def _scd2_batches(spark, sf_dir, arrival, batches):
    """The history after the log, cut into equal spans of the table's own time range, came in this order."""
    contract = replace(USERS, attribute_columns=("value", "event_type"), scd2=True, sinks=("warehouse",))
    cfg = JobConfig(root=scratch_path(spark, "scd2-job"))
    cfg = replace(cfg, registry={**cfg.registry, USERS.fqn: contract})
    ev = load_events(spark, sf_dir).withColumn("t", ntz_to_ms("ts"))
    first, last = load(spark, sf_dir, "events").select(ntz_to_ms("ts").alias("t")).agg(F.min("t"), F.max("t")).first()
    if first is None:
        return spark.createDataFrame([], "user_id long, value decimal(12,2), event_type string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    batch = F.expr(f"(t - {first}) * {batches} div ({last} + 1 - {first})")
    for k, part in enumerate(arrival):
        process_batch(spark, event_envelope_lines(ev.filter(batch == part).drop("t")), f"batch-{k}", cfg, raise_on_error=True)
    return read_scd2(spark, cfg, "warehouse", contract)


# So many batches that the log is cut into, in the order in which they come.
SCD2_BATCHES, SCD2_IN_ORDER, SCD2_ARRIVAL = 4, (0, 1, 0, 2, 3), (0, 2, 1, 3, 2)


@query("scd2_job", with_flat(SQL_FULL_HISTORY))
def q_scd2_job(spark, sf_dir):
    """Every event in batches in order into the stored history, one of them
    sent again later: the same as the history of the whole log (W2)."""
    return _scd2_batches(spark, sf_dir, SCD2_IN_ORDER, SCD2_BATCHES)


@query("scd2_job_all", with_flat(SQL_FULL_HISTORY))
def q_scd2_job_all(spark, sf_dir):
    """Every event, a batch too late and one sent again: late events
    split the versions that cover them, so nothing differs from the history of the whole log."""
    return _scd2_batches(spark, sf_dir, SCD2_ARRIVAL, SCD2_BATCHES)


# Fixed value of the key-change fixture: distance of the keys that users had before.
OLD_KEYS = 1_000_000


@query("key_change", with_flat(f"""
told AS (
  SELECT *, CASE WHEN op <> 'u' AND event_id % 3 = 0 THEN user_id + {OLD_KEYS} ELSE user_id END AS k FROM flat
), parts AS (
  SELECT k, op, dvalue, event_type, ts_ms, file_seq, binlog_pos FROM told
  UNION ALL
  SELECT user_id + {OLD_KEYS}, 'd', NULL, NULL, ts_ms, file_seq, binlog_pos FROM told WHERE op = 'u' AND event_id % 5 = 0
), h AS (
  SELECT *, lag(op) OVER w AS prev_op, lag(dvalue) OVER w AS prev_value, lag(event_type) OVER w AS prev_type FROM parts
  WINDOW w AS (PARTITION BY k ORDER BY ts_ms, file_seq, binlog_pos)
), v AS (
  SELECT *, lead(ts_ms) OVER (PARTITION BY k ORDER BY ts_ms, file_seq, binlog_pos) AS next_ms FROM h
  WHERE (op = 'd' AND prev_op <> 'd')
     OR (op <> 'd' AND (prev_op IS NULL OR prev_op = 'd' OR dvalue IS DISTINCT FROM prev_value OR event_type IS DISTINCT FROM prev_type))
), now AS (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY k ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1
)
SELECT 'history' AS kept_in, k AS user_id, dvalue AS value, event_type, make_timestamp(ts_ms * 1000) AS valid_from,
  make_timestamp(next_ms * 1000) AS valid_to FROM v WHERE op <> 'd'
UNION ALL
SELECT 'rowstore', k, dvalue, event_type, NULL, NULL FROM now WHERE op <> 'd'
"""))
def q_key_change(spark, sf_dir):
    """Updates that move a user from an old key to its own; the table and the
    history end the old key and begin the new one. The later half of the log comes first."""
    contract = replace(USERS, attribute_columns=("value", "event_type"), scd2=True)
    cfg = JobConfig(root=scratch_path(spark, "key-change"))
    cfg = replace(cfg, registry={**cfg.registry, USERS.fqn: contract})
    pay, old = event_payload(), (F.col("user_id") + OLD_KEYS).cast("string")

    def keyed(image):
        return F.map_concat(F.map_filter(image, lambda k, _: k != "user_id"), F.create_map(F.lit("user_id"), old))

    moved = (F.col("_p.op") == "u") & (F.pmod(F.col("event_id"), F.lit(5)) == 0)
    before_move = (F.col("_p.op") != "u") & (F.pmod(F.col("event_id"), F.lit(3)) == 0)
    p = F.col("_p")
    line = F.when(moved, p.withField("before", keyed(p["before"]))) \
        .when(before_move, p.withField("before", keyed(p["before"])).withField("after", keyed(p["after"]))).otherwise(p)
    ev = load_events(spark, sf_dir).select("*", F.explode(F.array(pay)).alias("_p"))
    half = F.lit(BATCH_SPLIT).cast("timestamp_ntz")
    for k, part in enumerate((F.col("ts") >= half, F.col("ts") < half)):
        process_batch(spark, ev.filter(part).select(F.to_json(F.struct(line.alias("payload"))).alias("value")), f"batch-{k}", cfg, raise_on_error=True)
    history = read_scd2(spark, cfg, "warehouse", contract).drop("is_current").select(F.lit("history").alias("kept_in"), "*")
    none = F.lit(None).cast("timestamp_ntz")
    rows = read_current(spark, cfg, "rowstore", contract).select(
        F.lit("rowstore").alias("kept_in"), *contract.columns, none.alias("valid_from"), none.alias("valid_to"))
    return history.unionByName(rows)


# Fixed values of the rule fixture.
DQ_TYPES, DQ_HIGH, DQ_NATIONS = ("click", "purchase", "view", "error"), 300, 20


@query("job_dq", with_flat(f"""
judged AS (
  SELECT *, op <> 'd' AND dvalue > {DQ_HIGH} AS r, op <> 'd' AND event_type NOT IN {DQ_TYPES} AS e,
    op <> 'd' AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < {DQ_NATIONS}) AS f
  FROM flat
), now AS (
  SELECT * FROM judged WHERE NOT (r OR e OR f) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1
)
SELECT 'quarantine' AS found_in, concat_ws(',', CASE WHEN r THEN 'range:value' END, CASE WHEN e THEN 'enum:event_type' END, CASE WHEN f THEN 'fk:user_id' END) AS detail,
  event_id AS log_position, NULL AS user_id, NULL AS value FROM judged WHERE r OR e OR f
UNION ALL
SELECT 'target', NULL, event_id, user_id, dvalue FROM now WHERE op <> 'd'
"""))
def q_job_dq(spark, sf_dir):
    """Q1 in the job: the contract's rules (range, set, foreign key to a table that comes in the
    same batch) send lines to the quarantine; the target holds no row that breaks one."""
    rules = (ColumnRule("range", "value", high=DQ_HIGH), ColumnRule("enum", "event_type", DQ_TYPES),
             ColumnRule("fk", "user_id", parent=CUSTOMER.fqn, parent_column="c_custkey"))
    users, customers = replace(USERS, rules=rules, sinks=("rowstore",)), replace(CUSTOMER, scd2=False)
    cfg = JobConfig(root=scratch_path(spark, "rules"))
    cfg = replace(cfg, registry={users.fqn: users, customers.fqn: customers})
    some = load(spark, sf_dir, "customer").filter(F.col("c_nationkey") < DQ_NATIONS).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    parents = snapshot_payloads(some, "tpch", "customer", F.lit(0).cast("bigint")).select(F.to_json(F.struct("payload")).alias("value"))
    process_batch(spark, event_lines(spark, sf_dir).unionByName(parents), "batch-1", cfg, raise_on_error=True)
    place = F.get_json_object("raw", "$.payload.source.pos").cast("bigint").alias("log_position")
    bad = spark.read.parquet(cfg.quarantine_root).filter("reason = 'rule_violation'").select(
        F.lit("quarantine").alias("found_in"), "detail", place, F.lit(None).cast("bigint").alias("user_id"), F.lit(None).cast("decimal(12,2)").alias("value"))
    state = stored_table(spark, cfg, "rowstore", users).read().filter(F.col("_op") != "d")
    return bad.unionByName(state.select(F.lit("target").alias("found_in"), F.lit(None).cast("string").alias("detail"),
                                        F.col("_pos").alias("log_position"), "user_id", "value"))


@query("late_promotion", with_flat("""
latest AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1)
SELECT s.sink, user_id, dvalue AS value, props, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM latest, (VALUES ('warehouse'), ('rowstore')) s(sink) WHERE op <> 'd'
"""))
def q_late_promotion(spark, sf_dir):
    """Q2: the contract gains a column between two batches; rows written before have its value too,
    from what the job kept of columns it did not know."""
    cfg = JobConfig(root=scratch_path(spark, "promotion"))
    wider = replace(USERS, attribute_columns=(*USERS.attribute_columns, "k"), column_types={**USERS.column_types, "k": "int"})
    ev, split = load_events(spark, sf_dir), F.lit(BATCH_SPLIT).cast("timestamp_ntz")
    process_batch(spark, event_envelope_lines(ev.filter(F.col("ts") < split)), "before", cfg, raise_on_error=True)
    after = replace(cfg, registry={**cfg.registry, USERS.fqn: wider})
    process_batch(spark, event_envelope_lines(ev.filter(F.col("ts") >= split)), "after", after, raise_on_error=True)
    parts = [read_current(spark, after, sink, wider).select(F.lit(sink).alias("sink"), *wider.columns) for sink in ("warehouse", "rowstore")]
    return parts[0].unionByName(parts[1])


@query("drift_report", """
SELECT 'app.users' AS table, k AS column_name, count(*) AS n_events
FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY k
""")
def q_drift_report(spark, sf_dir):
    """Q2: what the job reports of columns that the contract does not name, over two batches."""
    cfg = JobConfig(root=scratch_path(spark, "drift"), enabled_sinks=("warehouse",))
    ev = load_events(spark, sf_dir)
    for part in (0, 1):
        process_batch(spark, event_envelope_lines(ev.filter(F.pmod(F.col("event_id"), F.lit(2)) == part)), f"batch-{part}", cfg, raise_on_error=True)
    return read_drift(spark, cfg).groupBy("table", "column_name").agg(F.sum("n_events").alias("n_events"))


@query("search_replay", with_flat("""
SELECT CAST(user_id AS VARCHAR) AS _id, user_id, dvalue AS value, event_type
FROM flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1 AND op <> 'd'
"""))
def q_search_replay(spark, sf_dir):
    """Bulk files of three batches that came in no order, one twice; the index keeps
    for each document the action of the highest version."""
    contract = replace(USERS, attribute_columns=("value", "event_type"), sinks=("search",))
    cfg = JobConfig(root=scratch_path(spark, "search"))
    cfg = replace(cfg, registry={USERS.fqn: contract})
    ev = load_events(spark, sf_dir)
    for k, part in enumerate((1, 0, 2, 1)):
        rows = ev.filter(F.pmod(F.dayofyear("ts"), F.lit(3)) == part)
        process_batch(spark, event_envelope_lines(rows), f"batch-{k}", cfg, raise_on_error=True)
    found = indexed(read_bulk(spark, f"{cfg.table_root('search', contract)}/{index_name(contract)}"))
    doc = F.from_json("document", "user_id bigint, value decimal(12,2), event_type string").alias("d")
    return found.select("_id", doc).select("_id", "d.*")


@query("tombstone_expiry", with_flat("""
latest AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1)
SELECT user_id, op, ts_ms FROM latest WHERE op <> 'd' OR ts_ms >= (SELECT max(ts_ms) FROM flat) - 10 * 86400000
"""))
def q_tombstone_expiry(spark, sf_dir):
    """Tombstones older than the replay horizon (10 days) leave the table when a batch is merged."""
    cfg = JobConfig(root=scratch_path(spark, "tombstones"), enabled_sinks=("warehouse",), tombstone_days=10)
    ev, split = load_events(spark, sf_dir), F.lit(BATCH_SPLIT).cast("timestamp_ntz")
    for k, part in enumerate((F.col("ts") < split, F.col("ts") >= split)):
        process_batch(spark, event_envelope_lines(ev.filter(part)), f"batch-{k}", cfg, raise_on_error=True)
    return stored_table(spark, cfg, "warehouse", USERS).read().select("user_id", F.col("_op").alias("op"), F.col("_ts_ms").alias("ts_ms"))


@query("change_scan", with_flat("""
SELECT CAST(ts AS DATE) AS day, op, count(*) AS n_events, count(DISTINCT user_id) AS n_keys, CAST(1 AS BIGINT) AS n_days_in_file FROM flat GROUP BY 1, 2
"""))
def q_change_scan(spark, sf_dir):
    """Gzip files in year/month/day folders, which are no ``k=v`` folders, read as typed envelopes with their file."""
    src, ev = scratch_path(spark, "scan-src"), load(spark, sf_dir, "events")
    lines = ev.select(F.to_json(F.struct(event_payload().alias("payload"))).alias("value"), F.to_date("ts").alias("day"))
    lines.write.partitionBy("day").option("compression", "gzip").text(f"{src}/2024/by-day")
    found = read_change_events(spark, f"{src}/2024")
    named = F.regexp_extract("source_file", r"day=([0-9-]+)", 1).cast("date").alias("day")
    flat = flatten_envelope(found, USERS.primary_keys, keep=["source_file"]).withColumn("event_day", F.to_date(F.timestamp_millis("ts_ms")))
    return flat.groupBy(named, "op").agg(F.count("*").alias("n_events"), F.count_distinct("pk_hash").alias("n_keys"),
                                         F.count_distinct("event_day").alias("n_days_in_file"))


@query("land_glued", """
SELECT 'app' AS db_name, 'users' AS table_name, CAST(ts AS DATE) AS dt, count(*) AS n_events FROM events GROUP BY 3
UNION ALL
SELECT 'app', 'sessions', CAST(ts AS DATE), count(*) FROM events WHERE event_id % 3 = 0 GROUP BY 3
""")
def q_land_glued(spark, sf_dir):
    """Gzip files whose lines hold two records of different tables, read from disk and landed."""
    src, root = scratch_path(spark, "glued-src"), scratch_path(spark, "glued")
    pay = event_payload()
    one = F.to_json(F.struct(pay.alias("payload")))
    other = F.concat(F.lit(" { "), F.substring(F.to_json(F.struct(pay.withField("source.table", F.lit("sessions")).alias("payload"))), 2, 2**30))
    ev = load_events(spark, sf_dir)
    ev.select(F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.concat(one, other)).otherwise(one).alias("value")) \
        .write.option("compression", "gzip").text(src)
    landing.land_lines(read_change_lines(spark, src), root, root + "-errors")
    return landing.read_landed(spark, root).groupBy("db_name", "table_name", "dt").agg(F.count("*").alias("n_events"))


@query("stream_current_state", with_flat(SQL_CURRENT_USERS))
def q_stream_current_state(spark, sf_dir):
    """Daily files streamed in several micro-batches to the tables."""
    src = scratch_path(spark, "stream-src")
    ev = load(spark, sf_dir, "events")
    ev.select(F.to_date("ts").alias("day"), F.to_json(F.struct(event_payload().alias("payload"))).alias("value")) \
        .write.partitionBy("day").text(src)
    cfg = JobConfig(root=scratch_path(spark, "stream-job"))
    q = S.run_to_tables(spark, src, cfg, scratch_path(spark, "stream-ckpt"), max_files_per_trigger=12)
    q.awaitTermination()
    state = VersionedTable(spark, cfg.table_root("warehouse", USERS), USERS.primary_keys).read()
    return state.filter(F.col("_op") != "d").select(*USERS.columns, F.col("_ts_ms").alias("updated_ts_ms"))


def _stream_source(spark, sf_dir, copies: int = 1):
    src = scratch_path(spark, "events-src")
    ev = load_events(spark, sf_dir)
    lines = event_envelope_lines(ev)
    for _ in range(copies):
        lines.write.mode("append").text(src)
    return src


@query("stream_dedup", with_flat("""
SELECT db_name, table_name, pk_hash, op, ts_ms, binlog_file, binlog_pos FROM flat
"""))
def q_stream_dedup(spark, sf_dir):
    """Every file landed twice, the days in no order, several micro-batches;
    each event is kept once, however old it is."""
    src = scratch_path(spark, "events-src")
    ev = load_events(spark, sf_dir)
    days = F.pmod(F.xxhash64(F.to_date("ts")), F.lit(8))  # a file holds scattered days
    lines = ev.select(days.alias("deal"), F.to_json(F.struct(event_payload().alias("payload"))).alias("value"))
    for _ in range(2):
        lines.repartition("deal").write.mode("append").partitionBy("deal").text(src)
    out = scratch_path(spark, "dedup-out")
    stream = S.event_stream(spark, src, USERS.primary_keys, max_files_per_trigger=5)
    S.run_to_silver(stream.drop("before", "after"), out, scratch_path(spark, "dedup-ckpt"))
    return spark.read.parquet(out).select("db_name", "table_name", "pk_hash", "op", "ts_ms", "binlog_file",
                                          "binlog_pos")


@query("stream_windows", with_flat("""
w AS (
  SELECT time_bucket(INTERVAL '5 minutes', make_timestamp(ts_ms * 1000)) AS window_start, op, count(*) AS n_events
  FROM flat GROUP BY 1, 2
)
SELECT * FROM w
WHERE window_start + INTERVAL 5 MINUTE <= (SELECT make_timestamp(max(ts_ms) * 1000) - INTERVAL 10 MINUTE FROM flat)
"""))
def q_stream_windows(spark, sf_dir):
    """T5: 5-minute windows with a 10-minute watermark; open windows not emitted."""
    src = _stream_source(spark, sf_dir)
    out = scratch_path(spark, "windows-out")
    S.run_to_parquet(S.windowed_stream_counts(S.event_stream(spark, src, USERS.primary_keys)), out,
                     scratch_path(spark, "windows-ckpt"))
    r = spark.read.parquet(out)
    return r.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "op", "n_events")


# Fixed values of the alarm fixture: five-minute windows whose mean lag is above a minute.
STREAM_BREACH_MS = 60_000


@query("stream_alarm", with_flat(f"""
w AS (
  SELECT time_bucket(INTERVAL '5 minutes', make_timestamp(ts_ms * 1000)) AS t, sum(ts_ms - source_ts_ms) > {STREAM_BREACH_MS} * count(*) AS breach
  FROM flat GROUP BY 1
)
SELECT a.t AS span_start, a.t + INTERVAL 15 MINUTE AS span_end
FROM w a JOIN w b ON b.t = a.t + INTERVAL 5 MINUTE JOIN w c ON c.t = a.t + INTERVAL 10 MINUTE
WHERE a.breach AND b.breach AND c.breach
  AND a.t + INTERVAL 15 MINUTE <= (SELECT make_timestamp(max(ts_ms) * 1000) - INTERVAL 10 MINUTE FROM flat)
"""))
def q_stream_alarm(spark, sf_dir):
    """Three five-minute windows in a row above the threshold, from two chained stateful aggregations."""
    out = scratch_path(spark, "alarm-out")
    alarms = S.stream_alarms(S.event_stream(spark, _stream_source(spark, sf_dir), USERS.primary_keys), STREAM_BREACH_MS)
    S.run_to_parquet(alarms, out, scratch_path(spark, "alarm-ckpt"))
    return spark.read.schema("span_start timestamp, span_end timestamp").parquet(out).select(
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("span_start", "span_end")])


@query("ledger_expired", f"""
WITH b AS (
  SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d-%H') AS batch_id, date_trunc('hour', ts) + INTERVAL 1 HOUR AS e, count(*) AS n,
    bool_or(event_type = 'error' AND value > 200.0) AS fails FROM events GROUP BY date_trunc('hour', ts)
), marks AS (
  SELECT batch_id, 1 AS attempt, 'STARTED' AS status, e AS started_at FROM b
  UNION ALL SELECT batch_id, 1, CASE WHEN fails THEN 'FAILED' ELSE 'SUCCESS' END, e FROM b
  UNION ALL SELECT batch_id, 2, s, e + INTERVAL 5 MINUTE FROM b, (VALUES ('STARTED'), ('SUCCESS')) v(s) WHERE fails
)
SELECT batch_id, attempt, status, started_at, CAST(0 AS INTEGER) AS days_changed_again FROM marks
WHERE started_at >= TIMESTAMP '{{LEDGER_EXPIRY}}' - INTERVAL 30 DAY
""".replace("{LEDGER_EXPIRY}", "2024-02-14 12:00:00"))
def q_ledger_expired(spark, sf_dir):
    """L4: the stored ledger after its expiry, which falls within a day; a second expiry changes nothing."""
    root, as_of = scratch_path(spark, "ledger"), datetime(2024, 2, 14, 12)
    ledger_store.append_marks(ledger_rows(hourly_batches(load(spark, sf_dir, "events"))), root)
    ledger_store.expire_stored(spark, root, as_of)
    again = ledger_store.expire_stored(spark, root, as_of)
    return ledger_store.read_ledger(spark, root).select("batch_id", "attempt", "status", "started_at", F.lit(again).cast("int").alias("days_changed_again"))
