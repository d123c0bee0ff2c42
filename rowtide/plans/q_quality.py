"""Queries: Q1–Q5 quality, P12/P13 fan-out, A2–A9 metrics, L1–L4/W3/J12 ledger."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from rowtide.contracts import REGISTRY, contract_table
from rowtide.operators import ledger as L
from rowtide.operators import metrics as M
from rowtide.operators import quality as Q
from rowtide.operators.envelope import current_state, flatten_envelope, latest_change_per_key
from rowtide.plans.common import BATCH_SPLIT, LINEITEM, ORDERS, USERS, flat_events, with_flat
from rowtide.plans.registry import query
from rowtide.functions.time import hour_bucket, ms_to_ntz, ntz_to_ms, trunc_ntz
from rowtide.sources.changelog import parse_change_lines
from rowtide.sources.fixtures import dirty_event_lines, hourly_batches, ledger_rows, load, snapshot_payloads, spread

# --- Q1 ----------------------------------------------------------------------------
# TPC-H domain rules of lineitem.
LI_RETURNFLAGS = ("A", "N", "R")
LI_LINESTATUS = ("O", "F")


@query("dq_violations", f"""
SELECT 'not_null:l_orderkey' AS rule, count(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM lineitem
UNION ALL SELECT 'not_null:l_linenumber', count(*) FILTER (WHERE l_linenumber IS NULL) FROM lineitem
UNION ALL SELECT 'range:l_quantity', count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50) FROM lineitem
UNION ALL SELECT 'range:l_discount', count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.1) FROM lineitem
UNION ALL SELECT 'range:l_tax', count(*) FILTER (WHERE l_tax < 0 OR l_tax > 0.08) FROM lineitem
UNION ALL SELECT 'enum:l_returnflag', count(*) FILTER (WHERE l_returnflag NOT IN {LI_RETURNFLAGS}) FROM lineitem
UNION ALL SELECT 'enum:l_linestatus', count(*) FILTER (WHERE l_linestatus NOT IN {LI_LINESTATUS}) FROM lineitem
UNION ALL SELECT 'fk:l_orderkey', count(*) FILTER (WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)) FROM lineitem
UNION ALL SELECT 'fk:l_partkey', count(*) FILTER (WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)) FROM lineitem
UNION ALL SELECT 'fk:l_suppkey', count(*) FILTER (WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) FROM lineitem
""")
def q_dq_violations(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    li = Q.with_fk_flag(li, load(spark, sf_dir, "orders"), "l_orderkey", "o_orderkey", "_has_order")
    li = Q.with_fk_flag(li, load(spark, sf_dir, "part"), "l_partkey", "p_partkey", "_has_part")
    li = Q.with_fk_flag(li, load(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", "_has_supp")
    rules = [
        Q.not_null("l_orderkey"), Q.not_null("l_linenumber"),
        Q.in_range("l_quantity", 1, 50), Q.in_range("l_discount", 0, 0.1), Q.in_range("l_tax", 0, 0.08),
        Q.in_set("l_returnflag", LI_RETURNFLAGS), Q.in_set("l_linestatus", LI_LINESTATUS),
        Q.fk_exists("l_orderkey", "_has_order"), Q.fk_exists("l_partkey", "_has_part"),
        Q.fk_exists("l_suppkey", "_has_supp"),
    ]
    return Q.dq_counts(li, rules)


# --- Q2, Q3, Q5 --------------------------------------------------------------------------
@query("new_columns", """
SELECT 'app' AS db_name, 'users' AS table_name, k AS column_name, count(*) AS n_events
FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY k
""")
def q_new_columns(spark, sf_dir):
    return Q.new_columns(flat_events(spark, sf_dir), USERS)


# A contract that fell behind its source: l_extendedprice was widened at the
# source from DECIMAL(7,2) to DECIMAL(12,2); the stale contract still says (7,2).
STALE_LINEITEM = dataclasses.replace(
    LINEITEM, column_types={**LINEITEM.column_types, "l_extendedprice": "decimal(7,2)"})


@query("schema_conflicts", """
SELECT l_orderkey, l_linenumber, 'l_extendedprice' AS conflicts
FROM lineitem WHERE CAST(l_extendedprice AS DECIMAL(12,2)) >= 100000
""")
def q_schema_conflicts(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    as_strings = li.select(*[F.col(c).cast("string").alias(c) for c in li.columns])
    flagged = Q.schema_conflicts(as_strings, STALE_LINEITEM)
    return flagged.filter(F.size("_schema_conflict") > 0).select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        F.array_join("_schema_conflict", ",").alias("conflicts"))


RENAMED_USERS = dataclasses.replace(USERS, attribute_columns=("amount", "props", "event_type"),
                                    column_types={**USERS.column_types, "amount": "decimal(12,2)"})


@query("rename_map", with_flat("""
SELECT user_id, dvalue AS amount, props, event_type
FROM flat
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1
  AND op <> 'd'
"""))
def q_rename_map(spark, sf_dir):
    """The contract renamed ``value`` to ``amount``; old images still say ``value``."""
    from rowtide.operators.envelope import typed_changes
    latest = latest_change_per_key(flat_events(spark, sf_dir), USERS.primary_keys)
    typed = typed_changes(latest.filter(F.col("op") != "d"), RENAMED_USERS, renames={"amount": "value"})
    return typed.select("user_id", "amount", "props", "event_type")


# --- Q4, A8 -------------------------------------------------------------------------------
def _classified(spark, sf_dir):
    ev = spread(load(spark, sf_dir, "events"))  # JSON encode/parse per row: use every core
    lines = dirty_event_lines(ev, keep=[trunc_ntz("hour", "ts").alias("landed_hour")])
    return Q.classify(parse_change_lines(lines), contract_table(spark))


_SQL_REASON = """
CASE WHEN value < 1 THEN 'malformed_json' WHEN value < 2 THEN NULL WHEN value < 3 THEN 'missing_payload'
     WHEN value < 4 THEN 'unknown_op' WHEN value < 5 THEN 'unknown_table' END"""


@query("quarantine_split", f"""
SELECT coalesce({_SQL_REASON}, 'ok') AS reason, count(*) AS n_lines FROM events GROUP BY 1
""")
def q_quarantine_split(spark, sf_dir):
    c = _classified(spark, sf_dir)
    return c.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n_lines"))


@query("quarantine_rate", f"""
SELECT date_trunc('hour', ts) AS period, count(*) AS n_lines,
  CAST(count(*) FILTER (WHERE {_SQL_REASON} IS NOT NULL) AS BIGINT) AS n_quarantined,
  count(*) FILTER (WHERE {_SQL_REASON} IS NOT NULL) / count(*) AS quarantine_rate
FROM events GROUP BY 1
""")
def q_quarantine_rate(spark, sf_dir):
    return M.quarantine_rate(_classified(spark, sf_dir), F.col("landed_hour"))


# --- P12/P13, A2 ---------------------------------------------------------------------------
def _orders_changes(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    snap = snapshot_payloads(o, "tpch", "orders", ntz_to_ms("o_orderdate"))
    lines = snap.select(F.to_json(F.struct("payload")).alias("value"))
    return flatten_envelope(parse_change_lines(lines), ORDERS.primary_keys)


def _two_tables(spark, sf_dir):
    return flat_events(spark, sf_dir).unionByName(_orders_changes(spark, sf_dir))


SQL_TWO_TABLES = """
two AS (
  SELECT db_name, table_name, pk_hash, op, ts_ms, user_id AS k, file_seq, binlog_pos FROM flat
  UNION ALL
  SELECT 'tpch', 'orders', sha256(CAST(o_orderkey AS VARCHAR)), 'r', epoch_us(o_orderdate) // 1000, o_orderkey,
         NULL, NULL FROM orders
),
sinks AS (SELECT * FROM (VALUES ('app', 'users', 'warehouse'), ('app', 'users', 'rowstore'),
                                ('tpch', 'orders', 'warehouse'), ('tpch', 'orders', 'rowstore')) s(db_name, table_name, sink))
"""


@query("fan_out", with_flat(SQL_TWO_TABLES + """
SELECT t.db_name, t.table_name, s.sink, t.pk_hash, t.op, t.ts_ms FROM two t JOIN sinks s USING (db_name, table_name)
"""))
def q_fan_out(spark, sf_dir):
    out = M.fan_out(_two_tables(spark, sf_dir), contract_table(spark))
    return out.select("db_name", "table_name", "sink", "pk_hash", "op", "ts_ms")


@query("rows_by_sink", with_flat(SQL_TWO_TABLES + """,
latest AS (
  SELECT * FROM two QUALIFY row_number() OVER (PARTITION BY db_name, table_name, k
                                               ORDER BY ts_ms DESC, file_seq DESC NULLS LAST, binlog_pos DESC NULLS LAST) = 1
),
per AS (
  SELECT db_name, table_name, CAST(count(*) FILTER (WHERE op <> 'd') AS BIGINT) AS up,
         CAST(count(*) FILTER (WHERE op = 'd') AS BIGINT) AS del
  FROM latest GROUP BY 1, 2
)
SELECT p.db_name, p.table_name, s.sink, 'rows_upserted' AS metric, p.up AS value FROM per p JOIN sinks s USING (db_name, table_name)
UNION ALL
SELECT p.db_name, p.table_name, s.sink, 'rows_deleted', p.del FROM per p JOIN sinks s USING (db_name, table_name)
"""))
def q_rows_by_sink(spark, sf_dir):
    two = _two_tables(spark, sf_dir)
    # per-table key columns differ: group on the key image of each table's key
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    keyed = two.withColumn("_k", F.coalesce(image["user_id"], image["o_orderkey"]))
    latest = latest_change_per_key(keyed.withColumn("pk_hash", F.col("_k")))
    return M.rows_by_sink(latest, contract_table(spark))


# --- A5, A6, A9 ----------------------------------------------------------------------------
@query("five_minute_sums", with_flat("""
SELECT time_bucket(INTERVAL '5 minutes', make_timestamp(ts_ms * 1000)) AS window_start, op,
  count(*) AS n_events, CAST(sum(ts_ms - source_ts_ms) AS BIGINT) AS lag_ms_sum
FROM flat GROUP BY 1, 2
"""))
def q_five_minute_sums(spark, sf_dir):
    return M.windowed_counts(flat_events(spark, sf_dir), "5 minutes", ["op"])


@query("five_minute_sums_by_sink", with_flat("""
SELECT time_bucket(INTERVAL '5 minutes', make_timestamp(ts_ms * 1000)) AS window_start, s.sink, op,
  count(*) AS n_events, CAST(sum(ts_ms - source_ts_ms) AS BIGINT) AS lag_ms_sum
FROM flat, (VALUES ('warehouse'), ('rowstore')) s(sink) GROUP BY 1, 2, 3
"""))
def q_five_minute_sums_by_sink(spark, sf_dir):
    """A5 over the fan-out: the series that each sink's alarm watches."""
    out = M.fan_out(flat_events(spark, sf_dir), contract_table(spark))
    return M.windowed_counts(out, "5 minutes", ["sink", "op"])


SQL_HOURLY_LAG = """
hourly AS (
  SELECT db_name, table_name, date_trunc('hour', make_timestamp(ts_ms * 1000)) AS period,
    quantile_cont(ts_ms - source_ts_ms, 0.5) AS p50_lag_ms, quantile_cont(ts_ms - source_ts_ms, 0.95) AS p95_lag_ms,
    max(ts_ms - source_ts_ms) AS max_lag_ms, count(*) AS n_events
  FROM flat GROUP BY 1, 2, 3
)
"""


@query("lag_p95", with_flat(SQL_HOURLY_LAG + "SELECT * FROM hourly"))
def q_lag_p95(spark, sf_dir):
    f = flat_events(spark, sf_dir).withColumn("period", hour_bucket("ts_ms"))
    return M.lag_percentiles(f, ["db_name", "table_name", "period"])


# Fixed value: ranks of the sketch's quantiles may be off by so much.
SKETCH_RANK_ERROR = 0.01


@query("lag_sketch", with_flat("""
SELECT db_name, table_name, date_trunc('day', make_timestamp(ts_ms * 1000)) AS period, count(*) AS n_events, true AS p50_in_bound, true AS p95_in_bound
FROM flat GROUP BY 1, 2, 3
"""))
def q_lag_sketch(spark, sf_dir):
    """Five-minute sketches merged into days; the exact ranks of their quantiles lie within the bound."""
    f = flat_events(spark, sf_dir).withColumn("period", trunc_ntz("day", ms_to_ntz("ts_ms")))
    days = M.merged_sketches(M.lag_sketches(f), trunc_ntz("day", "window_start"))
    by = ["db_name", "table_name", "period"]
    lag, joined = M.lag_ms(f), f.join(days.drop("sketch"), by)

    def in_bound(q, p):
        # the share of lags below the estimate, and of those up to it, must enclose the rank
        below, upto = (F.avg(c.cast("double")) for c in (lag < F.col(p), lag <= F.col(p)))
        return (below - SKETCH_RANK_ERROR <= q) & (upto + SKETCH_RANK_ERROR >= q)

    return joined.groupBy(*by).agg(F.first("n_events").alias("n_events"), in_bound(0.5, "p50_lag_ms").alias("p50_in_bound"),
                                   in_bound(0.95, "p95_lag_ms").alias("p95_in_bound"))


# Fixed value of the alarm fixture: hourly p95 lag above 4 minutes is a breach.
BREACH_MS = 240_000


@query("breach_streak", with_flat(SQL_HOURLY_LAG + f"""
SELECT db_name, table_name, period, p95_lag_ms, p95_lag_ms > {BREACH_MS} AS breach,
  sum(CAST(p95_lag_ms > {BREACH_MS} AS INTEGER)) OVER (PARTITION BY db_name, table_name ORDER BY period
                                                  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3 AS alarm
FROM hourly
"""))
def q_breach_streak(spark, sf_dir):
    f = flat_events(spark, sf_dir).withColumn("period", hour_bucket("ts_ms"))
    series = M.lag_percentiles(f, ["db_name", "table_name", "period"], quantiles=(0.95,))
    out = M.breach_streaks(series, ["db_name", "table_name"], "period", "p95_lag_ms", BREACH_MS)
    return out.select("db_name", "table_name", "period", "p95_lag_ms", "breach", "alarm")


# --- ledger -----------------------------------------------------------------------------------
def _ledger(spark, sf_dir):
    b = hourly_batches(load(spark, sf_dir, "events"))
    done = b.filter(F.col("hour") < F.lit(BATCH_SPLIT).cast("timestamp_ntz"))
    return b, ledger_rows(done)


SQL_LEDGER = f"""
WITH b AS (
  SELECT 'apply_changes' AS job_name, strftime(date_trunc('hour', ts), '%Y-%m-%d-%H') AS batch_id,
    date_trunc('hour', ts) AS hour, count(*) AS n_events,
    bool_or(event_type = 'error' AND value > 200.0) AS fails
  FROM events GROUP BY date_trunc('hour', ts)
),
d AS (SELECT *, hour + INTERVAL 1 HOUR AS e FROM b WHERE hour < TIMESTAMP '{BATCH_SPLIT}'),
ledger AS (
  SELECT job_name, batch_id, 1 AS attempt, 'STARTED' AS status, e AS started_at, CAST(NULL AS TIMESTAMP) AS completed_at,
         CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS VARCHAR) AS error_message FROM d
  UNION ALL
  SELECT job_name, batch_id, 1, CASE WHEN fails THEN 'FAILED' ELSE 'SUCCESS' END, e, e + INTERVAL 1 MINUTE,
         CASE WHEN NOT fails THEN n_events END, CASE WHEN fails THEN 'sink write failed: error event in batch' END FROM d
  UNION ALL
  SELECT job_name, batch_id, 2, 'STARTED', e + INTERVAL 5 MINUTE, NULL, NULL, NULL FROM d WHERE fails
  UNION ALL
  SELECT job_name, batch_id, 2, 'SUCCESS', e + INTERVAL 5 MINUTE, e + INTERVAL 6 MINUTE, n_events, NULL FROM d WHERE fails
),
cur AS (
  SELECT * FROM ledger QUALIFY row_number() OVER (PARTITION BY job_name, batch_id
    ORDER BY attempt DESC, CASE WHEN status = 'STARTED' THEN 0 ELSE 1 END DESC, coalesce(completed_at, started_at) DESC) = 1
)
"""


@query("ledger_current", SQL_LEDGER + "SELECT * FROM cur")
def q_ledger_current(spark, sf_dir):
    return L.ledger_current(_ledger(spark, sf_dir)[1])


@query("pending_batches", SQL_LEDGER + """
SELECT job_name, batch_id, n_events FROM b
WHERE NOT EXISTS (SELECT 1 FROM cur WHERE cur.batch_id = b.batch_id AND cur.job_name = b.job_name AND status = 'SUCCESS')
""")
def q_pending_batches(spark, sf_dir):
    b, led = _ledger(spark, sf_dir)
    return L.pending_batches(b.select("job_name", "batch_id", "n_events"), led)


# Fixed value of the expiry fixture: the day the expiry runs.
LEDGER_AS_OF = "2024-02-10 00:00:00"


@query("ledger_expiry", SQL_LEDGER + f"""
SELECT * FROM ledger WHERE started_at >= TIMESTAMP '{LEDGER_AS_OF}' - INTERVAL 30 DAY
""")
def q_ledger_expiry(spark, sf_dir):
    return L.expire(_ledger(spark, sf_dir)[1], F.lit(LEDGER_AS_OF).cast("timestamp_ntz"))


@query("ledger_start", SQL_LEDGER + f"""
SELECT b.job_name, b.batch_id, CAST(coalesce(c.attempt, 0) + 1 AS INTEGER) AS attempt, 'STARTED' AS status,
  TIMESTAMP '{LEDGER_AS_OF}' AS started_at, CAST(NULL AS TIMESTAMP) AS completed_at,
  CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS VARCHAR) AS error_message
FROM b LEFT JOIN cur c USING (job_name, batch_id)
WHERE c.status IS NULL OR c.status <> 'SUCCESS'
""")
def q_ledger_start(spark, sf_dir):
    b, led = _ledger(spark, sf_dir)
    return L.start_marks(b.select("job_name", "batch_id"), led, F.lit(LEDGER_AS_OF))


@query("success_rate", SQL_LEDGER + """
SELECT CAST(date_trunc('day', started_at) AS TIMESTAMP) AS period, count(*) AS runs,
  CAST(count(*) FILTER (WHERE status = 'SUCCESS') AS BIGINT) AS succeeded,
  count(*) FILTER (WHERE status = 'SUCCESS') / count(*) AS success_rate
FROM ledger WHERE status IN ('SUCCESS', 'FAILED') GROUP BY 1
""")
def q_success_rate(spark, sf_dir):
    return L.success_rate(_ledger(spark, sf_dir)[1], trunc_ntz("day", "started_at"))


# Alarm when under 98 % of runs succeed over 24 hours, or over 1 % of lines are quarantined in an hour.
SUCCESS_FLOOR, QUARANTINE_CEILING = 0.98, 0.01


@query("success_24h", SQL_LEDGER + f""",
hourly AS (
  SELECT job_name, date_trunc('hour', started_at) AS period, count(*) AS runs, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded
  FROM ledger WHERE status IN ('SUCCESS', 'FAILED') GROUP BY 1, 2
)
SELECT job_name, CAST(period AS TIMESTAMP) AS period, CAST(sum(succeeded) OVER w AS BIGINT) AS succeeded_24h, CAST(sum(runs) OVER w AS BIGINT) AS runs_24h,
  sum(succeeded) OVER w / sum(runs) OVER w AS success_rate, sum(succeeded) OVER w / sum(runs) OVER w < {SUCCESS_FLOOR} AS alarm
FROM hourly WINDOW w AS (PARTITION BY job_name ORDER BY period RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW)
""")
def q_success_24h(spark, sf_dir):
    """A7 with its alarm: the share of runs of the last 24 hours that succeeded, each hour."""
    hourly = L.success_rate(_ledger(spark, sf_dir)[1], trunc_ntz("hour", "started_at"), by=["job_name"])
    out = M.rolling(hourly, ["job_name"], "period", 60, 24, "succeeded", "runs")
    return out.select("job_name", "period", F.col("succeeded_sum").alias("succeeded_24h"), F.col("runs_sum").alias("runs_24h"),
                      F.col("rate").alias("success_rate"), (F.col("rate") < SUCCESS_FLOOR).alias("alarm"))


@query("quarantine_1h", f"""
WITH series AS (
  SELECT time_bucket(INTERVAL '5 minutes', ts) AS period, count(*) AS n, count(*) FILTER (WHERE {_SQL_REASON} IS NOT NULL) AS q FROM events GROUP BY 1
)
SELECT period, CAST(sum(q) OVER w AS BIGINT) AS n_quarantined_1h, CAST(sum(n) OVER w AS BIGINT) AS n_lines_1h,
  sum(q) OVER w / sum(n) OVER w AS quarantine_rate, sum(q) OVER w / sum(n) OVER w > {QUARANTINE_CEILING} AS alarm
FROM series WINDOW w AS (ORDER BY period RANGE BETWEEN INTERVAL 55 MINUTE PRECEDING AND CURRENT ROW)
""")
def q_quarantine_1h(spark, sf_dir):
    """A8 with its alarm: the share of lines of the last hour that were quarantined, every five minutes."""
    ev = spread(load(spark, sf_dir, "events"))
    lines = dirty_event_lines(ev, keep=[F.window("ts", "5 minutes")["start"].alias("landed")])
    series = M.quarantine_rate(Q.classify(parse_change_lines(lines), contract_table(spark)), F.col("landed")).withColumn("feed", F.lit("all"))
    out = M.rolling(series, ["feed"], "period", 5, 12, "n_quarantined", "n_lines")
    return out.select("period", F.col("n_quarantined_sum").alias("n_quarantined_1h"), F.col("n_lines_sum").alias("n_lines_1h"),
                      F.col("rate").alias("quarantine_rate"), (F.col("rate") > QUARANTINE_CEILING).alias("alarm"))
