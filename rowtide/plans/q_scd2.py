"""Queries: J3, J4, J7, W2, J11 — SCD2 on customer tiers and on the events log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.functions.keys import binlog_file_seq
from rowtide.operators.envelope import typed_changes
from rowtide.operators.scd2 import (
    as_of_join,
    open_versions,
    scd2_close,
    scd2_delete,
    scd2_history,
    scd2_insert,
    scd2_merge,
)
from rowtide.plans.common import CUSTOMER, HISTORY_START, TIER_FIRST, TIER_SECOND, USERS, flat_events, with_flat
from rowtide.plans.registry import query
from rowtide.session import scratch_path
from rowtide.sinks.log import stage_batch
from rowtide.sources.fixtures import load

# Customer tier thresholds on cumulative order value.
TIER_THRESHOLDS = (("platinum", 3_000_000), ("gold", 2_000_000), ("silver", 1_000_000))
TIER_FLOOR = "bronze"

KEYS = list(CUSTOMER.primary_keys)
ATTRS = list(CUSTOMER.attribute_columns)


def customer_tiers(spark, sf_dir, as_of: str) -> DataFrame:
    """Customer rows with ``tier`` from the value of orders placed before ``as_of``.

    Orders are aggregated per customer first (partial aggregation before
    the shuffle), then joined to customer: one row per customer each side.
    """
    o = load(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit(as_of).cast("timestamp_ntz"))
    spend = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("_spend"))
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    s = F.coalesce(F.col("_spend"), F.lit(0))
    tier = None
    for name, floor in TIER_THRESHOLDS:
        tier = F.when(s >= floor, name) if tier is None else tier.when(s >= floor, name)
    tier = tier.otherwise(TIER_FLOOR)
    return c.join(spend, "c_custkey", "left").select(*KEYS, "c_name", "c_nationkey", "c_mktsegment", tier.alias("tier"))


def tier_dim(spark, sf_dir) -> DataFrame:
    return open_versions(customer_tiers(spark, sf_dir, TIER_FIRST), F.lit(HISTORY_START))


def _eff(ts: str):
    return F.lit(ts).cast("timestamp_ntz")


def _tier_sql(name: str, as_of: str) -> str:
    case = " ".join(f"WHEN coalesce(s.spend, 0) >= {v} THEN '{n}'" for n, v in TIER_THRESHOLDS)
    return f"""{name} AS (
  SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment,
    CASE {case} ELSE '{TIER_FLOOR}' END AS tier
  FROM customer c LEFT JOIN (
    SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS spend FROM orders
    WHERE o_orderdate < TIMESTAMP '{as_of}' GROUP BY o_custkey) s ON s.o_custkey = c.c_custkey
)"""


_H = "md5(concat_ws('||', coalesce(CAST({p}c_name AS VARCHAR), ''), coalesce(CAST({p}c_nationkey AS VARCHAR), ''), " \
     "coalesce(CAST({p}c_mktsegment AS VARCHAR), ''), coalesce(CAST({p}tier AS VARCHAR), '')))"
H_D, H_S = _H.format(p="d."), _H.format(p="s.")

SQL_TIERS = "WITH " + _tier_sql("t1", TIER_FIRST) + ",\n" + _tier_sql("t2", TIER_SECOND) + f""",
dim AS (SELECT *, TIMESTAMP '{HISTORY_START}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM t1),
closed AS (
  SELECT d.c_custkey, d.c_name, d.c_nationkey, d.c_mktsegment, d.tier, d.valid_from,
    CASE WHEN s.c_custkey IS NOT NULL AND {H_D} <> {H_S} THEN TIMESTAMP '{TIER_SECOND}' ELSE d.valid_to END AS valid_to,
    NOT (s.c_custkey IS NOT NULL AND {H_D} <> {H_S}) AS is_current
  FROM dim d LEFT JOIN t2 s USING (c_custkey)
),
inserted AS (
  SELECT s.c_custkey, s.c_name, s.c_nationkey, s.c_mktsegment, s.tier, TIMESTAMP '{TIER_SECOND}' AS valid_from,
    CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM t2 s LEFT JOIN dim d ON d.c_custkey = s.c_custkey
  WHERE d.c_custkey IS NULL OR {H_D} <> {H_S}
),
merged AS (SELECT * FROM closed UNION ALL SELECT * FROM inserted)
"""


@query("scd2_close", SQL_TIERS + "SELECT * FROM closed")
def q_scd2_close(spark, sf_dir):
    return scd2_close(tier_dim(spark, sf_dir), customer_tiers(spark, sf_dir, TIER_SECOND), KEYS, ATTRS,
                      _eff(TIER_SECOND))


@query("scd2_insert", SQL_TIERS + "SELECT * FROM inserted")
def q_scd2_insert(spark, sf_dir):
    return scd2_insert(tier_dim(spark, sf_dir), customer_tiers(spark, sf_dir, TIER_SECOND), KEYS, ATTRS,
                       _eff(TIER_SECOND))


@query("scd2_merge", SQL_TIERS + "SELECT * FROM merged")
def q_scd2_merge(spark, sf_dir):
    return scd2_merge(tier_dim(spark, sf_dir), customer_tiers(spark, sf_dir, TIER_SECOND), KEYS, ATTRS,
                      _eff(TIER_SECOND))


@query("scd2_delete", SQL_TIERS + f"""
SELECT m.c_custkey, m.c_name, m.c_nationkey, m.c_mktsegment, m.tier, m.valid_from,
  CASE WHEN m.is_current AND c.c_acctbal < 0 THEN TIMESTAMP '{TIER_SECOND}' ELSE m.valid_to END AS valid_to,
  m.is_current AND NOT coalesce(c.c_acctbal < 0, false) AS is_current
FROM merged m LEFT JOIN customer c USING (c_custkey)
""")
def q_scd2_delete(spark, sf_dir):
    """Closed accounts (negative balance) are deleted after the merge."""
    merged = scd2_merge(tier_dim(spark, sf_dir), customer_tiers(spark, sf_dir, TIER_SECOND), KEYS, ATTRS,
                        _eff(TIER_SECOND))
    closed = load(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(*KEYS)
    return scd2_delete(merged, closed, KEYS, _eff(TIER_SECOND))


@query("scd2_as_of", SQL_TIERS + """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, m.tier
FROM orders o LEFT JOIN merged m
  ON o.o_custkey = m.c_custkey AND o.o_orderdate >= m.valid_from
 AND (m.valid_to IS NULL OR o.o_orderdate < m.valid_to)
""")
def q_scd2_as_of(spark, sf_dir):
    merged = scd2_merge(tier_dim(spark, sf_dir), customer_tiers(spark, sf_dir, TIER_SECOND), KEYS, ATTRS,
                        _eff(TIER_SECOND))
    facts = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return as_of_join(facts, merged, ["o_custkey"], KEYS, "o_orderdate", ["tier"])


@query("scd2_history", with_flat("""
k AS (
  SELECT *,
    lag(op) OVER w AS prev_op,
    lag(md5(concat_ws('||', coalesce(event_type, '')))) OVER w AS prev_h,
    md5(concat_ws('||', coalesce(event_type, ''))) AS h
  FROM (SELECT user_id, op, CASE WHEN op <> 'd' THEN event_type END AS event_type, ts_ms, file_seq, binlog_pos FROM flat)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, file_seq, binlog_pos)
),
kept AS (
  SELECT * FROM k
  WHERE (op = 'd' AND prev_op IS NOT NULL AND prev_op <> 'd')
     OR (op <> 'd' AND (prev_op IS NULL OR prev_op = 'd' OR h IS DISTINCT FROM prev_h))
),
v AS (
  SELECT *, lead(ts_ms) OVER (PARTITION BY user_id ORDER BY ts_ms, file_seq, binlog_pos) AS next_ms FROM kept
)
SELECT user_id, event_type, make_timestamp(ts_ms * 1000) AS valid_from,
  make_timestamp(next_ms * 1000) AS valid_to, next_ms IS NULL AS is_current
FROM v WHERE op <> 'd'
""").replace("WITH ev AS", "WITH ev AS", 1))
def q_scd2_history(spark, sf_dir):
    """Versions of each user's event_type from every event of the log."""
    ch = typed_changes(flat_events(spark, sf_dir), USERS)
    ch = ch.withColumn("event_type", F.when(F.col("_op") != "d", F.col("event_type")))
    order = [F.col("_ts_ms"), F.col("_file_seq"), F.col("_pos")]
    ch = ch.select("user_id", "event_type", "_op", "_ts_ms", "_file_seq", "_pos")
    ch = spark.read.parquet(stage_batch(ch, scratch_path(spark, "changes"), "b1"))  # to count, then to build
    return scd2_history(ch, USERS.primary_keys, ["event_type"], order)
