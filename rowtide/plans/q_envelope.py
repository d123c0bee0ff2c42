"""Queries: S1/P1–P11, W1 — parse, flatten, latest per key, route, type."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowtide.functions.keys import change_hash, pk_hash, pk_hash_strict
from rowtide.operators.envelope import (
    current_state,
    latest_change_per_key,
    latest_per_key,
    typed_changes,
)
from rowtide.plans.common import LINEITEM, ORDERS, USERS, flat_events, with_flat
from rowtide.plans.registry import query
from rowtide.sources.fixtures import load


@query("flatten_envelope", with_flat("""
SELECT db_name, table_name, op, ts_ms, source_ts_ms, is_snapshot, binlog_file, binlog_pos, pk_hash,
  CASE WHEN op <> 'd' THEN CAST(dvalue AS VARCHAR) END AS after_value,
  CASE WHEN op <> 'd' THEN json_extract_string(props, '$.k') END AS after_k,
  CASE WHEN op IN ('u', 'd') THEN CAST(user_id AS VARCHAR) END AS before_user_id
FROM flat
"""))
def q_flatten_envelope(spark, sf_dir):
    f = flat_events(spark, sf_dir)
    return f.select(
        "db_name", "table_name", "op", "ts_ms", "source_ts_ms", "is_snapshot", "binlog_file",
        "binlog_pos", "pk_hash",
        F.col("after")["value"].alias("after_value"),
        F.col("after")["k"].alias("after_k"),
        F.col("before")["user_id"].alias("before_user_id"),
    )


@query("latest_per_key", with_flat("""
SELECT db_name, table_name, user_id, pk_hash, op, ts_ms, binlog_file, binlog_pos
FROM flat
QUALIFY row_number() OVER (PARTITION BY db_name, table_name, user_id
                           ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1
"""))
def q_latest_per_key(spark, sf_dir):
    latest = latest_change_per_key(flat_events(spark, sf_dir), USERS.primary_keys)
    key = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))["user_id"]
    return latest.select(
        "db_name", "table_name", key.cast("bigint").alias("user_id"), "pk_hash", "op", "ts_ms",
        "binlog_file", "binlog_pos",
    )


_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus"]


@query("latest_composite_key", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in _LI_ORDER)}) = 1
""")
def q_latest_composite_key(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return latest_per_key(li, list(LINEITEM.primary_keys), [F.col(c).desc_nulls_last() for c in _LI_ORDER])


SQL_CURRENT_USERS = """
SELECT user_id, dvalue AS value, props, event_type, ts_ms AS updated_ts_ms
FROM (
  SELECT * FROM flat
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1
) WHERE op <> 'd'
"""


@query("current_state", with_flat(SQL_CURRENT_USERS))
def q_current_state(spark, sf_dir):
    return current_state(flat_events(spark, sf_dir), USERS)


@query("route_upserts", with_flat("""
SELECT db_name, table_name, op, ts_ms, source_ts_ms, is_snapshot, pk_hash,
  user_id, dvalue AS value, props, event_type
FROM flat WHERE op IN ('c', 'u', 'r')
"""))
def q_route_upserts(spark, sf_dir):
    """The upserts of the log as typed rows."""
    meta = ["db_name", "table_name", "op", "ts_ms", "source_ts_ms", "is_snapshot", "pk_hash"]
    typed = typed_changes(flat_events(spark, sf_dir), USERS, keep=meta)
    return typed.filter(F.col("_op") != "d").select(*meta, *USERS.columns)


@query("route_deletes", with_flat("""
SELECT db_name, table_name, ts_ms, source_ts_ms, pk_hash, user_id
FROM flat WHERE op = 'd'
"""))
def q_route_deletes(spark, sf_dir):
    """The deletes of the log, with the key of the row as it was."""
    meta = ["db_name", "table_name", "ts_ms", "source_ts_ms", "pk_hash"]
    typed = typed_changes(flat_events(spark, sf_dir), USERS, keep=meta)
    return typed.filter(F.col("_op") == "d").select(*meta, *USERS.primary_keys)


@query("pk_hash", """
SELECT l_orderkey, l_linenumber, l_partkey,
  sha256(concat_ws('||', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))) AS pk_hash,
  sha256(to_json([CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)])) AS pk_hash_strict
FROM lineitem
""")
def q_pk_hash(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    keys = list(LINEITEM.primary_keys)
    return li.select(*keys, "l_partkey", pk_hash(keys).alias("pk_hash"), pk_hash_strict(keys).alias("pk_hash_strict"))


_ORDER_ATTRS = ORDERS.attribute_columns


@query("change_hash", """
SELECT o_orderkey,
  md5(concat_ws('||', COALESCE(CAST(o_custkey AS VARCHAR), ''), COALESCE(o_orderstatus, ''),
      COALESCE(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), ''),
      COALESCE(CAST(o_orderdate AS VARCHAR), ''), COALESCE(o_orderpriority, ''))) AS row_hash
FROM orders
""")
def q_change_hash(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    return o.select("o_orderkey", change_hash(_ORDER_ATTRS).alias("row_hash"))
