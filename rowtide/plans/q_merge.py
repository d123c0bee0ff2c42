"""Queries: J1, J2, J5, J6, J8, J9, J10 — merges into targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.operators.envelope import latest_change_per_key, typed_changes
from rowtide.operators.merge import (
    apply_changes,
    delete_physical,
    delete_soft,
    merge_replace,
    merge_update,
    not_deleted,
    visible,
)
from rowtide.plans.common import BATCH_SPLIT, ORDERS, TIER_SECOND, USERS, epoch_ms, flat_events, staged, with_flat
from rowtide.plans.q_envelope import SQL_CURRENT_USERS
from rowtide.plans.registry import query
from rowtide.sources.fixtures import load, spread

# --- orders: target, and a re-sync batch derived from lineitem ----------------


def orders_target(spark, sf_dir) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(*[F.col(c).cast(ORDERS.type_of(c)).alias(c) for c in ORDERS.columns])


def orders_resync(spark, sf_dir) -> DataFrame:
    """Per order: status and total recomputed from its line items.

    All lines F → F, all O → O, else P; total = Σ price·(1+tax)·(1−discount).
    One aggregation over lineitem (partial aggregation before the shuffle).
    """
    li = spread(load(spark, sf_dir, "lineitem"))  # decimal arithmetic per line: use every core
    price = (
        F.col("l_extendedprice").cast("decimal(12,2)")
        * (F.lit(1) + F.col("l_tax").cast("decimal(4,2)"))
        * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    )
    return staged(li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.when(F.bool_and(F.col("l_linestatus") == "F"), "F")
        .when(F.bool_and(F.col("l_linestatus") == "O"), "O")
        .otherwise("P").alias("o_orderstatus"),
        F.sum(price).cast("decimal(12,2)").alias("o_totalprice"),
    ))


def orphan_orders(spark, sf_dir) -> DataFrame:
    """Orders without any line item: the delete batch."""
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return staged(orders_target(spark, sf_dir).join(li, "o_orderkey", "left_anti").select("o_orderkey"))


SQL_ORDERS = """
tgt AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
         o_orderdate, o_orderpriority FROM orders
),
rs AS (
  SELECT l_orderkey AS o_orderkey,
    CASE WHEN bool_and(l_linestatus = 'F') THEN 'F' WHEN bool_and(l_linestatus = 'O') THEN 'O' ELSE 'P' END AS o_orderstatus,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 + CAST(l_tax AS DECIMAL(4,2)))
             * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(12,2)) AS o_totalprice
  FROM lineitem GROUP BY l_orderkey
),
orphans AS (
  SELECT o_orderkey FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = t.o_orderkey)
)
"""


@query("merge_replace", "WITH " + SQL_ORDERS + """,
staged AS (
  SELECT t.o_orderkey, t.o_custkey, r.o_orderstatus, r.o_totalprice, t.o_orderdate, t.o_orderpriority
  FROM rs r JOIN tgt t USING (o_orderkey)
)
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM staged
""")
def q_merge_replace(spark, sf_dir):
    tgt = orders_target(spark, sf_dir)
    rs = orders_resync(spark, sf_dir)
    staged = rs.join(tgt.drop("o_orderstatus", "o_totalprice"), "o_orderkey").select(*tgt.columns)
    return merge_replace(tgt, staged, ORDERS.primary_keys)


@query("merge_update", "WITH " + SQL_ORDERS + """
SELECT COALESCE(t.o_orderkey, r.o_orderkey) AS o_orderkey, t.o_custkey,
  CASE WHEN r.o_orderkey IS NOT NULL THEN r.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  CASE WHEN r.o_orderkey IS NOT NULL THEN r.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
  t.o_orderdate, t.o_orderpriority
FROM tgt t FULL OUTER JOIN rs r ON t.o_orderkey = r.o_orderkey
""")
def q_merge_update(spark, sf_dir):
    return merge_update(orders_target(spark, sf_dir), orders_resync(spark, sf_dir), ORDERS.primary_keys,
                        ["o_orderstatus", "o_totalprice"])


@query("delete_physical", "WITH " + SQL_ORDERS + """
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM orphans d WHERE d.o_orderkey = t.o_orderkey)
""")
def q_delete_physical(spark, sf_dir):
    return delete_physical(orders_target(spark, sf_dir), orphan_orders(spark, sf_dir), ORDERS.primary_keys)


@query("delete_soft", "WITH " + SQL_ORDERS + f"""
SELECT t.*, CASE WHEN d.o_orderkey IS NOT NULL THEN TIMESTAMP '{TIER_SECOND}' END AS deleted_at
FROM tgt t LEFT JOIN orphans d USING (o_orderkey)
""")
def q_delete_soft(spark, sf_dir):
    return delete_soft(orders_target(spark, sf_dir), orphan_orders(spark, sf_dir), ORDERS.primary_keys,
                       F.lit(TIER_SECOND).cast("timestamp_ntz"))


@query("not_deleted", "WITH " + SQL_ORDERS + """
SELECT * FROM tgt t WHERE NOT EXISTS (SELECT 1 FROM orphans d WHERE d.o_orderkey = t.o_orderkey)
""")
def q_not_deleted(spark, sf_dir):
    soft = delete_soft(orders_target(spark, sf_dir), orphan_orders(spark, sf_dir), ORDERS.primary_keys,
                       F.lit(TIER_SECOND).cast("timestamp_ntz"))
    return not_deleted(soft).drop("deleted_at")


# --- users: the events log applied as two batches ---------------------------------


def user_changes(flat: DataFrame) -> DataFrame:
    return staged(typed_changes(latest_change_per_key(flat, USERS.primary_keys), USERS))


def user_batches(spark, sf_dir):
    flat = flat_events(spark, sf_dir)
    cut = epoch_ms(BATCH_SPLIT)
    return flat.filter(F.col("ts_ms") < cut), flat.filter(F.col("ts_ms") >= cut)


def _users_out(state: DataFrame) -> DataFrame:
    return visible(state.withColumn("updated_ts_ms", F.col("_ts_ms"))).select(*USERS.columns, "updated_ts_ms")


@query("apply_batch", with_flat(SQL_CURRENT_USERS))
def q_apply_batch(spark, sf_dir):
    """Days 1–15 applied to an empty table, then day 16 on: equals the full log."""
    b1, b2 = user_batches(spark, sf_dir)
    c1 = user_changes(b1)
    empty = c1.where(F.lit(False))
    s1 = apply_changes(empty, c1, USERS.primary_keys)
    s2 = apply_changes(s1, user_changes(b2), USERS.primary_keys)
    return _users_out(s2)


@query("ordered_merge", with_flat(SQL_CURRENT_USERS))
def q_ordered_merge(spark, sf_dir):
    """Batches arrive in the wrong order: the late, older batch must lose."""
    b1, b2 = user_batches(spark, sf_dir)
    c2 = user_changes(b2)
    empty = c2.where(F.lit(False))
    s1 = apply_changes(empty, c2, USERS.primary_keys)
    s2 = apply_changes(s1, user_changes(b1), USERS.primary_keys)
    s3 = apply_changes(s2, user_changes(b1), USERS.primary_keys)  # replayed batch: no effect
    return _users_out(s3)


@query("apply_batch_soft", with_flat("""
SELECT user_id, dvalue AS value, props, event_type,
  CASE WHEN op = 'd' THEN make_timestamp(ts_ms * 1000) END AS deleted_at
FROM flat
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, file_seq DESC, binlog_pos DESC) = 1
"""))
def q_apply_batch_soft(spark, sf_dir):
    """Soft-delete table: a delete keeps the last attributes, sets deleted_at."""
    flat = flat_events(spark, sf_dir)
    cut = epoch_ms(BATCH_SPLIT)
    state = None
    for batch in (flat.filter(F.col("ts_ms") < cut), flat.filter(F.col("ts_ms") >= cut)):
        ch = user_changes(batch)
        if state is None:
            state = ch.where(F.lit(False)).withColumn("deleted_at", F.lit(None).cast("timestamp_ntz"))
        state = apply_changes(state, ch, USERS.primary_keys, soft_delete=True)
    return visible(state, soft_delete=True).select(*USERS.columns, "deleted_at")


# --- J10: broadcast dimension enrichment, behind a row bound ----------------------


@query("dim_enrich", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, s.s_name, n.n_name, r.r_name
FROM lineitem l
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""")
def q_dim_enrich(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nr = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    supp = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    dim = supp.join(nr, supp.s_nationkey == nr.n_nationkey, "left").select(
        "s_suppkey", "s_name", "n_name", "r_name")
    return li.join(dim, li.l_suppkey == dim.s_suppkey, "left").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "s_name", "n_name", "r_name")
