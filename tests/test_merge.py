import itertools
import random

from pyspark.sql import functions as F

from cdc_helpers import SF_SMALL
from rowtide.operators.envelope import latest_change_per_key, typed_changes
from rowtide.operators.merge import apply_changes, delete_physical, delete_soft, merge_replace, merge_update, visible
from rowtide.operators.scd2 import empty_points, open_versions, scd2_apply, scd2_history, scd2_merge, versions
from rowtide.plans.common import USERS, flat_events
from rowtide.session import scratch_path


def _state_after(batches, soft=False):
    state = None
    for b in batches:
        ch = typed_changes(latest_change_per_key(b, USERS.primary_keys), USERS)
        if state is None:
            state = ch.where(F.lit(False))
            if soft:
                state = state.withColumn("deleted_at", F.lit(None).cast("timestamp_ntz"))
        state = apply_changes(state, ch, USERS.primary_keys, soft_delete=soft)
    return visible(state, soft).collect()


def _rows(rows):
    return sorted(tuple(r) for r in rows)


def test_any_split_and_order_of_batches_gives_the_same_state(spark):
    flat = flat_events(spark, SF_SMALL).cache()
    whole = _rows(_state_after([flat]))
    cuts = flat.select(F.percentile("ts_ms", [0.3, 0.7]).alias("q")).first().q
    a = flat.filter(F.col("ts_ms") < cuts[0])
    b = flat.filter((F.col("ts_ms") >= cuts[0]) & (F.col("ts_ms") < cuts[1]))
    c = flat.filter(F.col("ts_ms") >= cuts[1])
    for order in [(a, b, c), (c, a, b), (b, c, a)]:
        assert _rows(_state_after(list(order))) == whole


def test_applying_a_batch_twice_equals_once(spark):
    flat = flat_events(spark, SF_SMALL)
    assert _rows(_state_after([flat, flat])) == _rows(_state_after([flat]))


def test_merge_replace_update_and_deletes(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, s string, n int")
    s = spark.createDataFrame([(2, "B", 21), (4, "D", 40)], "k int, s string, n int")
    assert _rows(merge_replace(t, s, ["k"]).collect()) == [(1, "a", 10), (2, "B", 21), (3, "c", 30), (4, "D", 40)]
    upd = merge_update(t, s.select("k", "s"), ["k"], ["s"]).collect()
    assert _rows(upd) == [(1, "a", 10), (2, "B", 20), (3, "c", 30), (4, "D", None)]
    d = spark.createDataFrame([(3,)], "k int")
    assert [r.k for r in delete_physical(t, d, ["k"]).orderBy("k").collect()] == [1, 2]
    soft = delete_soft(t, d, ["k"], F.lit("2024-01-01").cast("timestamp_ntz")).orderBy("k").collect()
    assert [r.deleted_at is not None for r in soft] == [False, False, True]


def test_scd2_intervals_do_not_overlap_and_one_is_open(spark):
    flat = flat_events(spark, SF_SMALL)
    ch = typed_changes(flat, USERS).withColumn("event_type", F.when(F.col("_op") != "d", F.col("event_type")))
    h = scd2_history(ch, ["user_id"], ["event_type"], [F.col("_ts_ms"), F.col("_file_seq"), F.col("_pos")])
    rows = h.orderBy("user_id", "valid_from").collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.user_id, []).append(r)
    for versions in by_key.values():
        assert sum(v.is_current for v in versions) <= 1
        for x, y in itertools.pairwise(versions):
            assert x.valid_to is not None and x.valid_to <= y.valid_from


def test_scd2_merge_closes_changed_and_inserts_new(spark):
    dim = open_versions(spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string"),
                        F.lit("2024-01-01").cast("timestamp_ntz"))
    staged = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c")], "k int, t string")
    out = scd2_merge(dim, staged, ["k"], ["t"], F.lit("2024-02-01").cast("timestamp_ntz")).collect()
    cur = sorted((r.k, r.t) for r in out if r.is_current)
    assert cur == [(1, "a"), (2, "B"), (3, "c")]
    closed = [(r.k, r.t) for r in out if not r.is_current]
    assert closed == [(2, "b")]


def test_one_read_of_the_target_and_one_join(spark):
    t = spark.createDataFrame([(1, "a", "c", 5, 1, 1)], "k int, v string, _op string, _ts_ms long, _file_seq long, _pos long")
    state = spark.read.parquet(_written(spark, t))
    plan = apply_changes(state, t, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Join ") == 1


def _written(spark, df):
    path = scratch_path(spark, "merge-target")
    df.write.parquet(path)
    return path


def test_nulls_in_scd2_merge(spark):
    dim = open_versions(spark.createDataFrame([(1, "gold"), (2, None)], "k int, t string"), F.lit("2024-03-01"))
    batch = spark.createDataFrame([(2, "", "2024-04-01")], "k int, t string, ts string")
    out = scd2_merge(dim, batch, ["k"], ["t"], F.col("ts").cast("timestamp_ntz")).collect()
    assert {(r.k, r.t, r.is_current) for r in out} == {(1, "gold", True), (2, None, False), (2, "", True)}


def test_history_of_any_cut_and_order_equals_that_of_the_whole_log(spark):
    rng = random.Random(5)
    attrs, order = ["event_type", "value"], [F.col(c) for c in ("_ts_ms", "_file_seq", "_pos")]
    log = typed_changes(flat_events(spark, SF_SMALL), USERS).drop("props")
    # few users, so that versions are split often; equal values, so that changes repeat them
    log = log.withColumn("user_id", F.pmod("user_id", F.lit(9))).withColumn("value", F.lit(1).cast("decimal(12,2)")).persist()
    want = sorted(map(tuple, scd2_history(log, ["user_id"], attrs, order).collect()))
    for cuts in (2, 4):
        points = empty_points(log)
        for part in rng.sample(range(cuts), cuts) + [0]:  # one batch again
            staged = log.filter(F.pmod(F.xxhash64("_pos"), F.lit(cuts)) == part)
            points = scd2_apply(points, staged, ["user_id"], attrs, segment_seconds=rng.choice([600, 86400])).checkpoint()
        assert points.count() == log.count()
        assert sorted(map(tuple, versions(points, ["user_id"], attrs).collect())) == want
    log.unpersist()
    assert any(r[4] is not None for r in want) and len(want) < log.filter("_op <> 'd'").count()
