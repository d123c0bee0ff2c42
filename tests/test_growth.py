"""What a task holds or a query derives again must not grow faster than its input."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rowtide.operators.scd2 import empty_points, scd2_apply, scd2_history, versions
from rowtide.operators.sequence import group_columns, hot_groups
from rowtide.operators.envelope import latest_typed_per_key
from rowtide.plans import batch_job, q_io
from rowtide.session import scratch_path
from rowtide.sinks.log import append_silver, new_events, stage_counted
from rowtide.sources.changelog import split_glued
from rowtide.sources.fixtures import spread

ORDER = ("_ts_ms", "_file_seq", "_pos")
LOG = "k int, v string, _op string, _ts_ms long, _file_seq long, _pos long"


def _log(seed=3, n=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.5 else rnd.choice([None, *range(1, 30)])  # key 0 is hot
        op = rnd.choice("cuud")
        rows.append((k, None if op == "d" else rnd.choice(["a", "b", None]), op, rnd.randrange(0, 60_000), rnd.randrange(3), i))
    return rows


def _brute(rows):
    out = []
    for k in {r[0] for r in rows}:
        kept, prev = [], None
        for r in sorted((r for r in rows if r[0] == k), key=lambda r: r[3:]):
            was_open = prev is not None and prev[2] != "d"
            if was_open if r[2] == "d" else not was_open or r[1] != prev[1]:
                kept.append(r)
            prev = r
        for r, after in zip(kept, [*kept[1:], None]):
            if r[2] != "d":
                out.append((k, r[1], r[3], after and after[3]))
    return sorted(out, key=repr)


def _found(history):
    ms = lambda x: None if x is None else round(x.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = history.collect()
    assert all(r.is_current == (r.valid_to is None) for r in rows)
    return sorted(((r.k, r.v, ms(r.valid_from), ms(r.valid_to)) for r in rows), key=repr)


@pytest.mark.parametrize("hot_rows", (0, 100, 10**9))
def test_history_is_independent_of_which_keys_are_hot(spark, hot_rows):
    rows = _log()
    df = spark.createDataFrame(rows, LOG)
    assert hot_groups(*group_columns(df, ["k"]), 100).count() == 1
    assert _found(scd2_history(df, ["k"], ["v"], [F.col(c) for c in ORDER], segment_seconds=7, hot_rows=hot_rows)) == _brute(rows)


@pytest.mark.parametrize("hot_rows", (0, 100, 10**9))
def test_late_and_repeated_batches_with_hot_keys(spark, hot_rows):
    rows = [r for r in _log(4) if r[0] is not None]
    df = spark.createDataFrame(rows, LOG)
    points = empty_points(df)
    for part in (2, 0, 1, 0):
        staged = df.filter(F.pmod("_pos", F.lit(3)) == part)
        points = scd2_apply(points, staged.unionByName(staged), ["k"], ["v"], segment_seconds=7, hot_rows=hot_rows).checkpoint()
    assert points.count() == len(rows)
    assert _found(versions(points, ["k"], ["v"])) == _brute(rows)


def test_untouched_keys_keep_their_intervals(spark):
    at = dt.datetime(2001, 1, 1)
    df = spark.createDataFrame([(1, "a", "c", 5, 1, 1), (2, "a", "c", 5, 1, 2)], LOG)
    stored = df.select("*", F.lit(at).cast("timestamp_ntz").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    out = scd2_apply(stored, spark.createDataFrame([(2, "b", "u", 9, 1, 3)], LOG), ["k"], ["v"])
    assert [r.valid_from for r in out.filter("k = 1").collect()] == [at]
    assert out.filter("k = 2 AND valid_to IS NOT NULL").count() == 1 and out.filter("k = 2").count() == 2
    assert all(r.valid_from != at for r in scd2_apply(stored, df.limit(0), ["k"], ["v"], everything=True).collect())


def test_keys_with_few_rows_need_no_summary(spark):
    """Memory of a task: one sort, no copy of the rows in a summary to join with."""
    h = scd2_history(spark.createDataFrame(_log(), LOG), ["k"], ["v"], [F.col(c) for c in ORDER])
    h.collect()
    plan = h._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Window" in plan and "max_by" not in plan and "SortMergeJoin" not in plan


def test_lines_are_dealt_to_more_tasks_the_more_there_are(spark):
    path = scratch_path(spark, "narrow")
    spark.range(5000).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert spread(df, "id", rows=100).rdd.getNumPartitions() == 50
    out = spread(df, "id", rows=100)
    assert max(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()) < 300
    assert (out.count(), out.agg(F.sum("id")).first()[0]) == (5000, 4999 * 2500)


def _flat(spark, n):
    return spark.range(n).select(F.lit("app").alias("db_name"), F.lit("users").alias("table_name"), F.sha2(F.col("id").cast("string"), 256).alias("pk_hash"),
                                 F.lit("u").alias("op"), (F.col("id") * 40_000_000).alias("ts_ms"), F.lit("f.1").alias("binlog_file"), F.col("id").alias("binlog_pos"))


def test_silver_batch_is_shuffled_once_for_dedup_and_lookup(spark):
    root = scratch_path(spark, "silver")
    append_silver(_flat(spark, 50), root)
    both = _flat(spark, 80).unionByName(_flat(spark, 80))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = new_events(both, root)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(event_key") == 2 and "hashpartitioning(dt" not in plan  # the batch and the stored events
        assert sorted(r.binlog_pos for r in new.collect()) == list(range(50, 80))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    append_silver(both, root)
    assert spark.read.parquet(root).count() == 80


def test_append_log_parses_the_lines_once(spark, monkeypatch):
    plans = []

    def spy(name):
        real = getattr(q_io, name)

        def append(flat, root):
            plans.append(flat._jdf.queryExecution().optimizedPlan().toString())
            return real(flat, root)
        monkeypatch.setattr(q_io, name, append)

    spy("append_log")
    spy("append_silver")
    out = q_io.q_append_log(spark, "/root/testdata/sf0.001")
    assert len(plans) == 4 and not any("from_json" in p or "JsonToStructs" in p for p in plans)
    assert {(r.log, r.n_copies) for r in out.select("log", "n_copies").distinct().collect()} == {("log", 2), ("silver", 1)}


def test_replayed_silver_batch_is_not_deduplicated_before_the_lookup(spark):
    root = scratch_path(spark, "silver-replay")
    append_silver(_flat(spark, 50), root)
    plan = new_events(_flat(spark, 50), root)._jdf.queryExecution().optimizedPlan()
    assert "Aggregate" in str(plan.nodeName())  # what the look-up leaves, not what goes into it
    assert new_events(_flat(spark, 50).unionByName(_flat(spark, 50)), root).count() == 0


def _dictionaries(path):
    found = {}
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            for c in range(meta.num_columns):
                col = meta.row_group(g).column(c)
                found[col.path_in_schema] = found.get(col.path_in_schema, False) or col.has_dictionary_page
    return found


def test_staged_rows_and_digests_are_written_without_dictionaries(spark):
    path = scratch_path(spark, "staged")
    assert stage_counted(_flat(spark, 50), path, {"n": F.count("*")}) == {"n": 50}
    assert spark.read.parquet(path).count() == 50 and not any(_dictionaries(path).values())
    append_silver(_flat(spark, 50), path + "-silver")
    found = _dictionaries(path + "-silver")
    assert not found["event_key"] and not found["pk_hash"] and found["op"]


def test_two_jobs_read_the_lines_from_disk(spark, monkeypatch):
    """Three attempts at one batch: its lines are encoded once, not by each of them."""
    seen = []
    monkeypatch.setattr(q_io, "process_batch", lambda spark, lines, *a, **k: seen.append(lines))
    q_io.q_ledger_two_jobs(spark, "/root/testdata/sf0.001")
    assert len(seen) == 4
    assert not any("StructsToJson" in p or "to_json" in p for p in (d._jdf.queryExecution().optimizedPlan().toString() for d in seen))
    want = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert seen[0].count() == want


@pytest.mark.parametrize("gap", ["", " ", "\t", "\n", "\x0b", "\f", "\r", " \r\n "])
def test_glued_lines_are_split_at_any_white_space(spark, gap):
    one, two, not_glued = '{"a":{"b":1}}', '{"op":"u","x":"} {"}', '{"a":"}"} x'
    rows = spark.createDataFrame([(one + gap + two,), (one,), (not_glued,), (" ",), (None,)], "value string")
    assert sorted(r.value for r in split_glued(rows).collect()) == sorted([one, two, one, not_glued])


def test_lines_without_a_boundary_skip_the_expression(spark):
    plan = split_glued(spark.createDataFrame([("x",)], "value string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" in plan or "contains(" in plan.lower()


def test_good_rows_stage_no_line(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(batch_job, "_write_quarantine", lambda bad, n, cfg, batch, part: kept.append((part, n, [r.raw for r in bad.collect()])))
    monkeypatch.setattr(batch_job, "latest_typed_per_key", lambda changes, c: (rows.extend(spark.read.parquet(*paths()).collect()), real(changes, c))[1])
    rows, real = [], latest_typed_per_key
    cfg = batch_job.JobConfig(root=scratch_path(spark, "no-line"), enabled_sinks=())

    def paths():
        return glob.glob(f"{cfg.root}/_stage/*/*/*/checked/*")

    image = '{"payload":{"op":"c","ts_ms":1,"source":{"db":"app","table":"users","pos":1},"after":{"user_id":"%s","value":"%s"}}}'
    lines = spark.createDataFrame([(image % ("1", "2.5"),), (image % ("2", "9x"),)], "value string")
    batch_job.process_batch(spark, lines, "b", cfg, raise_on_error=True)
    assert kept[-1] == ("app.users", 1, [image % ("2", "9x")])
    assert {(r.user_id, r.raw) for r in rows} == {(1, None), (2, image % ("2", "9x"))}
