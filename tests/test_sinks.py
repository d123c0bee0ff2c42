import json
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime

import pytest

from pyspark.sql import functions as F

from cdc_helpers import SF_SMALL, envelope
from rowtide.contracts import REGISTRY, ColumnRule, TableContract
from rowtide.operators import ledger as L
from rowtide.plans.batch_job import JobConfig, process_batch, read_current, read_drift, read_scd2, stored_table
from rowtide.plans.common import USERS, event_lines, flat_events
from rowtide.session import scratch_path
from rowtide.sinks import fs, jdbc
from rowtide.sinks.claims import BatchClaimed, claim
from rowtide.sinks.ledger_store import append_marks, expire_stored, read_ledger
from rowtide.sinks.log import append_silver, new_events
from rowtide.sinks.search import document_version, indexed, read_bulk, search_actions, write_bulk
from rowtide.sinks.versioned import KEPT, VersionedTable
from rowtide.sources import landing
from rowtide.schemas import LEDGER


def _replace(target, st):
    return target.join(st.select("k"), "k", "left_anti").unionByName(st)


def test_table_states_are_complete_and_old_ones_leave(spark):
    root = scratch_path(spark, "vt")
    t = VersionedTable(spark, root, ["k"])
    with pytest.raises(FileNotFoundError):
        t.read()
    t.create(spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("v")).schema)
    assert t.read().count() == 0 and t.version() == 1
    t.overwrite(spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")))
    before = t.read()
    for k in (5, 6):
        t.merge(spark.createDataFrame([(k, -1)], "k long, v long"), _replace)
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 1000 and got[5] == got[6] == -1 and got[7] == 14
    assert before.filter("k = 5").first().v == 10  # a reader of an older state is not disturbed
    t.merge(spark.createDataFrame([(7, -1)], "k long, v long"), _replace)
    names = fs.list_names(spark, root)
    assert t.version() == 5 and sum(n.startswith("state-") for n in names) == KEPT


def test_losing_writer_leaves_the_committed_state_intact(spark):
    root = scratch_path(spark, "vt-race")
    base = spark.range(0, 300).select(F.col("id").alias("k"), F.col("id").alias("v"))
    winner, loser = (VersionedTable(spark, root, ["k"]) for _ in range(2))
    winner.overwrite(base)

    def late(target, st):  # another writer commits while this one works
        winner.merge(spark.createDataFrame([(1, 7)], "k long, v long"), _replace)
        return _replace(target, st)

    with pytest.raises(Exception, match="already exists"):
        loser.merge(spark.createDataFrame([(2, -1)], "k long, v long"), late)
    assert winner.read().agg(F.sum("v")).first()[0] == sum(range(300)) + 6


def test_claims_are_exclusive_and_expire(spark):
    folder = scratch_path(spark, "claims") + "/job_name=j/batch_id=b"
    assert claim(spark, folder, 1, 3600) == 1
    with pytest.raises(BatchClaimed):
        claim(spark, folder, 1, 3600)
    assert claim(spark, folder, 2, 0) == 2  # the first one failed and left its mark
    with pytest.raises(BatchClaimed):
        claim(spark, folder, 1, 3600)
    assert claim(spark, folder, 1, 0) == 3  # both runs crashed long ago
    with ThreadPoolExecutor(8) as pool:
        def attempt(_):
            try:
                return claim(spark, folder + "2", 1, 3600)
            except BatchClaimed:
                return None
        assert sorted(pool.map(attempt, range(8)), key=str) == [1] + [None] * 7


def test_two_runs_of_one_batch_at_once_apply_it_once(spark, lines):
    c = TableContract("sales", "customers", ("customer_id",), ("tier",), ("count",))
    applied, gate = [], threading.Barrier(2)

    def sink(spark, contract, typed, batch_id):
        applied.append(typed.count())
        time.sleep(2)

    cfg = JobConfig(root=scratch_path(spark, "twice"), registry={c.fqn: c}, extra_sinks={"count": sink})
    batch = lines(envelope("c", 1, 1000, 1, table="customers", key_col="customer_id", extra={"tier": "gold"}))

    def run(_):
        gate.wait()
        try:
            return process_batch(spark, batch, "b1", cfg).count()
        except BatchClaimed:
            return "claimed"

    with ThreadPoolExecutor(2) as pool:
        assert sorted(pool.map(run, range(2)), key=str) == [1, "claimed"]
    assert applied == [1]
    assert process_batch(spark, batch, "b1", cfg).count() == 0  # done
    crashed = replace(cfg, lease_seconds=0)
    claim(spark, cfg.claim_folder("b2"), 1, 0)  # a run that left no mark
    with pytest.raises(BatchClaimed):
        process_batch(spark, batch, "b2", cfg)
    assert process_batch(spark, batch, "b2", crashed).count() == 1
    marks = read_ledger(spark, cfg.ledger_root).collect()
    assert sorted((r.batch_id, r.attempt, r.status) for r in marks) == [
        ("b1", 1, "STARTED"), ("b1", 1, "SUCCESS"), ("b2", 2, "STARTED"), ("b2", 2, "SUCCESS")]


def test_ledger_errors_are_cut_and_expiry_rewrites_days(spark):
    root = scratch_path(spark, "ledger")
    at = [datetime(2024, 1, d, h) for d, h in ((1, 5), (3, 2), (3, 20), (9, 1))]
    rows = [("j", f"b{k}", 1, "FAILED", t, t, None, "x") for k, t in enumerate(at)]
    append_marks(spark.createDataFrame(rows, LEDGER), root)
    files = {n: fs.list_names(spark, f"{root}/{n}") for n in fs.list_names(spark, root)}
    assert expire_stored(spark, root, datetime(2024, 2, 2, 12)) == 2  # a whole day, and half of one
    assert sorted(r.batch_id for r in read_ledger(spark, root).collect()) == ["b2", "b3"]
    assert fs.list_names(spark, f"{root}/day=2024-01-09") == files["day=2024-01-09"]
    assert expire_stored(spark, root, datetime(2024, 2, 2, 12)) == 0
    assert expire_stored(spark, root, datetime(2024, 2, 2, 21)) == 1  # the rest of that day
    assert [r.batch_id for r in read_ledger(spark, root).collect()] == ["b3"]


def test_bulk_files_are_bounded_requests_and_versions_decide(spark):
    c = TableContract("shop", "items", ("id",), ("name",), ("search",))
    rows = [(i % 40, f"v{i}" * (1 + i % 50), 1000 + i // 3, i, i % 11 == 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, name string, _ts_ms long, _pos long, gone boolean").coalesce(1)
    path = scratch_path(spark, "bulk-bounded")
    acts = search_actions(df, c, deleted=F.col("gone"), version=document_version())
    write_bulk(acts, path, documents=30, max_bytes=4000)
    sizes = [len(r.value.encode()) for r in spark.read.text(path, wholetext=True).collect()]
    assert len(sizes) > 13 and max(sizes) <= 4000
    held = {r._id: json.loads(r.document)["name"] for r in indexed(read_bulk(spark, path)).collect()}
    last = {i: (name, gone) for i, name, _, _, gone in rows}
    assert held == {str(i): name for i, (name, gone) in last.items() if not gone}


def test_silver_append_reads_only_touched_partitions(spark):
    root = scratch_path(spark, "silver-prune")
    flat = flat_events(spark, SF_SMALL).drop("before", "after")
    append_silver(flat, root)
    day = flat.filter(F.to_date(F.timestamp_millis("ts_ms")) == "2024-01-10")
    plan = new_events(day, root)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    assert new_events(day, root).count() == 0


def test_search_actions_and_bulk_lines(spark):
    c = TableContract("shop", "items", ("id",), ("name",), ("search",), soft_delete=False)
    rows = spark.createDataFrame([(1, "a", False), (2, "b", True)], "id int, name string, gone boolean")
    acts = search_actions(rows, c, deleted=F.col("gone")).orderBy("_id").collect()
    assert json.loads(acts[0].action) == {"index": {"_index": "cdc-shop-items", "_id": "1"}}
    assert json.loads(acts[0].document) == {"name": "a", "id": 1}
    assert json.loads(acts[1].action) == {"delete": {"_index": "cdc-shop-items", "_id": "2"}}
    assert acts[1].document is None
    path = scratch_path(spark, "bulk")
    write_bulk(search_actions(rows, c, deleted=F.col("gone")), path)
    assert spark.read.text(path).count() == 3


def test_jdbc_statements():
    c = REGISTRY["sales.products"]
    up = jdbc.upsert_statement(c, "products", "stg")
    assert "ON CONFLICT (product_id) DO UPDATE" in up and "deleted_at = NULL" in up
    assert "EXCLUDED._ts_ms > products._ts_ms" in up
    assert jdbc.delete_statement(c, "products", "stg").startswith("UPDATE products t SET deleted_at")
    assert jdbc.delete_statement(REGISTRY["sales.orders"], "orders", "stg").startswith("DELETE FROM orders")


def test_ledger_failed_batches_are_retried_success_blocks(spark):
    rows = [("j", "b1", 1, "STARTED", None, None, None, None), ("j", "b1", 1, "FAILED", None, None, None, "x"),
            ("j", "b2", 1, "STARTED", None, None, None, None), ("j", "b2", 1, "SUCCESS", None, None, 5, None),
            ("j", "b3", 1, "STARTED", None, None, None, None)]
    led = spark.createDataFrame(rows, LEDGER)
    batches = spark.createDataFrame([("j", "b1"), ("j", "b2"), ("j", "b3"), ("j", "b4")], "job_name string, batch_id string")
    marks = {r.batch_id: r.attempt for r in L.start_marks(batches, led, F.current_timestamp()).collect()}
    assert marks == {"b1": 2, "b3": 2, "b4": 1}
    assert sorted(r.batch_id for r in L.pending_batches(batches, led).collect()) == ["b1", "b3", "b4"]
    long_err = L.finish_marks(L.start_marks(batches, led, F.current_timestamp()), F.current_timestamp(),
                              error=F.lit("e" * 5000)).first()
    assert long_err.status == "FAILED" and len(long_err.error_message) == 1000


def test_batch_job_end_to_end_and_replay(spark, lines):
    cfg = JobConfig(root=scratch_path(spark, "job"))
    res = process_batch(spark, event_lines(spark, SF_SMALL), "b1", cfg).collect()
    assert {r.sink for r in res} == {"warehouse", "rowstore"} and all(not r.errors for r in res)
    n = read_current(spark, cfg, "warehouse", USERS).count()
    assert process_batch(spark, event_lines(spark, SF_SMALL), "b1", cfg).count() == 0  # already done
    assert read_current(spark, cfg, "warehouse", USERS).count() == n
    # SCD2 + soft delete contracts of the sales schema, with a quarantined line
    batch = lines(
        envelope("c", 1, 1000, 1, table="customers", key_col="customer_id", extra={"tier": "gold"}),
        envelope("u", 1, 2000, 2, table="customers", key_col="customer_id", extra={"tier": "platinum"}),
        envelope("c", 9, 1000, 3, table="products", key_col="product_id", extra={"name": "x", "price": "1.5"}),
        envelope("d", 9, 3000, 4, table="products", key_col="product_id", extra={"name": "x", "price": "1.5"}),
        "not json",
    )
    res = process_batch(spark, batch, "b2", cfg).collect()
    assert all(not r.errors for r in res), res
    tiers = [(r.tier, r.is_current) for r in read_scd2(spark, cfg, "warehouse", REGISTRY["sales.customers"]).orderBy("valid_from").collect()]
    assert tiers == [("gold", False), ("platinum", True)]  # both versions of one batch
    prod = read_current(spark, cfg, "warehouse", REGISTRY["sales.products"]).collect()
    assert len(prod) == 1 and prod[0].deleted_at is not None and prod[0].name == "x"
    assert spark.read.parquet(cfg.quarantine_root).filter("batch_id = 'b2'").count() == 1


def test_jobs_with_the_same_batch_id_keep_their_own_files(spark, lines):
    c = TableContract("sales", "customers", ("customer_id",), ("tier",), ("search",))
    cfg = JobConfig(root=scratch_path(spark, "jobs"), registry={c.fqn: c})
    for job, key in (("first", 1), ("second", 2)):
        good = envelope("c", key, 1000, key, table="customers", key_col="customer_id", extra={"tier": "x"})
        process_batch(spark, lines(good, f"not json {job}"), "b1", replace(cfg, job_name=job))
    got = spark.read.parquet(cfg.quarantine_root).select("job_name", "batch_id", "raw").collect()
    assert sorted(tuple(r) for r in got) == [("first", "b1", "not json first"), ("second", "b1", "not json second")]
    docs = spark.read.option("recursiveFileLookup", "true").text(cfg.table_root("search", c)).collect()
    assert sum('"_id"' in r.value for r in docs) == 2


def _customers(spark, name, **kw):
    c = TableContract("sales", "customers", ("customer_id",), ("tier",), ("warehouse",), scd2=True, column_types={"customer_id": "bigint"}, **kw)
    return c, JobConfig(root=scratch_path(spark, name), registry={c.fqn: c})


def _change(op, key, ts, pos, tier, **extra):
    return envelope(op, key, ts, pos, table="customers", key_col="customer_id", extra={"tier": tier, **extra})


def _history(spark, cfg, c):
    ms = lambda x: None if x is None else x.timestamp() - datetime(1970, 1, 1).timestamp()
    return sorted(((r.customer_id, r.tier, ms(r.valid_from), ms(r.valid_to), r.is_current)
                   for r in read_scd2(spark, cfg, "warehouse", c).collect()), key=str)


def test_late_changes_split_versions_and_replays_change_nothing(spark, lines):
    c, cfg = _customers(spark, "late-job")

    def run(batch_id, *batch):
        (r,) = process_batch(spark, lines(*batch), batch_id, cfg).collect()
        assert not r.errors, r
        return r.upserted, r.deleted

    first = [_change("c", 1, 1000, 1, "gold"), _change("c", 2, 1000, 2, "a"), _change("d", 3, 5000, 3, "z")]
    assert run("b1", *first) == (2, 1)
    assert run("b2", _change("u", 1, 4000, 9, "gold"), _change("u", 2, 1000, 10, "b")) == (2, 0)  # repeats its values; same ms, newer
    assert _history(spark, cfg, c) == [(1, "gold", 1, None, True), (2, "a", 1, 1, False), (2, "b", 1, None, True)]
    assert run("b3", _change("u", 1, 2000, 5, "silver"), _change("c", 3, 2000, 4, "z"), _change("d", 2, 9000, 20, "b")) == (2, 1)
    assert run("b4", *first) == (0, 0)
    assert run("b5", _change("d", 1, 3000, 6, "silver")) == (0, 1)  # a late delete
    want = [(1, "gold", 1, 2, False), (1, "gold", 4, None, True), (1, "silver", 2, 3, False),
            (2, "a", 1, 1, False), (2, "b", 1, 9, False), (3, "z", 2, 5, False)]
    assert _history(spark, cfg, c) == want
    assert read_drift(spark, cfg).count() == 0 and not fs.exists(spark, cfg.quarantine_root + "/x")
    assert sorted((r.customer_id, r.tier) for r in read_current(spark, cfg, "warehouse", c).collect()) == [(1, "gold")]


def test_a_history_gains_a_column_with_its_old_values(spark, lines):
    c, cfg = _customers(spark, "grown-job")
    process_batch(spark, lines(_change("c", 1, 1000, 1, "gold", city="X"), _change("u", 1, 2000, 2, "gold", city="Y")), "b1", cfg, raise_on_error=True)
    assert len(read_scd2(spark, cfg, "warehouse", c).collect()) == 1
    assert [(r.column_name, r.n_events) for r in read_drift(spark, cfg).collect()] == [("city", 2)]
    wider = replace(c, attribute_columns=("tier", "city"))
    cfg = replace(cfg, registry={c.fqn: wider})
    process_batch(spark, lines(_change("c", 2, 3000, 3, "a", city="Z")), "b2", cfg, raise_on_error=True)
    got = read_scd2(spark, cfg, "warehouse", wider).collect()
    assert sorted((r.customer_id, r.tier, r.city, r.is_current) for r in got) == [(1, "gold", "X", False), (1, "gold", "Y", True), (2, "a", "Z", True)]


def test_rules_and_key_changes_in_the_job(spark, lines):
    parent = TableContract("shop", "owners", ("id",), ("name",), ("rowstore",), column_types={"id": "int"})
    child = TableContract("shop", "animals", ("id",), ("owner", "legs"), ("rowstore",), column_types={"id": "int", "owner": "int", "legs": "int"}, rules=(
        ColumnRule("range", "legs", low=0, high=8), ColumnRule("fk", "owner", parent="shop.owners", parent_column="id"), ColumnRule("not_null", "legs")))
    cfg = JobConfig(root=scratch_path(spark, "rules-job"), registry={c.fqn: c for c in (child, parent)})

    def animal(op, key, pos, **extra):
        return envelope(op, key, 1000 + pos, pos, db="shop", table="animals", key_col="id", extra=extra)

    moved = envelope("u", 2, 1010, 10, db="shop", table="animals", key_col="id", before={"id": "01"}, after={"id": "2", "owner": "7", "legs": "6"})
    batch = [animal("c", 1, 1, owner="7", legs="4"), animal("c", 3, 2, owner="8", legs="4"), animal("c", 4, 3, owner="7", legs="9"),
             animal("c", 5, 4, legs="2"), animal("c", 6, 5, owner="7"), animal("d", 9, 6, owner="8", legs="99"), moved,
             envelope("c", 7, 900, 0, db="shop", table="owners", key_col="id", extra={"name": "n"})]
    assert all(not r.errors for r in process_batch(spark, lines(*batch), "b1", cfg).collect())
    bad = spark.read.parquet(cfg.quarantine_root).select("reason", "detail", "part").collect()
    assert sorted(map(tuple, bad)) == [("rule_violation", d, "shop.animals") for d in ("fk:owner", "not_null:legs", "range:legs")]
    rows = read_current(spark, cfg, "rowstore", child).collect()
    assert sorted((r.id, r.owner, r.legs) for r in rows) == [(2, 7, 6), (5, None, 2)]
    state = stored_table(spark, cfg, "rowstore", child).read().collect()
    assert sorted((r.id, r._op) for r in state) == [(1, "d"), (2, "u"), (5, "c"), (9, "d")]


def test_landing_range_scan_prunes_partitions(spark):
    root = scratch_path(spark, "land")
    landing.land_lines(event_lines(spark, SF_SMALL), root, root + "-err")
    df = landing.range_scan(spark, root, "2024-01-10", "2024-01-10", [("app", "users")])
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # plan text is cut at 100 chars otherwise
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters" in plan and "2024-01-10" in plan
    assert df.count() > 0
    touched = landing.touched_partitions(landing.landed_files(spark, root))
    assert touched.filter("dt = '2024-01-10'").count() <= 24
    from_lines = landing.touched_partitions(landing.read_landed(spark, root))
    assert sorted(touched.collect()) == sorted(from_lines.collect())
    assert "content" not in landing.landed_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert landing.landed_files(spark, root + "-never-landed").count() == 0
    assert landing.table_scan(spark, root, "app", "no_such_table").count() == 0
    assert landing.table_scan(spark, root + "-never-landed", "app", "users").count() == 0


def test_run_totals_keep_the_first_three_errors(spark):
    from rowtide.operators.metrics import run_totals
    from rowtide.schemas import WRITE_RESULT

    res = spark.createDataFrame([
        ("search", "a.t", 0, 0, ["s1", "s2"]),
        ("warehouse", "a.t", 5, 1, []),
        ("rowstore", "a.t", 0, 0, ["r1", "r2"]),
        ("rowstore", "a.u", 2, 0, []),
    ], WRITE_RESULT)
    r = run_totals(res).first()
    assert (r.upserted, r.deleted, r.tables, r.any_error) == (7, 1, 2, True)
    assert r.first_errors == ["r1", "r2", "s1"]
    clean = run_totals(res.filter("size(errors) = 0")).first()
    assert clean.any_error is False and clean.first_errors == []


def test_the_stage_counts_what_it_writes_and_leaves_nothing(spark):
    cfg = JobConfig(root=scratch_path(spark, "stage"))
    left = f"{cfg.stage_folder('b1')}/0"  # of an attempt that crashed
    fs.create_text(spark, f"{left}/lines/part-0", "x")
    lines = lambda *text: spark.createDataFrame([(x,) for x in text], "value string")
    good, bad = [_change("c", k, 1000 + k, k, "gold", city="X") for k in range(5)], ["not json", '{"heartbeat": 1}']
    gone = [_change("d", 1, 5000, 9, "gold", city="X")]
    res = process_batch(spark, lines(*good, *bad, *gone), "b1", cfg, raise_on_error=True).collect()
    # the history counts each change, the other sinks the latest one of each key
    assert {(r.upserted, r.deleted) for r in res} <= {(5, 1), (4, 1)} and len(res) == len(REGISTRY[res[0].table_name].sinks)
    assert spark.read.parquet(cfg.quarantine_root).count() == 2
    assert fs.list_names(spark, cfg.stage_folder("b1")) == []
    nothing = process_batch(spark, lines(*bad).where("false"), "b2", cfg, raise_on_error=True)
    assert nothing.count() == 0 and fs.list_names(spark, cfg.stage_folder("b2")) == []
