"""What failed inside a batch fails the batch: no sink's rows, quarantine or count may pass for a result."""

from datetime import datetime

import pytest

from cdc_helpers import envelope
from rowtide.contracts import ColumnRule, TableContract
from rowtide.plans import batch_job, q_io
from rowtide.plans.batch_job import JobConfig, SinkError, process_batch, read_current
from rowtide.session import scratch_path
from rowtide.sinks import fs
from rowtide.sinks.ledger_store import read_ledger

OWNERS = TableContract("shop", "owners", ("id",), ("name",), ("warehouse", "rowstore"), column_types={"id": "int"})
ANIMALS = TableContract("shop", "animals", ("id",), ("owner",), ("warehouse", "rowstore"), column_types={"id": "int", "owner": "int"},
                        rules=(ColumnRule("fk", "owner", parent="shop.owners", parent_column="id"),))
COLLARS = TableContract("shop", "collars", ("id",), ("animal",), ("rowstore",), column_types={"id": "int", "animal": "int"},
                        rules=(ColumnRule("fk", "animal", parent="shop.animals", parent_column="id"),))


@pytest.fixture
def broken(monkeypatch):
    """Sinks that fail: the returned set holds (sink, table)."""
    down, real = set(), batch_job._apply_sink

    def apply(spark, cfg, sink, c, *rest):
        if (sink, c.table_name) in down:
            if batch_job.stored_table(spark, cfg, sink, c).version() is None:
                real(spark, cfg, sink, c, rest[0].where("false"), *rest[1:])  # the table is there, without rows
            raise OSError(f"{sink} is down")
        return real(spark, cfg, sink, c, *rest)

    monkeypatch.setattr(batch_job, "_apply_sink", apply)
    return down


@pytest.fixture
def shop(spark, lines):
    cfg = JobConfig(root=scratch_path(spark, "failing"), registry={c.fqn: c for c in (COLLARS, ANIMALS, OWNERS)})
    row = lambda table, key, **extra: envelope("c", key, 1000 + key, key, db="shop", table=table, key_col="id", extra=extra)
    return cfg, lines(row("owners", 7, name="n"), row("animals", 1, owner="7"), row("collars", 4, animal="1"), "not json")


def _held(spark, cfg, sink, c):
    return [r.id for r in read_current(spark, cfg, sink, c).collect()]


def _quarantined(spark, cfg):
    return [tuple(r) for r in spark.read.parquet(cfg.quarantine_root).select("part", "reason").collect()]


def _marks(spark, cfg):
    return sorted((r.attempt, r.status) for r in read_ledger(spark, cfg.ledger_root).collect() if r.status != "STARTED")


@pytest.mark.parametrize("sink", ["warehouse", "rowstore"])
def test_the_query_has_no_rows_when_a_sink_failed(spark, broken, tmp_path, sink):
    rows = [(k, datetime(2024, 1, 10 + k), k % 2, "click", 1.5, '{"k": "v"}') for k in range(4)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = sorted((r.sink, r.user_id) for r in q_io.q_batch_job(spark, str(tmp_path)).collect())
    assert got == [("rowstore", 0), ("rowstore", 1), ("warehouse", 0), ("warehouse", 1)]
    broken.add((sink, "users"))
    with pytest.raises(SinkError, match=f"{sink} is down"):
        q_io.q_batch_job(spark, str(tmp_path))


def test_a_failed_sink_raises_once_the_others_had_their_try(spark, broken, shop):
    cfg, batch = shop
    broken.add(("rowstore", "collars"))
    with pytest.raises(SinkError, match="rowstore is down"):
        process_batch(spark, batch, "b1", cfg)
    assert _held(spark, cfg, "warehouse", OWNERS) == [7] and _held(spark, cfg, "rowstore", ANIMALS) == [1]
    errors = {(r.sink, r.table_name): r.errors for r in process_batch(spark, batch, "b1", cfg, raise_on_error=False).collect()}
    assert [k for k, e in errors.items() if e] == [("rowstore", "shop.collars")] and len(errors) == 5
    broken.clear()
    assert process_batch(spark, batch, "b1", cfg).count() == 5 and _held(spark, cfg, "rowstore", COLLARS) == [4]
    assert _marks(spark, cfg) == [(1, "FAILED"), (2, "FAILED"), (3, "SUCCESS")]


def test_rows_are_not_judged_by_parents_that_were_not_stored(spark, broken, shop):
    cfg, batch = shop
    broken.update({("warehouse", "owners"), ("rowstore", "owners")})
    res = process_batch(spark, batch, "b1", cfg, raise_on_error=False).collect()
    assert len(res) == 5 and all(r.errors and not r.upserted for r in res)  # grandchildren too
    assert _quarantined(spark, cfg) == [("lines", "malformed_json")]
    broken.clear()
    assert process_batch(spark, batch, "b1", cfg).count() == 5
    assert [_held(spark, cfg, "rowstore", c) for c in (OWNERS, ANIMALS, COLLARS)] == [[7], [1], [4]]
    assert _quarantined(spark, cfg) == [("lines", "malformed_json")]


def test_parents_are_looked_up_in_a_sink_that_took_them(spark, broken, shop):
    cfg, batch = shop
    broken.add(("warehouse", "owners"))
    with pytest.raises(SinkError, match="warehouse is down"):
        process_batch(spark, batch, "b1", cfg)
    assert _held(spark, cfg, "rowstore", ANIMALS) == [1] and _held(spark, cfg, "rowstore", COLLARS) == [4]
    assert _quarantined(spark, cfg) == [("lines", "malformed_json")]


@pytest.mark.parametrize("gone", ["", "/lines/part=shop.owners", "/lines/part=-"])
def test_a_lost_stage_is_no_empty_batch(spark, shop, monkeypatch, gone):
    cfg, batch = shop
    real = batch_job.stage_counted

    def staged(df, path, *rest):
        counts = real(df, path, *rest)
        if path.endswith("/lines"):  # as a run that overtakes this one does
            fs.delete(spark, path.removesuffix("/lines") + gone)
        return counts

    monkeypatch.setattr(batch_job, "stage_counted", staged)
    with pytest.raises(FileNotFoundError, match="lines"):
        process_batch(spark, batch, "b1", cfg)
    assert _marks(spark, cfg) == [(1, "FAILED")]
    monkeypatch.undo()
    assert process_batch(spark, batch, "b1", cfg).count() == 5
    assert _quarantined(spark, cfg) == [("lines", "malformed_json")]
