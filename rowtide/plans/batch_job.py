"""One batch of raw lines → every sink, with ledger and quarantine.

``process_batch`` is what a scheduled job or a stream's ``foreachBatch``
calls. Per batch: claim it, classify lines (bad ones to the quarantine), split updates
that change a key, cast to the contract, check its rules, then apply the changes to
every enabled sink of the table: current-state sinks get the latest change per typed
key, histories all of them, of any age. Values that do not cast and rows that break a
rule go to the quarantine with their line and never reach a target. What the contract
does not name is kept in ``_extra`` and reported, so a column that is added later
has its old values. Sinks fail independently: the batch raises once all had their try, so
the caller replays it, or, without ``raise_on_error``, their errors are kept as rows of the
result. A table whose foreign keys point to one that no sink stored fails too: its rows
are not judged by the parents of before the batch. The ledger rows are written last, so a
crash re-applies the batch, and the ordered merges, the event keys and the per-batch
quarantine folder make that a no-op.

Scale: lines are parsed once and staged by table in the shared folder, so a table reads
its own lines only; its checked changes and the latest ones per key are staged likewise.
The counts are observed by these writes, no job runs for them, and a lost executor costs
its running tasks. Driver-side loops run over tables and sinks (a handful), never over rows.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rowtide.contracts import REGISTRY, SINKS, TableContract, contract_table
from rowtide.functions.time import ms_to_ntz
from rowtide.operators import ledger as L
from rowtide.operators.envelope import EXTRA, flatten_envelope, latest_typed_per_key, split_key_changes, typed_changes
from rowtide.operators.merge import apply_changes, expire_tombstones, extend_columns, promote, visible
from rowtide.operators.quality import VIOLATIONS, classify, with_contract_rules
from rowtide.operators.scd2 import SCD2_COLUMNS, empty_points, scd2_apply, versions
from rowtide.schemas import LEDGER, WRITE_RESULT
from rowtide.sinks import fs
from rowtide.sinks.claims import claim
from rowtide.sinks.ledger_store import append_marks, read_ledger
from rowtide.sinks.log import append_silver, stage_counted
from rowtide.sinks.search import document_version, index_name, search_actions, write_bulk
from rowtide.sinks.versioned import VersionedTable
from rowtide.sources.changelog import parse_change_lines, split_glued

DAY_MS = 86_400_000


@dataclass
class JobConfig:
    root: str
    job_name: str = "apply_changes"
    enabled_sinks: tuple[str, ...] = SINKS
    registry: dict[str, TableContract] = field(default_factory=lambda: dict(REGISTRY))
    parallel_jobs: int = 4
    renames: dict[str, dict[str, str]] = field(default_factory=dict)  # table → column → old name
    keep_unknown: bool = True  # keep columns that a contract does not name, for when it does
    lease_seconds: float = 7200  # so long a run that left no mark keeps its batch
    tombstone_days: int | None = None  # replay horizon: older tombstones leave on merge; None keeps all
    # sinks of the user: name → fn(spark, contract, typed changes, batch id); contracts name them like others
    extra_sinks: dict[str, Callable[[SparkSession, TableContract, DataFrame, str], None]] = field(default_factory=dict)

    def table_root(self, sink: str, c: TableContract) -> str:
        return f"{self.root.rstrip('/')}/{sink}/{c.db_name}.{c.table_name}"

    @property
    def ledger_root(self) -> str:
        return f"{self.root.rstrip('/')}/_ledger"

    @property
    def quarantine_root(self) -> str:
        return f"{self.root.rstrip('/')}/_quarantine"

    @property
    def drift_root(self) -> str:
        return f"{self.root.rstrip('/')}/_drift"

    def claim_folder(self, batch_id: str) -> str:
        return f"{self.root.rstrip('/')}/_claims/{self.batch_folder(batch_id)}"

    def stage_folder(self, batch_id: str) -> str:
        return f"{self.root.rstrip('/')}/_stage/{self.batch_folder(batch_id)}"

    def batch_folder(self, batch_id: str) -> str:
        """What a batch writes of its own is keyed as the ledger is: by job and batch."""
        return f"job_name={quote(self.job_name, safe='')}/batch_id={quote(batch_id, safe='')}"

    @property
    def silver_root(self) -> str:
        return f"{self.root.rstrip('/')}/_silver"


class SinkError(RuntimeError):
    """A sink of the batch failed; the others have been applied."""


def stored_table(spark: SparkSession, cfg: JobConfig, sink: str, c: TableContract) -> VersionedTable:
    return VersionedTable(spark, cfg.table_root(f"{sink}_scd2" if _keeps_history(cfg, sink, c) else sink, c), c.primary_keys)


def _keeps_history(cfg: JobConfig, sink: str, c: TableContract) -> bool:
    return sink == "warehouse" and c.scd2 and sink not in cfg.extra_sinks


def _apply_history(spark, cfg: JobConfig, sink: str, c: TableContract, changes: DataFrame, batch_id: str) -> tuple[int, int]:
    """All changes of the batch into the history. Returns the upserts and deletes that
    are new to it: replayed ones stay with the batch that brought them first."""
    keys, attrs, mark = list(c.primary_keys), list(c.attribute_columns), f"{cfg.job_name}/{batch_id}"
    staged = changes.withColumn("_batch", F.lit(mark))
    t = stored_table(spark, cfg, sink, c)
    if t.version() is None:
        t.create(empty_points(staged).schema)
    new = Observation()

    def fn(points, staged):
        grown = any(a not in points.columns for a in attrs)
        points = extend_columns(promote(points, c), staged)
        lost = [f for f in points.schema.fields if f.name not in staged.columns and f.name not in SCD2_COLUMNS]
        staged = staged.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in lost])
        own, gone = F.col("_batch") == mark, F.col("_op") == "d"
        return scd2_apply(points, staged, keys, attrs, everything=grown).observe(
            new, F.count(F.when(own & ~gone, 1)).alias("up"), F.count(F.when(own & gone, 1)).alias("down"))

    t.merge(staged, fn)
    return new.get["up"], new.get["down"]


def _apply_sink(spark, cfg: JobConfig, sink: str, c: TableContract, typed: DataFrame, batch_id: str, newest_ms: int | None) -> None:
    keys = list(c.primary_keys)
    if sink in cfg.extra_sinks:
        cfg.extra_sinks[sink](spark, c, typed, batch_id)
        return
    if sink not in SINKS:
        raise ValueError(f"{c.fqn} names a sink that nobody provides: {sink}")
    if sink == "search":
        acts = search_actions(typed, c, deleted=F.col("_op") == "d", deleted_at=ms_to_ntz("_ts_ms"), version=document_version())
        write_bulk(acts, f"{cfg.table_root(sink, c)}/{index_name(c)}/{cfg.batch_folder(batch_id)}")
        return
    # warehouse (upsert) and row store: current state with tombstones and
    # the order guard; the row store ignores scd2 and updates column by column
    t = stored_table(spark, cfg, sink, c)
    if t.version() is None:
        empty = typed.where(F.lit(False))
        t.create((empty.withColumn("deleted_at", F.lit(None).cast("timestamp_ntz")) if c.soft_delete else empty).schema)

    def fn(target, staged):
        out = apply_changes(promote(target, c), staged, keys, soft_delete=c.soft_delete, column_wise=sink == "rowstore")
        if cfg.tombstone_days is None or c.soft_delete or newest_ms is None:
            return out
        return expire_tombstones(out, newest_ms - cfg.tombstone_days * DAY_MS)

    t.merge(typed, fn)


def _reason(c: TableContract):
    """Q1/Q3: ``key_conflict`` when a key value does not cast (or is NULL), ``schema_conflict``
    when another value does not, ``rule_violation`` when a rule is broken; NULL when all is well."""
    no_key = F.lit(False)
    for k in c.primary_keys:
        no_key = no_key | F.col(k).isNull()
    return F.when(no_key, "key_conflict").when(F.size("_schema_conflict") > 0, "schema_conflict") \
        .when(F.size(VIOLATIONS) > 0, "rule_violation")


def _parents_first(contracts: list[TableContract]) -> list[TableContract]:
    """Tables after those that their foreign keys point to, so that a row whose parent
    comes in the same batch finds it stored."""
    by_name, done = {c.fqn: c for c in contracts}, {}

    def visit(c: TableContract) -> None:
        if c.fqn not in done:
            done[c.fqn] = c
            for r in c.rules:
                if r.kind == "fk" and r.parent in by_name and r.parent not in done:
                    visit(by_name[r.parent])
            done[c.fqn] = done.pop(c.fqn)  # behind its parents

    for c in sorted(contracts, key=lambda c: c.fqn):
        visit(c)
    return list(done.values())


def _write_quarantine(bad: DataFrame, n_bad: int, cfg: JobConfig, batch_id: str, part: str) -> None:
    """One folder per job, batch and part: a retry replaces what it quarantined before."""
    path = f"{cfg.quarantine_root}/{cfg.batch_folder(batch_id)}/part={quote(part, safe='')}"
    if n_bad:
        fs.for_partitioned_write(bad.select("reason", "detail", "raw"), "reason").write.mode("overwrite").partitionBy("reason").parquet(path)
    else:
        fs.delete(bad.sparkSession, path)


def _report_drift(cast: DataFrame, cfg: JobConfig, batch_id: str, c: TableContract) -> None:
    """Q2: the columns that the contract does not name, with the changes that hold them."""
    names = cast.select(F.explode(F.map_keys(EXTRA)).alias("column_name")).groupBy("column_name").agg(F.count("*").alias("n_events"))
    names.coalesce(1).write.mode("overwrite").parquet(f"{cfg.drift_root}/{cfg.batch_folder(batch_id)}/table={quote(c.fqn, safe='')}")


def process_batch(spark: SparkSession, lines: DataFrame, batch_id: str, cfg: JobConfig,
                  raise_on_error: bool = True) -> DataFrame:
    """Apply one batch of raw JSON lines (column ``value``); returns write results.

    A batch that is done returns none (J12). One that another run holds raises
    ``BatchClaimed`` (L2). One with a failed sink raises ``SinkError``; callers that look at
    the ``errors`` of the results may turn that off.
    """
    batch = spark.createDataFrame([(cfg.job_name, batch_id)], "job_name string, batch_id string")
    marks = L.start_marks(batch, read_ledger(spark, cfg.ledger_root), F.current_timestamp()).collect()  # one row or none
    if not marks:
        return spark.createDataFrame([], WRITE_RESULT)
    mark = marks[0].asDict() | {"attempt": claim(spark, cfg.claim_folder(batch_id), marks[0].attempt, cfg.lease_seconds)}
    started = spark.createDataFrame([tuple(mark[n] for n in LEDGER.names)], LEDGER)

    def finish(rows: int | None, error: str | None) -> None:
        done = L.finish_marks(started, F.current_timestamp(), F.lit(rows), None if error is None else F.lit(error))
        append_marks(started.unionByName(done), cfg.ledger_root)

    try:
        results = _apply_batch(spark, lines, batch_id, cfg, mark["attempt"])
    except Exception as e:
        finish(None, f"{type(e).__name__}: {e}")
        raise
    errors = [e for r in results for e in r[4]]
    finish(sum(r[2] + r[3] for r in results), "; ".join(errors) if errors else None)
    if errors and raise_on_error:
        raise SinkError("; ".join(errors))
    return spark.createDataFrame(results, WRITE_RESULT)


BAD_LINES = "-"  # fixed value: the staged part of lines that no table takes; tables are named db.table
STATE_SINKS = ("warehouse", "rowstore")  # those whose rows foreign keys are looked up in


def _apply_batch(spark: SparkSession, lines: DataFrame, batch_id: str, cfg: JobConfig, attempt: int) -> list[tuple]:
    contracts = contract_table(spark, cfg.registry.values())
    for name in fs.list_names(spark, cfg.stage_folder(batch_id)):  # left by attempts that were overtaken
        if int(name) < attempt:
            fs.delete(spark, f"{cfg.stage_folder(batch_id)}/{name}")
    stage = f"{cfg.stage_folder(batch_id)}/{attempt}"
    try:
        ok, source = F.col("reason").isNull(), F.col("payload.source")
        classified = classify(parse_change_lines(split_glued(lines)), contracts).select("payload", "raw", "reason")
        part = F.when(ok, F.concat(source["db"], F.lit("."), source["table"])).otherwise(BAD_LINES)
        counts = {"bad": F.count("reason"), "parts": F.collect_set("part")}  # as many parts as tables
        n = stage_counted(classified.withColumn("part", part), f"{stage}/lines", counts, "part")
        parts = {unquote(name.removeprefix("part=")): name for name in fs.list_names(spark, f"{stage}/lines") if name.startswith("part=")}
        if set(parts) != set(n["parts"]):  # a run that overtook this one deletes its stage: no empty batch
            raise FileNotFoundError(f"{stage}/lines: written {sorted(n['parts'])}, found {sorted(parts)}")

        def staged_lines(part: str) -> DataFrame:
            if part not in parts:
                return spark.createDataFrame([], classified.schema)
            return spark.read.schema(classified.schema).parquet(f"{stage}/lines/{parts[part]}")

        _write_quarantine(staged_lines(BAD_LINES).withColumn("detail", F.lit(None).cast("string")), n["bad"], cfg, batch_id, "lines")
        present = _parents_first([cfg.registry[name] for name in parts if name != BAD_LINES])

        results = []

        def stored(fqn: str) -> DataFrame | None:
            parent = cfg.registry.get(fqn)
            failed = [sink for sink, table, _, _, errors in results if table == fqn and errors]
            for sink in parent.sinks if parent else ():
                if sink in STATE_SINKS and sink not in failed and stored_table(spark, cfg, sink, parent).version() is not None:
                    return read_current(spark, cfg, sink, parent)
            return None

        def lost(fqn: str) -> bool:
            """Whether the table's changes of this batch reached none of its state sinks."""
            tried = [errors for sink, table, _, _, errors in results if table == fqn and sink in STATE_SINKS]
            return bool(tried) and all(tried)

        # the silver append and the sinks of a table are independent jobs: they run concurrently
        # (one driver thread each) so small jobs share the executors
        with ThreadPoolExecutor(max_workers=max(1, cfg.parallel_jobs)) as pool:
            for c in present:
                flat = flatten_envelope(staged_lines(c.fqn), c.primary_keys, keep=["raw"])
                silver = pool.submit(append_silver, flat.drop("raw"), cfg.silver_root)
                sinks = [sink for sink in c.sinks if sink in cfg.enabled_sinks or sink in cfg.extra_sinks]
                missing = sorted({r.parent for r in c.rules if r.kind == "fk" and lost(r.parent)})
                if missing:  # rows whose parent came in this batch would look like violations
                    results += [(sink, c.fqn, 0, 0, [f"SinkError: {c.fqn} refers to {', '.join(missing)}, not stored"]) for sink in sinks]
                    silver.result()
                    continue
                cast = typed_changes(split_key_changes(flat, c), c, cfg.renames.get(c.fqn), with_conflicts=True, keep=["raw"], with_extra=cfg.keep_unknown)
                cast = with_contract_rules(cast, c, stored).withColumn("reason", _reason(c)) \
                    .withColumn("detail", F.nullif(F.array_join(F.concat("_schema_conflict", VIOLATIONS), ","), F.lit(""))) \
                    .withColumn("raw", F.when(~ok, F.col("raw"))).drop("_schema_conflict", VIOLATIONS)  # only bad rows need their line
                extra = F.col(EXTRA).isNotNull() if cfg.keep_unknown else F.lit(False)
                checked = f"{stage}/checked/{quote(c.fqn, safe='')}"
                n = stage_counted(cast, checked, {"bad": F.count("reason"), "extra": F.count(F.when(extra, 1))})
                cast = spark.read.schema(cast.schema).parquet(checked)
                _write_quarantine(cast.filter(~ok), n["bad"], cfg, batch_id, c.fqn)
                drift = pool.submit(_report_drift, cast, cfg, batch_id, c) if n["extra"] else None
                changes = cast.filter(ok).drop("reason", "detail", "raw")
                typed, latest = latest_typed_per_key(changes, c), f"{stage}/latest/{quote(c.fqn, safe='')}"
                gone = F.col("_op") == "d"
                n = stage_counted(typed, latest, {"up": F.count(F.when(~gone, 1)), "down": F.count(F.when(gone, 1)), "newest": F.max("_ts_ms")})
                typed = spark.read.schema(typed.schema).parquet(latest)
                jobs = [(sink, pool.submit(_apply_history, spark, cfg, sink, c, changes, batch_id) if _keeps_history(cfg, sink, c)
                         else pool.submit(_apply_sink, spark, cfg, sink, c, typed, batch_id, n["newest"]))
                        for sink in sinks]
                for sink, job in jobs:
                    try:
                        results.append((sink, c.fqn, *(job.result() or (n["up"], n["down"])), []))
                    except Exception as e:  # noqa: BLE001 - sinks fail independently
                        results.append((sink, c.fqn, 0, 0, [f"{type(e).__name__}: {e}"]))
                for job in (silver, drift):  # one that failed fails the batch
                    if job is not None:
                        job.result()
        return results
    finally:
        fs.delete(spark, stage)


def read_current(spark: SparkSession, cfg: JobConfig, sink: str, c: TableContract) -> DataFrame:
    """Readers' view of the current rows of a stored table."""
    if _keeps_history(cfg, sink, c):
        return read_scd2(spark, cfg, sink, c).filter("is_current").drop(*SCD2_COLUMNS)
    return visible(stored_table(spark, cfg, sink, c).read(), soft_delete=c.soft_delete)


def read_scd2(spark: SparkSession, cfg: JobConfig, sink: str, c: TableContract) -> DataFrame:
    """Readers' view of a history: its versions."""
    return versions(stored_table(spark, cfg, sink, c).read(), c.primary_keys, c.attribute_columns)


def read_drift(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    """Columns that batches brought and no contract named: job, batch, table, column, changes."""
    schema = "column_name string, n_events long, job_name string, batch_id string, table string"
    if not fs.exists(spark, cfg.drift_root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(cfg.drift_root)
