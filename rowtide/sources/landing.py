"""Landing layout, table and time-range scans, replay plans.

Raw lines land under ``root/db_name=<db>/table_name=<t>/dt=<date>/hour=<h>/``
(``k=v`` directories, so reads prune partitions from the path alone).
Lines that cannot be routed land under ``errors_root`` with a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.time import ms_to_ntz
from rowtide.sinks import fs
from rowtide.sources.changelog import parse_change_lines, split_glued

PARTITION_COLUMNS = ("db_name", "table_name", "dt", "hour")
LANDED_SCHEMA = "value string, db_name string, table_name string, dt date, hour int"


def routing_columns(parsed: DataFrame) -> DataFrame:
    """db, table, event date and hour of parsed lines (NULL when unroutable)."""
    p = F.col("payload")
    t = ms_to_ntz(p["ts_ms"])
    return parsed.select(
        "raw",
        p["source"]["db"].alias("db_name"),
        p["source"]["table"].alias("table_name"),
        F.to_date(t).alias("dt"),
        F.hour(t).alias("hour"),
        F.col("_corrupt_record"),
    )


def land_lines(lines: DataFrame, root: str, errors_root: str, mode: str = "append") -> None:
    """Write raw lines partitioned by db/table/dt/hour; the rest to errors.

    Records glued on one line are split first, so each lands in its own
    table. Lines are parsed once for both writes. Rows are clustered by partition before the write.
    """
    r = routing_columns(parse_change_lines(split_glued(lines))).persist(StorageLevel.MEMORY_AND_DISK)
    routable = (
        F.col("_corrupt_record").isNull() & F.col("db_name").isNotNull() & F.col("table_name").isNotNull()
        & F.col("dt").isNotNull()
    )
    good = r.filter(routable).select(F.col("raw").alias("value"), *PARTITION_COLUMNS)
    bad = r.filter(~routable | routable.isNull()).select(
        F.col("raw").alias("value"),
        F.when(F.col("_corrupt_record").isNotNull(), "malformed_json").otherwise("unroutable").alias("reason"),
    )
    try:
        fs.for_partitioned_write(good, *PARTITION_COLUMNS).write.mode(mode).partitionBy(*PARTITION_COLUMNS).text(root)
        fs.for_partitioned_write(bad, "reason").write.mode(mode).partitionBy("reason").text(errors_root)
    finally:
        r.unpersist()


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """All landed lines with their partition columns (typed, no inference).

    Nothing landed yet (no root directory) is an empty table, not an error.
    """
    if not fs.exists(spark, root):
        return spark.createDataFrame([], LANDED_SCHEMA)
    return spark.read.schema(LANDED_SCHEMA).text(root)


def table_scan(spark: SparkSession, root: str, db: str, table: str) -> DataFrame:
    """One table's lines; the filter prunes directories, not rows."""
    return read_landed(spark, root).filter((F.col("db_name") == db) & (F.col("table_name") == table))


def range_scan(spark: SparkSession, root: str, start: str, end: str,
               tables: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """Lines of the inclusive date range, optionally of some tables."""
    if end < start:
        raise ValueError(f"end date {end} is before start date {start}")
    df = read_landed(spark, root).filter(F.col("dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    if tables:
        cond = None
        for db, t in tables:
            c = (F.col("db_name") == db) & (F.col("table_name") == t)
            cond = c if cond is None else cond | c
        df = df.filter(cond)
    return df


def replay_plan(tables: DataFrame, start: str, end: str) -> DataFrame:
    """S4 plan: one row per (table, date, hour) of the inclusive date range.

    Each table row expands itself with ``explode(sequence(...))``: no join,
    and the output is tables × 24 × days.
    """
    if end < start:
        raise ValueError(f"end date {end} is before start date {start}")
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return (
        tables.select("db_name", "table_name", F.explode(days).alias("dt"))
        .select("db_name", "table_name", "dt", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    )


def path_partitions(file_path: Column, names: Sequence[str] = PARTITION_COLUMNS) -> list[Column]:
    """Values of ``k=v`` path segments, by name."""
    return [F.regexp_extract(file_path, rf"/{n}=([^/]+)", 1).alias(n) for n in names]


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """One row per landed file (``path``, ``length``, ``modificationTime``).

    A ``binaryFile`` listing without its ``content`` column: the files are
    never opened, so finding what a delivery touched costs a listing, not a
    read of the data. Nothing landed yet gives no rows.
    """
    if not fs.exists(spark, root):
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select("path", "length", "modificationTime"))


def touched_partitions(files: DataFrame) -> DataFrame:
    """Distinct partitions of ``files``.

    ``files`` is a listing from :func:`landed_files` (one row per file), or
    any file-based DataFrame, whose ``_metadata.file_path`` is used then.
    """
    fp = F.col("path") if "path" in files.columns else F.col("_metadata.file_path")
    return files.select(*path_partitions(fp)).distinct().select(
        "db_name", "table_name", F.col("dt").cast("date").alias("dt"), F.col("hour").cast("int").alias("hour"))


def retention_plan(partitions: DataFrame, as_of: Column, keep_days: int = 90) -> DataFrame:
    """Partitions (db, table, dt) older than ``keep_days`` before ``as_of``."""
    cutoff = F.date_sub(as_of.cast("date"), keep_days)
    return partitions.filter(F.col("dt") < cutoff).select("db_name", "table_name", "dt").distinct()


def apply_retention(spark: SparkSession, root: str, as_of: Column, keep_days: int = 90) -> int:
    """Delete the landed (db, table, date) folders past their retention.

    Returns how many. The plan has one row per folder to delete; it is walked
    one by one, so the driver holds no list of what stays.
    """
    plan = retention_plan(touched_partitions(landed_files(spark, root)), as_of, keep_days)
    gone = 0
    for r in plan.toLocalIterator():
        gone += fs.delete(spark, f"{root}/db_name={r.db_name}/table_name={r.table_name}/dt={r.dt}")
    return gone
