"""L1–L4: the stored ledger, Parquet partitioned by the day an attempt started."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.ledger import TTL_DAYS
from rowtide.schemas import LEDGER
from rowtide.sinks import fs


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    if not fs.exists(spark, root):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(root).select(*LEDGER.names)


def append_marks(marks: DataFrame, root: str) -> None:
    marks.withColumn("day", F.to_date("started_at")).coalesce(1).write.mode("append").partitionBy("day").parquet(root)


def expire_stored(spark: SparkSession, root: str, as_of: datetime, ttl_days: int = TTL_DAYS) -> int:
    """L4: remove marks that started more than ``ttl_days`` before ``as_of``.

    Whole days before the cutoff are deleted; the day of the cutoff is written anew
    without its expired marks, by dynamic partition overwrite, which leaves the other
    days alone. Returns how many days changed: a second run changes none.
    """
    cutoff = as_of - timedelta(days=ttl_days)
    edge, changed = cutoff.date().isoformat(), 0
    for name in fs.list_names(spark, root):
        day = name.removeprefix("day=")
        if day == name or day > edge:
            continue
        path = f"{root}/{name}"
        if day == edge:
            rows = spark.read.schema(LEDGER).parquet(path)
            keep = F.col("started_at") >= F.lit(cutoff).cast("timestamp_ntz")
            if not rows.filter(~keep).take(1):
                continue
            if rows.filter(keep).take(1):
                rows.filter(keep).withColumn("day", F.lit(edge).cast("date")).write.mode("overwrite") \
                    .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(root)
                changed += 1
                continue
        changed += fs.delete(spark, path)
    return changed
