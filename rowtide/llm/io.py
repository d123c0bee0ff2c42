"""Shared-folder helpers of the ``llm`` operators.

Everything that outlives a task is written under the session's
``spark.checkpoint.dir``, which the driver and all executors share.
``settle`` is how a job cuts lineage: the frame is written as Parquet (the
committer makes it all-or-nothing) and read back, so a lost executor costs
only the tasks that read it. Raw files (archives, token files, text blocks)
get a unique name per attempt; only the names that the winning attempt
returned are ever read.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name (a URI or path) in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/rowtide-llm/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sampled(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    """At most ``most`` of the written rows, chosen by a hash of ``by``: all if there are no
    more, else those whose hash lies below the share that gives nine tenths of ``most``. The
    limit only holds where copies share a hash."""
    n = rows.count()
    if n <= most:
        return rows
    below = int(2**31 * (0.9 * most / n))
    return rows.where(F.pmod(F.xxhash64(*by), F.lit(2**31)) < below).limit(most)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches small: rows hold whole texts of any length."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000"))
    if now <= 0 or now > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for the jobs run inside; the
    session's own setting is back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, "10000")
    if int(before) <= 0 or int(before) > rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def filesystem(uri: str):
    """(pyarrow file system, path in it) of a URI or a plain path."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    system, path = filesystem(uri)
    system.create_dir(path, recursive=True)
