"""Small file operations through the session's Hadoop FileSystem.

Used only for table metadata (manifests: a few hundred bytes each); data
always moves through Spark readers and writers.
"""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def for_partitioned_write(df: DataFrame, *cols: str) -> DataFrame:
    """Rows of a ``partitionBy(*cols)`` write, clustered by those columns.

    Without it every task writes a file per partition value it holds
    (tasks × values small files). The ``rebalance`` hint adds one shuffle
    whose partitions AQE coalesces when small and splits when skewed, so a
    partition value gets few files and a hot one is still written by
    several tasks.
    """
    return df.hint("rebalance", *cols)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def create_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write a small file; with ``overwrite=False`` an existing file is an error."""
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def create_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if it is there already."""
    try:
        create_text(spark, path, text, overwrite=False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()) or exists(spark, path):
            return False
        raise
    return True


def age_seconds(spark: SparkSession, path: str) -> float:
    fs, p = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))
