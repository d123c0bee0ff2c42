"""Parallelism helpers: spreading a single-split scan, clustered partitioned writes."""

import os

from rowtide.session import scratch_path
from rowtide.sinks.fs import for_partitioned_write
from rowtide.sources.fixtures import spread


def test_spread_only_when_the_input_has_too_few_splits(spark):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == cores
    many = spark.range(0, 1000, numPartitions=cores * 2)
    assert spread(many) is many
    assert sorted(r.id for r in spread(one).collect()) == list(range(1000))


def test_partitioned_write_gives_few_files_per_value(spark):
    df = spark.range(0, 20000, numPartitions=16).selectExpr("id", "id % 5 AS p")
    root = scratch_path(spark, "rebalanced")
    for_partitioned_write(df, "p").write.partitionBy("p").parquet(root)
    for v in range(5):
        files = [f for f in os.listdir(f"{root}/p={v}") if f.endswith(".parquet")]
        assert 1 <= len(files) < 16
    assert spark.read.parquet(root).count() == 20000
