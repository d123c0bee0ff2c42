"""Named queries over the driver's tables, each with its DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame``. Its oracle is ANSI SQL over
the same tables (registered as views by name). Queries whose semantics SQL
cannot express (streams, written tables) register without an oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco
