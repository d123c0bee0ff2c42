"""K2/K3: a table as complete states, each in a directory of its own, and pointers.

Layout::

    root/state-<id>/part-*.parquet     one complete state, as Spark wrote it
    root/_states/<n:012d>.json         the n-th state: its directory and schema

A merge reads the current state, writes the next one with the DataFrame writer
and then creates pointer n+1; creating a pointer that exists is an error, so of
two writers that started from one state the second fails and is replayed.
Readers see the old state or the new one. A state is never changed once it has a
pointer; a writer that fails leaves a directory that nobody names. The
states before the last ``KEPT`` ones are deleted after a commit, so readers have that
many commits to finish. Columns that a merge adds are NULL in older rows
unless the merge fills them.

Creating a pointer must be exclusive: HDFS, local and most cloud file systems do
that; a store without it needs a table format with a catalog instead.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowtide.sinks import fs

KEPT = 3


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)

    def _pointers(self) -> list[str]:
        return [n for n in fs.list_names(self.spark, f"{self.root}/_states") if n.endswith(".json")]

    def _pointer(self, name: str) -> dict:
        return json.loads(fs.read_text(self.spark, f"{self.root}/_states/{name}"))

    def version(self) -> int | None:
        names = self._pointers()
        return int(names[-1].split(".")[0]) if names else None

    def read(self) -> DataFrame:
        names = self._pointers()
        if not names:
            raise FileNotFoundError(f"no state under {self.root}")
        p = self._pointer(names[-1])
        schema = T.StructType.fromJson(p["schema"])
        if p["state"] is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{p['state']}")

    def _commit(self, version: int, state: str | None, schema: T.StructType) -> int:
        body = json.dumps({"state": state, "schema": json.loads(schema.json())})
        fs.create_text(self.spark, f"{self.root}/_states/{version:012d}.json", body, overwrite=False)
        for name in self._pointers()[:-KEPT]:
            old = self._pointer(name)["state"]
            if old is not None:
                fs.delete(self.spark, f"{self.root}/{old}")
            fs.delete(self.spark, f"{self.root}/_states/{name}")
        return version

    def _write(self, rows: DataFrame) -> str:
        state = f"state-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.root}/{state}")
        return state

    def create(self, schema: T.StructType) -> int:
        """An empty first state: a pointer with the schema, no data."""
        return self._commit((self.version() or 0) + 1, None, schema)

    def overwrite(self, rows: DataFrame) -> int:
        """``rows`` as the next state."""
        v = (self.version() or 0) + 1
        return self._commit(v, self._write(rows), rows.schema)

    def merge(self, staged: DataFrame, fn: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """``fn(current, staged)`` as the next state; ``fn`` may add columns."""
        v = self.version()
        if v is None:
            raise FileNotFoundError(f"no state under {self.root}; overwrite() first")
        rows = fn(self.read(), staged)
        return self._commit(v + 1, self._write(rows), rows.schema)
