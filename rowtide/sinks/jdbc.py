"""K8: database delivery as staging load + one set-based merge statement.

Spark writes the staged rows in parallel with ``write.jdbc`` (batched
inserts per partition); the database then runs one merge statement. No row
passes through the driver. There is no database in this environment, so
the statement text is what the tests check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from rowtide.contracts import TableContract

JDBC_BATCH_SIZE = 1000  # fixed value: rows per insert batch


def write_staging(df: DataFrame, url: str, staging_table: str, properties: dict | None = None) -> None:
    (df.write.mode("overwrite").option("batchsize", JDBC_BATCH_SIZE)
     .jdbc(url, staging_table, properties=properties or {}))


def upsert_statement(contract: TableContract, target: str, staging: str) -> str:
    """INSERT … ON CONFLICT DO UPDATE; clears ``deleted_at`` on soft-delete
    tables and only applies newer changes (``_ts_ms`` guard)."""
    cols = list(contract.primary_keys) + list(contract.attribute_columns) + ["_ts_ms"]
    sets = [f"{c} = EXCLUDED.{c}" for c in contract.attribute_columns] + ["_ts_ms = EXCLUDED._ts_ms"]
    if contract.soft_delete:
        sets.append("deleted_at = NULL")
    return (
        f"INSERT INTO {target} ({', '.join(cols)}) SELECT {', '.join(cols)} FROM {staging} "
        f"ON CONFLICT ({', '.join(contract.primary_keys)}) DO UPDATE SET {', '.join(sets)} "
        f"WHERE {target}._ts_ms IS NULL OR EXCLUDED._ts_ms > {target}._ts_ms"
    )


def delete_statement(contract: TableContract, target: str, staging: str) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in contract.primary_keys)
    if contract.soft_delete:
        return f"UPDATE {target} t SET deleted_at = s.deleted_at FROM {staging} s WHERE {on}"
    return f"DELETE FROM {target} t USING {staging} s WHERE {on}"
