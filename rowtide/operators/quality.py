"""Data quality: rule checks, drift, schema conflicts, quarantine (Q1–Q5).

A rule is a name and a *violation* predicate. All rules of a table are
evaluated in one projection; the violation names land in an array column,
so good/bad split and per-rule counts are one pass each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contracts import ColumnRule, TableContract
from rowtide.functions.casting import cast_failed
from rowtide.schemas import CORRUPT_COLUMN, VALID_OPS

VIOLATIONS = "_violations"


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column  # True when the row breaks the rule


def not_null(column: str) -> Rule:
    return Rule(f"not_null:{column}", F.col(column).isNull())


def in_set(column: str, values: Sequence) -> Rule:
    return Rule(f"enum:{column}", F.col(column).isNotNull() & ~F.col(column).isin(*values))


def in_range(column: str, low=None, high=None) -> Rule:
    c = F.col(column)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return Rule(f"range:{column}", c.isNotNull() & bad)


def with_fk_flag(df: DataFrame, parent: DataFrame, column: str, parent_column: str, flag: str) -> DataFrame:
    """Add boolean ``flag``: the foreign key has a parent row.

    The parent key set is deduplicated; adaptive execution broadcasts it when
    it is small and splits a hot key of ``df`` otherwise.
    """
    keys = parent.select(F.col(parent_column).alias(f"_fk_{flag}")).distinct().withColumn(flag, F.lit(True))
    out = df.join(keys, df[column] == keys[f"_fk_{flag}"], "left")
    return out.drop(f"_fk_{flag}").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def fk_exists(column: str, flag: str) -> Rule:
    return Rule(f"fk:{column}", F.col(column).isNotNull() & ~F.col(flag))


def with_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    arr = F.array(*[F.when(r.violated, F.lit(r.name)) for r in rules])
    return df.withColumn(VIOLATIONS, F.filter(arr, lambda x: x.isNotNull()))


def _fk_flag(rule: ColumnRule) -> str:
    return f"_fk_{rule.column}"


def contract_rules(contract: TableContract) -> list[Rule]:
    """The contract's rules as violation predicates on typed rows (``with_contract_rules``)."""
    made = {"not_null": lambda r: not_null(r.column), "enum": lambda r: in_set(r.column, r.values),
            "range": lambda r: in_range(r.column, r.low, r.high), "fk": lambda r: fk_exists(r.column, _fk_flag(r))}
    return [made[r.kind](r) for r in contract.rules]


def with_contract_rules(rows: DataFrame, contract: TableContract, parents: Callable[[str], DataFrame | None]) -> DataFrame:
    """Q1: typed changes with ``_violations``, the names of the rules that an upsert
    breaks; deletes break none, else a bad row could never leave.

    ``parents(fqn)`` gives a stored parent table (None: nothing is stored, so each
    value breaks its foreign key). The parent's keys meet the rows in one equi-join:
    adaptive execution broadcasts a small parent and splits a hot key.
    """
    if not contract.rules:
        return rows.withColumn(VIOLATIONS, F.array().cast("array<string>"))
    out = rows
    for r in contract.rules:
        if r.kind == "fk":
            parent = parents(r.parent)
            out = out.withColumn(_fk_flag(r), F.lit(False)) if parent is None else with_fk_flag(out, parent, r.column, r.parent_column, _fk_flag(r))
    out = with_violations(out, contract_rules(contract))
    broken = F.when(F.col("_op") != "d", F.col(VIOLATIONS)).otherwise(F.array().cast("array<string>"))
    return out.select(*rows.columns, broken.alias(VIOLATIONS))


def dq_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations) for every rule, zero counts included; one aggregation."""
    aggs = [F.sum(F.when(r.violated, 1).otherwise(0)).cast("bigint").alias(f"_r{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    pairs = [F.struct(F.lit(r.name).alias("rule"), F.col(f"_r{i}").alias("violations")) for i, r in enumerate(rules)]
    return wide.select(F.inline(F.array(*pairs)))


# Q2 -------------------------------------------------------------------------
def new_columns(flat: DataFrame, contract: TableContract) -> DataFrame:
    """Source columns the contract does not know: (db, table, column, events)."""
    known = F.array(*[F.lit(c) for c in contract.columns])
    t = flat.filter((F.col("db_name") == contract.db_name) & (F.col("table_name") == contract.table_name))
    img = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    extra = F.explode(F.array_except(F.map_keys(img), known))
    return (
        t.select("db_name", "table_name", extra.alias("column_name"))
        .groupBy("db_name", "table_name", "column_name")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


# Q3 -------------------------------------------------------------------------
def schema_conflicts(rows: DataFrame, contract: TableContract, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of string columns with ``_schema_conflict``: columns that do not cast."""
    cols = [c for c in (columns or contract.columns) if c in rows.columns]
    arr = F.array(*[F.when(cast_failed(F.col(c), contract.type_of(c), contract.epoch_unit_of(c)), F.lit(c)) for c in cols])
    return rows.withColumn("_schema_conflict", F.filter(arr, lambda x: x.isNotNull()))


# Q4 -------------------------------------------------------------------------
REASONS = ("malformed_json", "missing_payload", "missing_op", "unknown_op", "unknown_table", "missing_key")


def quarantine_reason(contract_known: Column, key_present: Column) -> Column:
    """First failing check of a parsed line (NULL = good)."""
    p = F.col("payload")
    return (
        F.when(F.col(CORRUPT_COLUMN).isNotNull(), "malformed_json")
        .when(p.isNull(), "missing_payload")
        .when(p["op"].isNull(), "missing_op")
        .when(~p["op"].isin(*VALID_OPS), "unknown_op")
        .when(~contract_known, "unknown_table")
        .when(~key_present, "missing_key")
    )


def classify(parsed: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add ``reason`` to parsed lines (``payload`` + ``_corrupt_record``).

    ``contracts`` is the registry table (db_name, table_name,
    primary_keys): bounded by the number of tables, so always broadcast.
    Key presence is checked against the contract's key list with a
    higher-order function, JVM-side.
    """
    p = F.col("payload")
    c = F.broadcast(contracts.select(
        F.col("db_name").alias("_c_db"), F.col("table_name").alias("_c_table"), F.col("primary_keys").alias("_c_pk")))
    joined = parsed.join(c, (p["source"]["db"] == c["_c_db"]) & (p["source"]["table"] == c["_c_table"]), "left")
    image = F.when(p["op"] == "d", p["before"]).otherwise(p["after"])
    key_ok = F.forall(F.col("_c_pk"), lambda k: image[k].isNotNull())
    reason = quarantine_reason(F.col("_c_db").isNotNull(), F.coalesce(key_ok, F.lit(False)))
    return joined.withColumn("reason", reason).drop("_c_db", "_c_table", "_c_pk")
