"""Set-based merges of a staged batch into a target table.

Every merge returns the new table state as a DataFrame; persisting it is
the sink's job. Keys are the contract's primary-key columns and are not
NULL (rows with NULL keys are quarantined upstream), so plain equi-joins
on the key columns are exact.

Scale: every merge is one equi-join on the key that reads the target once;
adaptive execution broadcasts the batch when it turns out small. Building a
merge runs no Spark job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.contracts import TableContract
from rowtide.functions.casting import cast_value
from rowtide.functions.time import ms_to_ntz
from rowtide.operators.envelope import EXTRA

ORDER_COLUMNS = ("_ts_ms", "_file_seq", "_pos")
HIT = "_hit"


def _project_like(df: DataFrame, target_cols: Sequence[str], fill: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with exactly ``target_cols``; missing columns filled or NULL."""
    fill = fill or {}
    cols = []
    for c in target_cols:
        if c in fill:
            cols.append(fill[c].alias(c))
        elif c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).alias(c))
    return df.select(*cols)


def _typed_like(df: DataFrame, target: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in target.schema.fields}
    return df.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns])


def extend_columns(target: DataFrame, staged: DataFrame) -> DataFrame:
    """Q2: the target with the batch's new columns, NULL in its rows."""
    new = [f for f in staged.schema.fields if f.name not in target.columns]
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new])


def promote(target: DataFrame, contract: TableContract) -> DataFrame:
    """Q2: a stored table with the columns that its contract gained. Their values in
    older rows come from ``_extra``, where the job keeps what the contract did not name;
    a value that does not cast stays there."""
    new = [c for c in contract.columns if c not in target.columns]
    if not new or EXTRA not in target.columns:
        return target
    extra = F.col(EXTRA)
    values = {c: cast_value(extra[c], contract.type_of(c), contract.epoch_unit_of(c)) for c in new}
    taken = F.filter(F.array(*[F.when(v.isNotNull(), F.lit(c)) for c, v in values.items()]), lambda c: c.isNotNull())
    rest = F.map_filter(extra, lambda k, _: ~F.array_contains(taken, k))
    kept = [c for c in target.columns if c != EXTRA]
    return target.select(*kept, *[v.alias(c) for c, v in values.items()], F.when(F.size(rest) > 0, rest).alias(EXTRA))


def expire_tombstones(state: DataFrame, before_ms: int) -> DataFrame:
    """The state without tombstones of deletes before ``before_ms``. A change older
    than the replay horizon can't come any more, so nothing has to outlast it."""
    return state.filter((F.col("_op") != "d") | (F.col("_ts_ms") >= before_ms) | F.col("_ts_ms").isNull())


# J1 -------------------------------------------------------------------------
def merge_replace(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete target rows whose key is staged, insert all staged rows."""
    kept = target.join(staged.select(*keys), list(keys), "left_anti")
    return kept.unionByName(_typed_like(_project_like(staged, target.columns), target))


# J2 -------------------------------------------------------------------------
def merge_update(target: DataFrame, staged: DataFrame, keys: Sequence[str],
                 update_columns: Sequence[str] | None = None,
                 set_null: Sequence[str] = ()) -> DataFrame:
    """Insert new keys; on key match update only ``update_columns``.

    Other target columns keep their values; ``set_null`` columns (e.g.
    ``deleted_at`` of a soft-delete table) are cleared on every upsert.
    """
    keys = list(keys)
    upd = [c for c in (update_columns or [c for c in staged.columns if c not in keys])]
    other = [c for c in staged.columns if c not in keys and c not in upd and c in target.columns]
    s = staged.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in upd + other], F.lit(True).alias(HIT))
    joined = target.withColumn("_old", F.lit(True)).join(s, keys, "full_outer")
    hit, new = F.col(HIT).isNotNull(), F.col("_old").isNull()
    out = []
    for c in target.columns:
        if c in upd:
            out.append(F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        elif c in set_null:
            out.append(F.when(hit, F.lit(None)).otherwise(F.col(c)).alias(c))
        elif c in other:
            out.append(F.when(new, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return _typed_like(joined.select(*out), target)


# J5 -------------------------------------------------------------------------
def delete_physical(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(deletes.select(*keys), list(keys), "left_anti")


# J6 -------------------------------------------------------------------------
def delete_soft(target: DataFrame, deletes: DataFrame, keys: Sequence[str],
                deleted_at: Column, column: str = "deleted_at") -> DataFrame:
    """Set ``deleted_at`` on key match; ``deleted_at`` is evaluated on ``deletes``."""
    keys = list(keys)
    d = deletes.select(*keys, deleted_at.alias("_del_at")).dropDuplicates(keys)
    joined = target.join(d, keys, "left")
    base = F.col(column) if column in target.columns else F.lit(None)
    cols = [c for c in target.columns if c != column]
    return joined.select(*cols, F.coalesce(F.col("_del_at"), base).cast("timestamp_ntz").alias(column))


def not_deleted(df: DataFrame, column: str = "deleted_at") -> DataFrame:
    """The view readers use on a soft-delete table."""
    return df.filter(F.col(column).isNull())


# J9 -------------------------------------------------------------------------
def _order(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in ORDER_COLUMNS])


# J8 -------------------------------------------------------------------------
def apply_changes(state: DataFrame, changes: DataFrame, keys: Sequence[str],
                  soft_delete: bool = False, ordered: bool = True,
                  column_wise: bool = False) -> DataFrame:
    """Apply typed latest-per-key changes (``_op`` + order columns) to a state.

    The state keeps one row per key including tombstones (``_op = 'd'``)
    so that the order key of a deleted row is remembered and a late older
    update cannot revive it. Physical delete: a tombstone has NULL
    attributes. Soft delete: the row keeps the attributes of the delete's
    ``before`` image (falling back to the state's when the image lacks
    them) and gets ``deleted_at`` = event time; an upsert clears it.

    ``column_wise`` updates only the columns of ``changes`` (J2), so columns
    that others keep in the state survive. Columns that the state lacks are
    added. One full outer join on the key: the state is read once.
    """
    keys = list(keys)
    state = extend_columns(state, changes)
    rest = [c for c in state.columns if c not in keys]
    types = {f.name: f.dataType for f in state.schema.fields}
    own = state.select(*keys, F.struct(*rest).alias("_s"))
    new = changes.select(*keys, F.struct(*[c for c in changes.columns if c not in keys]).alias("_c"))
    joined = own.join(new, keys, "full_outer")
    s, c = F.col("_s"), F.col("_c")

    def order(row: Column) -> Column:
        return F.struct(*[row[o] for o in ORDER_COLUMNS])

    accept = c.isNotNull()
    if ordered:
        accept = accept & (s.isNull() | (order(c) > order(s)))
    deleted = c["_op"] == "d"
    out = []
    for name in rest:
        if name == "deleted_at":
            value = F.when(deleted, ms_to_ntz(c["_ts_ms"])) if soft_delete else F.lit(None)
        elif name not in changes.columns:
            value = s[name] if column_wise else F.lit(None)
        elif name == EXTRA:
            value = F.when(~deleted, c[name])
        elif name == "_op" or name in ORDER_COLUMNS:
            value = c[name]
        elif soft_delete:
            value = F.when(deleted, F.coalesce(c[name].cast(types[name]), s[name])).otherwise(c[name])
        else:
            value = F.when(~deleted, c[name])
        out.append(F.when(accept, value.cast(types[name])).otherwise(s[name]).alias(name))
    return joined.select(*keys, *out).select(*state.columns)


def visible(state: DataFrame, soft_delete: bool = False) -> DataFrame:
    """Readers' view of an applied state: no tombstones, no change metadata."""
    if soft_delete:
        return state.drop("_op", EXTRA, *ORDER_COLUMNS)
    return state.filter(F.col("_op") != "d").drop("_op", EXTRA, *ORDER_COLUMNS)
