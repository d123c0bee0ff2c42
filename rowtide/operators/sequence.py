"""Per-key sequential windows that survive a hot key.

``lag``/``lead``/"last non-NULL so far" over ``Window.partitionBy(key)``
put every row of a key into one task; a key holding a third of the log
would then be sorted by a single executor. Here the window runs per
``(key, segment)``, where the segment is a monotone bucket of the first
order column (event time), so a hot key spreads over as many tasks as it
has segments. The rows that need a neighbour from another segment (the
first or last of their segment) get it from a summary with one row per
``(key, segment)``: the segment's boundary row, shifted across segments by a
window over the summary. That window's groups have one row per segment of
a key, bounded by time range / segment width, not by the key's rows.

The big side is shuffled once, on ``(key, segment)``, by an explicit
``repartition`` that both the window and the summary read: Spark reuses
that exchange instead of scanning the input twice. The join back to the
summary uses the same keys, so it keeps that partitioning too, and a
second pass over the output (``clustered=True``) needs no new shuffle.

Where most keys have few rows in a segment the summary is nearly as large as the
input, so callers that can read their input twice send only hot keys this way:
:func:`hot_groups` names the keys with more rows than one task should sort
(``HOT_ROWS``), found by a count that ships one number per key and task. All other
keys take the plain window: one shuffle on the key and one sort.

Choose the segment width so that one key's rows in one segment fit a task.
Pass only columns the result uses: the summary carries whole rows, and a
column the window side prunes but the summary reads would split the shared
shuffle in two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEG = "_seg"
# Segment of rows whose time is NULL: sorts before every real segment, as
# NULL sorts first in an ascending window order.
NULL_SEGMENT = -(2 ** 62)
# Rows of a key up to which it is read by one window; keys with more are split by segment.
HOT_ROWS = 250_000


def time_segment(col: Column, dtype: T.DataType, width_seconds: int) -> Column:
    """Monotone, time-zone free bucket number of a time column.

    Numbers are taken as epoch milliseconds. ``timestamp_ntz`` is bucketed
    from its fields (no zone conversion, so no DST jumps), ``timestamp``
    from its instant, ``date`` by days.
    """
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.DecimalType, T.DoubleType, T.FloatType)):
        seg = F.floor(col / F.lit(width_seconds * 1000))
    elif isinstance(dtype, T.TimestampNTZType):
        secs = (F.unix_date(F.to_date(col)).cast("bigint") * 86400 + F.hour(col) * 3600
                + F.minute(col) * 60 + F.second(col))
        seg = F.floor(secs / F.lit(width_seconds))
    elif isinstance(dtype, T.TimestampType):
        seg = F.floor(F.unix_micros(col) / F.lit(width_seconds * 1_000_000))
    elif isinstance(dtype, T.DateType):
        seg = F.floor(F.unix_date(col) / F.lit(max(1, width_seconds // 86400)))
    else:
        raise TypeError(f"cannot segment a column of type {dtype.simpleString()}")
    return F.coalesce(seg.cast("bigint"), F.lit(NULL_SEGMENT).cast("bigint"))


def with_segment(df: DataFrame, time_col: str, width_seconds: int) -> DataFrame:
    dtype = df.schema[time_col].dataType
    return df.withColumn(SEG, time_segment(F.col(time_col), dtype, width_seconds))


def _order(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(o) for o in order])


def _default(dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(0).cast(dtype) if isinstance(dtype, T.NumericType) else F.lit("1970-01-01").cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.lit("").cast("binary")
    raise TypeError(f"unsupported key type {dtype.simpleString()}")


def group_columns(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Non-nullable stand-ins for the keys: ``coalesce(k, default)`` and ``isnull(k)``.

    Grouping and joining on them is NULL-safe (a NULL key is a group of its
    own, split by segment like any other), and as they are never NULL the
    optimizer infers no ``isnotnull`` filter for the join back. Such a
    filter would differ between the window and the summary branch and stop
    Spark from reusing their common shuffle.
    """
    names = []
    for i, k in enumerate(keys):
        names += [f"_g{i}", f"_gn{i}"]
    if all(n in df.columns for n in names):
        return df, names
    cols = []
    for i, k in enumerate(keys):
        c = F.col(k)
        cols += [F.coalesce(c, _default(df.schema[k].dataType)).alias(f"_g{i}"), c.isNull().alias(f"_gn{i}")]
    return df.select("*", *cols), names


def hot_groups(df: DataFrame, group: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """The groups with more than ``rows`` rows, to broadcast: at most one per ``rows`` rows of input.

    Adaptive execution has them before it starts what joins them, and drops a
    branch that none of them reaches.
    """
    found = df.groupBy(*group).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows)
    return F.broadcast(found.select(*group))


def cluster(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """The one shuffle: rows of a (key, segment) together."""
    return df.repartition(*group, SEG)


def segmented_shift(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                    direction: str, prefix: str, clustered: bool = False) -> DataFrame:
    """``lag`` (``direction='prev'``) or ``lead`` (``'next'``) of ``cols`` per key.

    ``df`` must carry the segment column ``_seg`` (see :func:`with_segment`)
    derived from ``order[0]``; ``order`` columns sort ascending, NULLs first.
    Adds ``<prefix><c>`` for each ``c`` and keeps the group columns
    ``_g*`` (see :func:`group_columns`) so that a later call can pass
    ``clustered=True``: ``df`` is then the output of an earlier call, still
    hash-partitioned by (group, ``_seg``), and no shuffle is added.
    """
    df, keys = group_columns(df, keys)
    df = df if clustered else cluster(df, keys)
    prev = direction == "prev"
    w = Window.partitionBy(*keys, SEG).orderBy(*[F.col(o) for o in order])
    shift = F.lag if prev else F.lead
    edge = "_edge"
    inner = df.select(
        "*",
        *[shift(F.col(c)).over(w).alias(f"{prefix}{c}") for c in cols],
        shift(F.lit(True)).over(w).isNull().alias(edge),
    )
    # the whole boundary row: the summary then reads the same columns as the
    # window, so the optimizer prunes both branches alike and the shuffle
    # under them stays one shared (reused) exchange
    vals = F.struct(*[F.col(c) for c in df.columns])
    pick = F.max_by if prev else F.min_by
    boundary = df.groupBy(*keys, SEG).agg(pick(vals, _order(order)).alias("_b"))
    ws = Window.partitionBy(*keys).orderBy(SEG)
    carry = boundary.select(*keys, SEG, shift(F.col("_b")).over(ws).alias("_carry"))
    joined = inner.join(carry, [*keys, SEG], "left")
    out = [c for c in inner.columns if c != edge and not (c.startswith(prefix) and c[len(prefix):] in cols)]
    return joined.select(
        *out,
        *[F.when(F.col(edge), F.col("_carry")[c]).otherwise(F.col(f"{prefix}{c}")).alias(f"{prefix}{c}")
          for c in cols],
    )


def segmented_last_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                        out: str) -> DataFrame:
    """``out`` = last non-NULL ``value`` at or before each row, per key.

    The running ``last(value, ignorenulls)`` of a key; within a segment a
    window, across segments a running ``last`` over the per-segment summary.
    """
    df, keys = group_columns(df, keys)
    df = cluster(df, keys)
    o = [F.col(c) for c in order]
    w = Window.partitionBy(*keys, SEG).orderBy(*o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = df.withColumn("_in", F.last(F.col(value), ignorenulls=True).over(w))
    row = F.struct(*[F.col(c) for c in df.columns])  # whole row: see segmented_shift
    summary = df.groupBy(*keys, SEG).agg(
        F.max_by(row, F.when(F.col(value).isNotNull(), _order(order))).alias("_b"))
    ws = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, SEG, F.last(F.col("_b")[value], ignorenulls=True).over(ws).alias("_carry"))
    joined = inner.join(carry, [*keys, SEG], "left")
    return joined.select(*[c for c in df.columns], F.coalesce(F.col("_in"), F.col("_carry")).alias(out))


def segmented_next_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """``out`` = first non-NULL ``value`` behind each row, per key.

    ``df`` has its segment and lies by it (an earlier call's output). The window runs
    down the order, so that its frame grows row by row instead of being read anew for each.
    """
    df, keys = group_columns(df, keys)
    w = Window.partitionBy(*keys, SEG).orderBy(*[F.col(c).desc_nulls_last() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("_in", F.last(F.col(value), ignorenulls=True).over(w))
    row = F.struct(*[F.col(c) for c in df.columns])  # whole row: see segmented_shift
    summary = df.groupBy(*keys, SEG).agg(F.min_by(row, F.when(F.col(value).isNotNull(), _order(order))).alias("_b"))
    ws = Window.partitionBy(*keys).orderBy(F.col(SEG).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*keys, SEG, F.last(F.col("_b")[value], ignorenulls=True).over(ws).alias("_carry"))
    joined = inner.join(carry, [*keys, SEG], "left")
    return joined.select(*df.columns, F.coalesce(F.col("_in"), F.col("_carry")).alias(out))
