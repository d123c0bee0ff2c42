"""SCD2 history: close, insert, delete, rebuild from the log, as-of join.

J3, J4, J7, W2 and J11. Validity comes from event time passed in as a
column or literal, never from the wall clock, so a replay gives the same
history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.functions.keys import change_hash, change_hash_strict
from rowtide.functions.time import ms_to_ntz
from rowtide.operators.sequence import HOT_ROWS, SEG, group_columns, hot_groups, segmented_last_seen, segmented_next_seen, segmented_shift, with_segment

SCD2_COLUMNS = ("valid_from", "valid_to", "is_current")
ORDER = ("_ts_ms", "_file_seq", "_pos")


def _hash(cols: Sequence, strict: bool) -> Column:
    return change_hash_strict(cols) if strict else change_hash(cols)


def open_versions(rows: DataFrame, valid_from: Column) -> DataFrame:
    """A snapshot as an SCD2 table: one open version per row."""
    return rows.select(
        "*",
        valid_from.cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def _staged(staged: DataFrame, keys, attrs, effective: Column, strict: bool) -> DataFrame:
    return staged.select(
        *keys,
        *[F.col(a).alias(f"_s_{a}") for a in attrs],
        effective.cast("timestamp_ntz").alias("_eff"),
        _hash(attrs, strict).alias("_h"),
    )


def scd2_close(dim: DataFrame, staged: DataFrame, keys: Sequence[str], attrs: Sequence[str],
               effective: Column, strict: bool = True) -> DataFrame:
    """Current rows after closing those whose attributes changed.

    Returns every current row of ``dim``; changed ones get
    ``valid_to = effective`` and ``is_current = false``.
    """
    keys = list(keys)
    st = _staged(staged, keys, attrs, effective, strict)
    cur = dim.filter(F.col("is_current")).join(st, keys, "left")
    changed = F.col("_h").isNotNull() & (F.col("_h") != _hash(attrs, strict))
    return cur.select(
        *[c for c in dim.columns if c not in ("valid_to", "is_current")],
        F.when(changed, F.col("_eff")).otherwise(F.col("valid_to")).alias("valid_to"),
        (~changed).alias("is_current"),
    ).select(*dim.columns)


def scd2_insert(dim: DataFrame, staged: DataFrame, keys: Sequence[str], attrs: Sequence[str],
                effective: Column, strict: bool = True) -> DataFrame:
    """New open versions for new keys and for keys whose attributes changed."""
    keys = list(keys)
    st = _staged(staged, keys, attrs, effective, strict)
    cur = dim.filter(F.col("is_current")).select(*keys, _hash(attrs, strict).alias("_ch"))
    # current rows whose attributes the batch repeats: at most one per staged key
    unchanged = cur.join(st.select(*keys, "_h"), keys).filter(F.col("_ch") == F.col("_h")).select(*keys)
    return st.join(unchanged, keys, "left_anti").select(
        *keys,
        *[F.col(f"_s_{a}").alias(a) for a in attrs],
        F.col("_eff").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    ).select(*dim.columns)


def scd2_merge(dim: DataFrame, staged: DataFrame, keys: Sequence[str], attrs: Sequence[str],
               effective: Column, deleted: Column | None = None) -> DataFrame:
    """J3 + J4 (+ J7): the full dimension after applying a batch.

    Current rows and batch meet in one full outer join; each key gives its
    current row, closed if its attributes changed (NULL-safe, column by
    column) or ``deleted`` holds, and a new open version if they changed or
    the key is new. Closed versions pass through. For batches in event order;
    ``scd2_apply`` takes them in any order.
    """
    keys = list(keys)
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    batch = staged.select(*keys, F.struct(*[F.col(a).alias(f"a_{a}") for a in attrs],
                                          effective.cast("timestamp_ntz").alias("eff"), gone.alias("gone")).alias("_s"))
    open_ = dim.filter(F.col("is_current")).select(*keys, F.struct(*dim.columns).alias("_d"))
    d, s = F.col("_d"), F.col("_s")
    same = F.lit(True)
    for a in attrs:
        same = same & d[a].eqNullSafe(s[f"a_{a}"])
    none = d.isNull()  # no open version
    ends = s.isNotNull() & ~none & (s["gone"] | ~same)
    begins = s.isNotNull() & ~s["gone"] & (none | ~same)
    types = {f.name: f.dataType for f in dim.schema.fields}

    def version(values: dict) -> Column:
        return F.struct(*[values.get(c, F.lit(None)).cast(types[c]).alias(c) for c in dim.columns])

    old = {c: d[c] for c in dim.columns} | {
        "valid_to": F.when(ends, s["eff"]).otherwise(d["valid_to"]), "is_current": ~ends}
    new = {k: F.col(k) for k in keys} | {a: s[f"a_{a}"] for a in attrs} | {
        "valid_from": s["eff"], "is_current": F.lit(True)}
    made = [F.when(d.isNotNull(), version(old)), F.when(begins, version(new))]
    rows = F.filter(F.array(*made), lambda x: x.isNotNull())
    after = open_.join(batch, keys, "full_outer").select(F.inline(rows))
    return dim.filter(~F.col("is_current")).unionByName(after)


def scd2_delete(dim: DataFrame, deletes: DataFrame, keys: Sequence[str], effective: Column) -> DataFrame:
    """Close the current version of deleted keys, insert nothing."""
    keys = list(keys)
    d = deletes.select(*keys, effective.cast("timestamp_ntz").alias("_eff")).dropDuplicates(keys)
    cur = dim.filter(F.col("is_current")).join(d, keys, "left")
    hit = F.col("_eff").isNotNull()
    closed = cur.select(
        *[c for c in dim.columns if c not in ("valid_to", "is_current")],
        F.when(hit, F.col("_eff")).otherwise(F.col("valid_to")).alias("valid_to"),
        (~hit).alias("is_current"),
    ).select(*dim.columns)
    return dim.filter(~F.col("is_current")).unionByName(closed)


def _opened(marked: DataFrame) -> Column:
    """Whether a change opens or closes a version, from its neighbour's ``_prev_o`` and ``_prev_h``."""
    is_del = F.col("_o") == "d"
    prev_open = F.col("_prev_o").isNotNull() & (F.col("_prev_o") != "d")
    keep = (is_del & prev_open) | (~is_del & (~prev_open | ~F.col("_h").eqNullSafe(F.col("_prev_h"))))
    return F.coalesce(keep, F.lit(False))


def _prepared(changes: DataFrame, tracked: Sequence[str], order: Sequence[Column], ts_ms: str, op: str, strict: bool) -> tuple[DataFrame, list[str]]:
    ordn = [f"_ord{i}" for i in range(len(order))]
    return changes.select("*", F.col(ts_ms).alias("_t"), F.col(op).alias("_o"),
                          *[o.alias(n) for o, n in zip(order, ordn)], _hash(tracked, strict).alias("_h")), ordn


def _marked(changes: DataFrame, keys: Sequence[str], tracked: Sequence[str], order: Sequence[Column],
            ts_ms: str, op: str, strict: bool, segment_seconds: int, clustered: bool = False) -> tuple[DataFrame, list[str]]:
    """Changes with ``_keep``: whether one opens or closes a version. The neighbour lookup runs
    per (key, time segment); ``clustered`` changes have their segment and lie by it already."""
    marked, ordn = _prepared(changes, tracked, order, ts_ms, op, strict)
    marked = marked if clustered else with_segment(marked, ordn[0], segment_seconds)
    marked = segmented_shift(marked, keys, ordn, ["_o", "_h"], "prev", "_prev", clustered=clustered)
    return marked.withColumn("_keep", _opened(marked)), ordn


def _marked_whole(prepared: DataFrame, group: Sequence[str], ordn: Sequence[str]) -> DataFrame:
    """``_marked`` by one window per key, for keys whose rows fit a task."""
    w = Window.partitionBy(*group).orderBy(*ordn)
    marked = prepared.select("*", F.lag("_o").over(w).alias("_prev_o"), F.lag("_h").over(w).alias("_prev_h"))
    return marked.withColumn("_keep", _opened(marked))


def scd2_history(changes: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                 order: Sequence[Column], ts_ms: str = "_ts_ms", op: str = "_op",
                 strict: bool = True, segment_seconds: int = 3600, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Versions from the whole change log (every event, not latest only).

    An event opens a version unless it repeats the previous event's tracked
    values; a delete closes the open version; ``valid_to`` is the time of
    the next kept event. A key of up to ``hot_rows`` changes is read by one window:
    one shuffle on the key and one sort. Those with more are spread over time segments
    (see :mod:`rowtide.operators.sequence`); ``order[0]`` must be the event time in ms for that.
    ``changes`` is read once to count and once to build: stage what is dear to derive.
    """
    keys = list(keys)
    used = list(dict.fromkeys([*keys, *tracked, ts_ms, op]))
    named = [o.alias(f"_in{i}") for i, o in enumerate(order)]
    order = [F.col(f"_in{i}") for i in range(len(order))]
    rows, group = group_columns(changes.select(*used, *named), keys)
    hot = hot_groups(rows, group, hot_rows)
    marked, ordn = _marked(rows.join(hot, group, "left_semi"), keys, tracked, order, ts_ms, op, strict, segment_seconds)
    split = segmented_shift(marked.filter("_keep").drop("_keep"), keys, ordn, ["_t"], "next", "_next", clustered=True)
    plain, _ = _prepared(rows.join(hot, group, "left_anti"), tracked, order, ts_ms, op, strict)
    kept = _marked_whole(plain, group, ordn).filter("_keep")
    whole = kept.select("*", F.lead("_t").over(Window.partitionBy(*group).orderBy(*ordn)).alias("_next_t"))
    columns = [*keys, *tracked, ms_to_ntz("_t").alias("valid_from"), ms_to_ntz("_next_t").alias("valid_to"),
               F.col("_next_t").isNull().alias("is_current")]
    return whole.filter(F.col("_o") != "d").select(*columns).unionByName(split.filter(F.col("_o") != "d").select(*columns))


def empty_points(staged: DataFrame) -> DataFrame:
    """The schema of ``scd2_apply``'s table for staged changes like these."""
    none = F.lit(None).cast("timestamp_ntz")
    return staged.select("*", none.alias("valid_from"), none.alias("valid_to"), F.lit(None).cast("boolean").alias("is_current")).where("false")


INTERVAL = ("valid_from", "valid_to", "is_current")


def scd2_apply(points: DataFrame, staged: DataFrame, keys: Sequence[str], attrs: Sequence[str],
               everything: bool = False, segment_seconds: int = 3600, hot_rows: int = HOT_ROWS) -> DataFrame:
    """A history after a batch of changes that may be of any age.

    The stored table has a row for each change ever applied (a point): keys, attributes,
    ``_op``, the order columns and, where the change opened a version, ``valid_from``,
    ``valid_to`` and ``is_current``. A batch adds its points, those already there count
    once, and the intervals of the keys it touches are laid anew: a late change splits the
    version that covers it, and changes that repeated their predecessor's values are at
    hand when something comes between them. So the history does not depend on how
    the log was cut into batches or in which order they came; it equals ``scd2_history``
    over all of them. ``everything`` lays the intervals of all keys (a tracked column is new).

    Untouched keys keep their intervals. Keys of up to ``hot_rows`` points are laid in one shuffle
    on the key and one sort; those with more are spread over time segments. Of the
    changes in one millisecond at one log position the order is by op and values.
    """
    keys, fresh = list(keys), staged.select(*[c for c in points.columns if c not in INTERVAL])
    old, group = group_columns(points, keys)
    new, _ = group_columns(fresh, keys)
    counted = old.select(*group).unionByName(new.select(*group))
    hot = hot_groups(counted, group, hot_rows)
    whole = _apply_whole(old.join(hot, group, "left_anti"), new.join(hot, group, "left_anti"), keys, group, attrs, everything)
    split = _apply_segmented(old.join(hot, group, "left_semi").drop(*group), new.join(hot, group, "left_semi").drop(*group),
                             keys, attrs, everything, segment_seconds)
    return whole.select(*points.columns).unionByName(split)


def _apply_whole(old: DataFrame, new: DataFrame, keys: Sequence[str], group: Sequence[str], attrs: Sequence[str], everything: bool) -> DataFrame:
    """``scd2_apply`` for keys whose points fit a task: every window reads one sort."""
    both = old.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)), allowMissingColumns=True)
    tie = change_hash_strict(["_op", *attrs])
    rows, ordn = _prepared(both, attrs, [*[F.col(c) for c in ORDER], tie], "_ts_ms", "_op", True)
    same = F.struct(*ORDER, "_op", *attrs)
    # of repeated changes the stored one is first and stays
    w = Window.partitionBy(*group).orderBy(*ordn, "_age")
    rows = rows.select("*", F.coalesce(F.lag(same).over(w).eqNullSafe(same), F.lit(False)).alias("_again"),
                       (F.max("_age").over(Window.partitionBy(*group)) == 1).alias("_touched")).filter(~F.col("_again"))
    marked = _marked_whole(rows, group, ordn).withColumn("_edge_t", F.when(F.col("_keep"), F.struct("_t")))
    follows = F.expr(f"lead(_edge_t) IGNORE NULLS OVER (PARTITION BY {', '.join(group)} ORDER BY {', '.join(ordn)})")
    laid = _with_intervals(marked.select("*", follows.alias("_next")))
    keep = F.lit(everything) | F.col("_touched")
    return laid.withColumns({c: F.when(keep, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in INTERVAL})


def _with_intervals(laid: DataFrame) -> DataFrame:
    opens = F.col("_keep") & (F.col("_o") != "d")
    return laid.withColumns({"_new_valid_from": F.when(opens, ms_to_ntz("_t")), "_new_valid_to": F.when(opens, ms_to_ntz("_next._t")),
                             "_new_is_current": F.when(opens, F.col("_next").isNull())})


def _apply_segmented(points: DataFrame, staged: DataFrame, keys: Sequence[str], attrs: Sequence[str],
                     everything: bool, segment_seconds: int) -> DataFrame:
    """``scd2_apply`` for hot keys: one shuffle, on (key, segment), serves both the removal of
    repeated changes and the intervals."""
    keys, same = list(keys), [*keys, *ORDER, "_op", *attrs]
    touched = staged.select(*keys).distinct()
    old = points.drop(*INTERVAL)
    if not everything:
        rest = points.join(touched, keys, "left_anti")
        old = old.join(touched, keys, "left_semi")
    both = old.withColumn("_age", F.lit(0)).unionByName(staged.withColumn("_age", F.lit(1)))
    others = [c for c in points.columns if c not in same and c not in INTERVAL] or ["_age"]
    both, group = group_columns(with_segment(both, ORDER[0], segment_seconds), keys)
    group = [*group, SEG]
    once = both.repartition(*group).groupBy(*group, *same).agg(F.min_by(F.struct(*others), "_age").alias("_others")) \
        .select(*group, *same, *[F.col(f"_others.{c}").alias(c) for c in others])
    tie = change_hash_strict(["_op", *attrs])
    marked, ordn = _marked(once, keys, attrs, [*[F.col(c) for c in ORDER], tie], "_ts_ms", "_op", True, segment_seconds, clustered=True)
    marked = marked.withColumn("_edge_t", F.when(F.col("_keep"), F.struct("_t")))
    laid = _with_intervals(segmented_next_seen(marked, keys, ordn, "_edge_t", "_next"))
    out = laid.select(*[F.col(f"_new_{c}" if c in INTERVAL else c).alias(c) for c in points.columns])
    return out if everything else out.unionByName(rest)


def versions(points: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Readers' view of a history kept by ``scd2_apply``."""
    return points.filter(F.col("valid_from").isNotNull()).select(*keys, *attrs, "valid_from", "valid_to", "is_current")


def as_of_join(facts: DataFrame, dim: DataFrame, fact_keys: Sequence[str], dim_keys: Sequence[str],
               fact_ts: str, dim_cols: Sequence[str], how: str = "left",
               segment_seconds: int = 86400) -> DataFrame:
    """Each fact sees the dimension version valid at its time.

    Same result as the join on ``key AND valid_from <= t AND (valid_to IS
    NULL OR t < valid_to)`` for a dimension whose versions of a key do not
    overlap (the SCD2 invariant), but without pairing every fact of a key
    with every version of it: facts and versions are unioned, ordered by
    time per key, and each fact takes the last version at or before it
    (versions first on equal time), then checks ``valid_to``. The running
    lookup is segmented by time, so neither a hot fact key nor a key with
    a long history lands in one task. ``how`` is ``left`` or ``inner``.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"as_of_join supports left and inner, not {how}")
    ks = [f"_k{i}" for i in range(len(fact_keys))]
    t_type = facts.schema[fact_ts].dataType
    vf_type = dim.schema["valid_from"].dataType
    t_cast = None if t_type == vf_type else vf_type
    ver = F.struct(F.col("valid_from").cast(vf_type).alias("valid_from"),
                   F.col("valid_to").cast(vf_type).alias("valid_to"), *[F.col(c) for c in dim_cols])
    d = dim.filter(F.col("valid_from").isNotNull()).select(
        *[F.col(dk).alias(k) for dk, k in zip(dim_keys, ks)],
        F.col("valid_from").cast(vf_type).alias("_t"),
        F.lit(0).alias("_side"),
        ver.alias("_d"),
    )
    fstruct = F.struct(*[F.col(c) for c in facts.columns])
    ft = F.col(fact_ts) if t_cast is None else F.col(fact_ts).cast(t_cast)
    f = facts.select(
        *[F.col(fk).alias(k) for fk, k in zip(fact_keys, ks)],
        ft.alias("_t"),
        F.lit(1).alias("_side"),
        F.lit(None).cast(d.schema["_d"].dataType).alias("_d"),
        fstruct.alias("_f"),
    )
    d = d.withColumn("_f", F.lit(None).cast(f.schema["_f"].dataType))
    # group columns made here, raw keys dropped: the lookup then passes on
    # only columns the output uses (its shuffle is shared, see sequence.py)
    u, _ = group_columns(with_segment(f.unionByName(d), "_t", segment_seconds), ks)
    u = u.drop(*ks)
    seen = segmented_last_seen(u, ks, ["_t", "_side"], "_d", "_v").filter(F.col("_side") == 1)
    v = F.col("_v")
    valid = v.isNotNull() & F.col("_t").isNotNull() & (v["valid_to"].isNull() | (F.col("_t") < v["valid_to"]))
    if how == "inner":
        seen = seen.filter(valid)
    return seen.select(
        *[F.col("_f")[c].alias(c) for c in facts.columns],
        *[F.when(valid, v[c]).alias(c) for c in dim_cols],
    )
