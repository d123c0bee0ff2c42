"""Pipeline metrics as DataFrames.

Each metric is an aggregation (partial aggregation before the shuffle) and,
for alarms, a window over the already-aggregated per-period series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.functions.time import ms_to_ntz


def rows_by_sink(latest: DataFrame, contracts: DataFrame, enabled: Sequence[str] | None = None) -> DataFrame:
    """A2 (+P12/P13): upserts/deletes per (table, sink), unpivoted to metrics.

    The registry table is bounded by the number of tables: broadcast.
    """
    sinks = contracts.select("db_name", "table_name", F.explode("sinks").alias("sink"))
    if enabled is not None:
        sinks = sinks.filter(F.col("sink").isin(*enabled))
    per_table = latest.groupBy("db_name", "table_name").agg(
        F.sum(F.when(F.col("op").isin("c", "u", "r"), 1).otherwise(0)).cast("bigint").alias("upserted"),
        F.sum(F.when(F.col("op") == "d", 1).otherwise(0)).cast("bigint").alias("deleted"),
    )
    wide = per_table.join(F.broadcast(sinks), ["db_name", "table_name"])
    return wide.select(
        "db_name", "table_name", "sink",
        F.expr("stack(2, 'rows_upserted', upserted, 'rows_deleted', deleted) AS (metric, value)"),
    )


def fan_out(flat: DataFrame, contracts: DataFrame, enabled: Sequence[str] | None = None) -> DataFrame:
    """One row per (change, sink) for the sinks its table feeds."""
    sinks = contracts.select("db_name", "table_name", F.explode("sinks").alias("sink"))
    if enabled is not None:
        sinks = sinks.filter(F.col("sink").isin(*enabled))
    return flat.join(F.broadcast(sinks), ["db_name", "table_name"])


# Fixed value: number of error messages a run report keeps.
ERRORS_KEPT = 3


def run_totals(results: DataFrame) -> DataFrame:
    """A3 over write results (sink, table_name, upserted, deleted, errors).

    ``first_errors``: the first ``ERRORS_KEPT`` messages in (sink, table)
    order. The results have one row per (table, sink), so collecting them
    into the one summary row is bounded by the registry, not by data.
    """
    per = F.array_sort(F.collect_list(F.struct("sink", "table_name", "errors")))
    return results.agg(
        F.sum("upserted").cast("bigint").alias("upserted"),
        F.sum("deleted").cast("bigint").alias("deleted"),
        F.count_distinct("table_name").alias("tables"),
        F.coalesce(F.bool_or(F.size("errors") > 0), F.lit(False)).alias("any_error"),
        F.slice(F.flatten(F.transform(per, lambda r: F.coalesce(r["errors"], F.array().cast("array<string>")))),
                1, ERRORS_KEPT).alias("first_errors"),
    )


def lag_ms(flat: DataFrame) -> Column:
    return F.col("ts_ms") - F.col("source_ts_ms")


def windowed_counts(flat: DataFrame, every: str = "5 minutes", by: Sequence[str] = ("op",)) -> DataFrame:
    """A5: tumbling-window counts and lag sums on event time."""
    t = ms_to_ntz("ts_ms")
    return (
        flat.groupBy(F.window(t, every).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(lag_ms(flat)).alias("lag_ms_sum"))
        .select(F.col("w.start").alias("window_start"), *by, "n_events", "lag_ms_sum")
    )


def lag_percentiles(flat: DataFrame, by: Sequence = ("db_name", "table_name"),
                    quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Exact lag percentiles (interpolated) per group.

    ``percentile`` keeps a value→count map per group, so its memory is
    bounded by the number of distinct lag values, not rows; partial
    aggregation merges those maps before the shuffle.
    """
    lag = lag_ms(flat)
    aggs = [F.percentile(lag, q).alias(f"p{int(round(q * 100))}_lag_ms") for q in quantiles]
    return flat.groupBy(*by).agg(*aggs, F.max(lag).alias("max_lag_ms"), F.count(F.lit(1)).alias("n_events"))


def quarantine_rate(classified: DataFrame, period: Column) -> DataFrame:
    """Quarantined / all lines per period."""
    return classified.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("reason").isNotNull(), 1).otherwise(0)).cast("bigint").alias("n_quarantined"),
    ).withColumn("quarantine_rate", F.col("n_quarantined") / F.col("n_lines"))


def breach_streaks(series: DataFrame, by: Sequence[str], order: str, value: str, threshold,
                   length: int = 3) -> DataFrame:
    """``alarm`` when ``value > threshold`` for ``length`` consecutive periods.

    Runs over an already-aggregated series (one row per period and group),
    partitioned by group.
    """
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-(length - 1), 0)
    breach = (F.col(value) > threshold).cast("int")
    return series.withColumn("breach", breach == 1).withColumn(
        "alarm", F.sum(breach).over(w) == length
    )


def rolling(series: DataFrame, by: Sequence[str], period: str, step_minutes: int, steps: int, part: str, whole: str) -> DataFrame:
    """A7, A8 over a moving span: at each period the sums of ``part`` and ``whole`` over the last
    ``steps`` periods of ``step_minutes``, by time (an absent period counts nothing),
    and their ratio ``rate``. The input is an already-aggregated series."""
    at = F.timestamp_diff("MINUTE", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(period))
    w = Window.partitionBy(*by).orderBy(at).rangeBetween(-(steps - 1) * step_minutes, 0)
    summed = series.withColumns({f"{c}_sum": F.sum(c).over(w).cast("bigint") for c in (part, whole)})
    return summed.withColumn("rate", F.col(f"{part}_sum") / F.col(f"{whole}_sum"))


# Fixed value: 2^12 values a level, a rank error of about 0.1 %
SKETCH_K = 4096


def lag_sketches(flat: DataFrame, every: str = "5 minutes", by: Sequence[str] = ("db_name", "table_name")) -> DataFrame:
    """A6, mergeable: one bounded quantile sketch (KLL) of the lag per group and window."""
    t = ms_to_ntz("ts_ms")
    return flat.groupBy(F.window(t, every).alias("w"), *by).agg(
        F.kll_sketch_agg_bigint(lag_ms(flat), SKETCH_K).alias("sketch"), F.count("*").alias("n_events")
    ).select(F.col("w.start").alias("window_start"), *by, "n_events", "sketch")


def merged_sketches(sketches: DataFrame, period: Column, by: Sequence[str] = ("db_name", "table_name"),
                    quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Sketches of short windows merged into longer periods, with their quantiles;
    the events are not read again."""
    merged = sketches.groupBy(period.alias("period"), *by).agg(
        F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"), F.sum("n_events").alias("n_events"))
    return merged.select("period", *by, "n_events", "sketch", *[
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(f"p{int(round(q * 100))}_lag_ms") for q in quantiles])
