"""Epoch-millisecond helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_to_ms(col: Column | str) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ (truncating)."""
    name = col if isinstance(col, str) else None
    c = F.col(name) if name else col
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), c)


def ms_to_ntz(col: Column | str) -> Column:
    """TIMESTAMP_NTZ of epoch milliseconds."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MILLISECOND", c, F.expr(_EPOCH_NTZ))


def hour_bucket(ms_col: Column | str) -> Column:
    return F.date_trunc("hour", ms_to_ntz(ms_col)).cast("timestamp_ntz")


def trunc_ntz(unit: str, col: Column | str) -> Column:
    """``date_trunc`` that keeps TIMESTAMP_NTZ (Spark's returns a session-zone timestamp)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc(unit, c).cast("timestamp_ntz")
