"""String row-image values to declared types, without failing the job.

Row images carry strings (``"7"``, ``"1.5"``, ``"True"``, ISO times with or
without offset, sometimes epoch values). ANSI mode is on by default,
so a plain cast would abort the batch on the first bad value: we use
``try_cast`` and report failures as schema conflicts instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowtide.functions.time import ms_to_ntz

_DIGITS = r"^[+-]?\d+$"
_EPOCH_MS = {"s": 1000, "ms": 1}  # milliseconds of a unit; microseconds are divided


def _epoch_ms(value: Column, unit: str) -> Column:
    n = value.try_cast("bigint")
    if unit == "us":
        return F.floor(n / 1000).cast("bigint")
    return F.try_multiply(n, F.lit(_EPOCH_MS[unit]))


def cast_value(value: Column, type_name: str, epoch_unit: str = "ms") -> Column:
    """``try_cast``; for time types a value of digits only is an epoch value in
    the unit that the contract declares, whatever its length."""
    t = type_name.lower()
    if t == "string":
        return value
    if t in ("timestamp", "timestamp_ntz", "timestamp_ltz"):
        # beyond the year 9999 or before 0001 it is no time (MySQL's own range)
        ms = _epoch_ms(F.trim(value), epoch_unit)
        ms = F.when(ms.between(-62135596800000, 253402300799999), ms)
        return F.when(F.trim(value).rlike(_DIGITS), ms_to_ntz(ms) if t == "timestamp_ntz" else F.timestamp_millis(ms)) \
            .otherwise(value.try_cast(t))
    if t == "boolean":
        return F.lower(F.trim(value)).try_cast("boolean")
    return value.try_cast(t)


def cast_failed(value: Column, type_name: str, epoch_unit: str = "ms") -> Column:
    """True when a non-NULL source value does not cast."""
    return value.isNotNull() & cast_value(value, type_name, epoch_unit).isNull()
