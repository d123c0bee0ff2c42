"""Key and row hashes, and the total order of change events.

All built-in expressions (codegen'd, JVM-side).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and NULL marker of the key hash; separator of the
# attribute change hash.
KEY_SEPARATOR = "||"
KEY_NULL_MARKER = "∅"
CHANGE_SEPARATOR = "||"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pk_hash(values: Iterable) -> Column:
    """SHA-256 hex of the key values joined by ``||``, NULL as ``∅``.

    Compatible with the classic form, but ambiguous when values contain
    the separator; use :func:`pk_hash_strict` where that matters.
    """
    parts = [F.coalesce(_as_col(v).cast("string"), F.lit(KEY_NULL_MARKER)) for v in values]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def pk_hash_strict(values: Iterable) -> Column:
    """Unambiguous key hash: SHA-256 of the JSON array of key strings."""
    arr = F.array(*[_as_col(v).cast("string") for v in values])
    return F.sha2(F.to_json(arr), 256)


def change_hash(columns: Iterable) -> Column:
    """MD5 of attributes joined by ``||``, NULL as ''.

    Cannot tell NULL from ''; :func:`change_hash_strict` can.
    """
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(CHANGE_SEPARATOR, *parts))


def change_hash_strict(columns: Iterable) -> Column:
    """MD5 of the JSON array of attribute strings (NULL stays null)."""
    return F.md5(F.to_json(F.array(*[_as_col(c).cast("string") for c in columns])))


def binlog_file_seq(file_col: Column | str = "binlog_file") -> Column:
    """Numeric suffix of a binlog file name (``mysql-bin.000042`` → 42)."""
    c = _as_col(file_col)
    return F.regexp_extract(c, r"(\d+)$", 1).try_cast("bigint")


def change_order_columns(prefix: str = "") -> list[Column]:
    """Ascending sort key of change events: event time, binlog file, position."""
    return [
        F.col(f"{prefix}ts_ms"),
        binlog_file_seq(F.col(f"{prefix}binlog_file")),
        F.col(f"{prefix}binlog_pos"),
    ]


def latest_first(extra: Iterable = ()) -> list[Column]:
    """Sort spec for latest-wins: every order column desc, NULLs last."""
    return [c.desc_nulls_last() for c in change_order_columns()] + [
        _as_col(c).desc_nulls_last() for c in extra
    ]
