"""Scalar expressions used by the feeds.

ANSI mode makes a plain cast of bad text fail the whole batch, so every conversion of wire text here is a
``try_`` form: bad text becomes null and the caller can tell it from a missing value by the source column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(text: Column | str, kind: str = "double") -> Column:
    """Numeric text, scientific notation included, as ``kind``; null when it is not a number."""
    return _column(text).try_cast(kind)


def to_float(text: Column | str) -> Column:
    """Numeric text as a 32-bit float (the stored type of a reading)."""
    return to_number(text, "float")


def to_instant(text: Column | str, pattern: str | None = None) -> Column:
    """ISO-8601 text with 0 to 6 fraction digits as a timestamp; null when it is not one."""
    return F.try_to_timestamp(_column(text), F.lit(pattern) if pattern else None)


def partition_date(instant: Column | str) -> Column:
    """Calendar date of an instant in the session time zone (keep the session on UTC)."""
    return F.to_date(_column(instant))


def default_text(text: Column | str, default: str = "unknown", *, empty: bool = False) -> Column:
    """``default`` in place of null and, with ``empty``, in place of ``''`` too."""
    text = _column(text)
    return F.coalesce(F.nullif(text, F.lit("")) if empty else text, F.lit(default))


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
