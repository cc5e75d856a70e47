"""Time helpers.  Sessions run in UTC; driver tables store TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_ts(c) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP (identity wall clock under a UTC session)."""
    return _c(c).cast("timestamp")


def as_ntz(c) -> Column:
    return _c(c).cast("timestamp_ntz")


def micros(c) -> Column:
    """Epoch microseconds of a TIMESTAMP or TIMESTAMP_NTZ column."""
    return F.unix_micros(as_ts(c))


def whole_minutes(start, end) -> Column:
    """Whole minutes from ``start`` to ``end`` (truncated toward zero)."""
    d = micros(end) - micros(start)
    return F.when(d >= 0, F.floor(d / F.lit(60_000_000))).otherwise(F.ceil(d / F.lit(60_000_000))).cast("long")
