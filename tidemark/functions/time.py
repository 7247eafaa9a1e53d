"""Whole-second time arithmetic on timestamp columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(col: Column | str) -> Column:
    """Epoch seconds of a timestamp."""
    return F.unix_timestamp(col)


def gap_seconds(later: Column | str, earlier: Column | str) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def time_slice(ts: Column | str, width: int) -> Column:
    """Number of the ``width``-second slice that holds ``ts``."""
    return F.floor(F.unix_timestamp(ts) / F.lit(float(width))).cast("long")
