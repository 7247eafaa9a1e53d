"""What has been processed, and what is left to do."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.constants import LOOK_BACK_DAYS
from tidemark.operators.lookup import lookup_join


# Fixed value: how stored names give their range.
RANGE_IN_NAME = r"_(\d{4}-\d{2}-\d{2})&(\d{4}-\d{2}-\d{2})\.parquet"


class RangeError(ValueError):
    """No usable date range."""


def file_paths(df: DataFrame) -> DataFrame:
    """Distinct source file names of a DataFrame read from files."""
    return df.select(F.col("_metadata.file_path").alias("path")).distinct()


def processed_ranges(paths: DataFrame, name: str, exclude: str | None = None) -> DataFrame:
    """Distinct (from_date, to_date) found in names like ``<name>_(date)&(date).parquet``."""
    pattern = re.escape(name) + RANGE_IN_NAME
    named = paths.filter(F.col("path").contains(name))
    if exclude:
        named = named.filter(~F.col("path").contains(exclude))
    found = named.select(
        F.regexp_extract("path", pattern, 1).alias("_from"), F.regexp_extract("path", pattern, 2).alias("_to")
    ).filter(F.col("_from") != "")
    return found.select(F.to_date("_from").alias("from_date"), F.to_date("_to").alias("to_date")).distinct()


def next_range(
    ranges: DataFrame,
    today: date,
    start: date | None = None,
    end: date | None = None,
    look_back: int = LOOK_BACK_DAYS,
) -> DataFrame:
    """One row (from_date, to_date, valid): where the next run begins and ends.

    It begins at the later of the last start and ``look_back`` days before the
    last end, or ``look_back`` days before yesterday if nothing was processed.
    """
    yesterday = today - timedelta(days=1)
    last = F.greatest(F.max("from_date"), F.date_sub(F.max("to_date"), look_back))
    first_day = F.lit(start) if start else F.coalesce(last, F.lit(yesterday - timedelta(days=look_back)))
    out = ranges.agg(first_day.alias("from_date"), F.lit(end or yesterday).alias("to_date"))
    return out.withColumn("valid", F.col("from_date") < F.col("to_date"))


def resolve_range(ranges: DataFrame, today: date, start: date | None = None, end: date | None = None) -> tuple[date, date]:
    """:func:`next_range` as two dates; raises :class:`RangeError` if the start is not before the end."""
    row = next_range(ranges, today, start, end).first()
    if not row["valid"]:
        raise RangeError(f"start {row['from_date']} is not before end {row['to_date']}")
    return row["from_date"], row["to_date"]


def days_to_do(ranges: DataFrame, done_days: DataFrame) -> DataFrame:
    """Every day from the first start to the last end that is not in ``done_days.date_done``."""
    extent = ranges.agg(F.min("from_date").alias("_a"), F.max("to_date").alias("_b")).filter("_a IS NOT NULL")
    days = extent.select(F.explode(F.sequence("_a", "_b")).alias("day"))
    done = done_days.select(F.to_date("date_done").alias("day")).distinct()
    return days.join(done, "day", "left_anti").select(F.date_format("day", "yyyy-MM-dd").alias("day"))


def ranges_to_do(wanted: DataFrame, done: DataFrame, first_only: bool = True) -> DataFrame:
    """Ranges in ``wanted`` without a counterpart in ``done``, in date order."""
    left = wanted.join(done.distinct(), ["from_date", "to_date"], "left_anti").orderBy("from_date", "to_date")
    return left.limit(1) if first_only else left


def new_days_only(positions: DataFrame, days: DataFrame, ts: str = "dt_pos_utc") -> DataFrame:
    """Positions on one of the listed days (column ``day``, text).

    The first and the last day become a range on ``ts``, which reaches the scan.
    """
    wanted = days.select(F.to_date("day").alias("_day")).distinct()
    first, last = wanted.agg(F.min("_day"), F.max("_day")).first()
    if first is None:
        return positions.limit(0)
    near = positions.filter((F.col(ts) >= F.lit(first).cast("timestamp")) & (F.col(ts) < F.lit(last + timedelta(days=1)).cast("timestamp")))
    return lookup_join(near.withColumn("_day", F.to_date(ts)), wanted, ["_day"], "left_semi").drop("_day")
