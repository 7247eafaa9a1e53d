"""Position scans over date-partitioned Parquet."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join


def read_positions(spark: SparkSession, path: str) -> DataFrame | None:
    """Positions at ``path``; None if nothing is there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
        return None
    return spark.read.parquet(path)


def scan_range(
    positions: DataFrame,
    start: str | datetime,
    end: str | datetime,
    cells: DataFrame | None = None,
    cell: str = "H3_int_index_5",
    ts: str = "dt_pos_utc",
    date_column: str | None = None,
) -> DataFrame:
    """Positions in [start, end], optionally only in the listed cells.

    ``date_column`` names the date partition column of the table, if it has
    one; the range is repeated on it so that other partitions are not read.
    """
    lo, hi = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
    rows = positions.filter(F.col(ts).between(lo, hi))
    if date_column:
        rows = rows.filter(F.col(date_column).between(F.to_date(lo), F.to_date(hi)))
    if cells is None:
        return rows
    return lookup_join(rows, cells.select(cell).distinct(), [cell], "left_semi")


def freshness(positions: DataFrame, last_date: str | datetime, ts: str = "dt_pos_utc", bypass: bool = False) -> DataFrame:
    """One row: newest time, and whether there is something new since ``last_date``."""
    newest = F.max(ts)
    fresh = F.lit(True) if bypass else F.coalesce(newest >= F.lit(str(last_date)).cast("timestamp"), F.lit(False))
    return positions.agg(newest.alias("newest"), fresh.alias("fresh"))


def time_extent(positions: DataFrame, ts: str = "dt_pos_utc") -> DataFrame:
    return positions.agg(F.min(ts).alias("from_time"), F.max(ts).alias("to_time"))
