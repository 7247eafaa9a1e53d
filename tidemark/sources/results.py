"""Result tables: dated writes, ledger writes, additive upsert."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_COLUMNS = ["from_date", "to_date"]


def write_results(df: DataFrame, path: str, from_date: str, to_date: str) -> None:
    """Write one processed range; a re-run replaces that range and nothing else, also if it has no rows."""
    df.drop(*RANGE_COLUMNS).write.mode("overwrite").parquet(f"{path}/from_date={from_date}/to_date={to_date}")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def written_ranges(results: DataFrame) -> DataFrame:
    """Ranges with rows in a table written by :func:`write_results` (see :func:`logged_ranges` for those without)."""
    return results.select(*[F.to_date(c).alias(c) for c in RANGE_COLUMNS]).distinct()


def log_range(spark: SparkSession, log: str, from_date: str, to_date: str) -> None:
    """Note a range as processed, whether it gave rows or not; noting it again changes nothing."""
    one = spark.range(1).select(F.lit(str(from_date)).cast("date").alias("from_date"), F.lit(str(to_date)).cast("date").alias("to_date"))
    one.write.mode("overwrite").parquet(f"{log}/range={from_date}_{to_date}")


def logged_ranges(spark: SparkSession, log: str) -> DataFrame:
    """Ranges noted by :func:`log_range`; none if nothing has been noted."""
    schema = "from_date date, to_date date"
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_ledger(days: DataFrame, path: str) -> None:
    """Add processed days (column ``day``) to the ledger at ``path``."""
    days.select(F.col("day").alias("date_done")).write.mode("append").parquet(path)


EMISSION_KEY = ["year", "month", "emission_type", "StandardVesselType", "h3resolution", "resolution_id"]


def merge_emissions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Add new monthly sums to old ones; null key values are kept as a group."""
    both = old.select(*EMISSION_KEY, "emission_value").unionByName(new.select(*EMISSION_KEY, "emission_value"))
    summed = both.groupBy(*EMISSION_KEY).agg(F.sum("emission_value").alias("emission_value"))
    return summed.orderBy("year", "month")
