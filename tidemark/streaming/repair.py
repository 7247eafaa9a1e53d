"""Rows that come behind the watermark: kept aside, and the results they touch taken back and made again.

:func:`split_feed` stores each micro-batch once, divided into rows in time and late ones. A row is late if an
earlier batch held one that is more than the delay newer. A stream that reads the rows in time with the same delay therefore
loses none, however its own batches are cut, and the late table holds exactly what it has not seen.

:func:`repair_stays` re-opens the ships of late rows from the last event that no late row can touch: their events are made again
by the batch rule from all rows, and committed. Readers take a re-opened ship from its last repair only. Emissions are
re-opened by day, see :func:`late_days` and :func:`tidemark.plans.runs.reopen_days`.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from tidemark.functions import constants as K
from tidemark.functions.time import gap_seconds
from tidemark.operators import carried, ports, tracks
from tidemark.sources.manifest import Manifest

KEY = carried.KEY
STORED = (
    "imo_key bigint, mmsi bigint, anch1_port2 int, group_id bigint, imo bigint, port_name string, event_start timestamp, event_end timestamp"
)


def _table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def split_feed(feed: DataFrame, path: str, watermark: str = "2 hours", ts: str = "dt_pos_utc") -> DataStreamWriter:
    """Writer that stores the feed below ``path``, in time and late rows apart.

    A batch that is repeated after a break finds its rows stored and leaves them.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = f"{path}/batch={batch_id:09d}"
        newest = _table(spark, f"{path}-newest", "newest timestamp, batch bigint")
        frontier = newest.filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        if _table(spark, f"{path}-done", "batch bigint").filter(F.col("batch") == batch_id).isEmpty():
            late = F.lit(False) if frontier is None else F.coalesce(F.col(ts) <= F.lit(frontier) - F.expr(f"INTERVAL {watermark}"), F.lit(False))
            batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(stored)
            one = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch"))
            one.write.mode("append").parquet(f"{path}-done")
        rows = _table(spark, stored, batch.schema).agg(F.max(ts).alias("newest"), F.lit(batch_id).cast("bigint").alias("batch"))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}-newest/of={batch_id}")

    return feed.writeStream.outputMode("append").foreachBatch(store)


def rows_in_time(spark: SparkSession, path: str, schema: StructType | str, files: int | None = None) -> DataFrame:
    """The rows in time as a stream; ``files``: most files of a batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(f"{path}/batch=*/late=false")


def late_rows(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return _table(spark, f"{path}/batch=*/late=true", schema)


def all_rows(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return _table(spark, f"{path}/batch=*/late=*", schema)


def late_days(late: DataFrame, ts: str = "dt_pos_utc") -> DataFrame:
    """Days of late rows (column ``day``, text)."""
    return late.select(F.date_format(ts, "yyyy-MM-dd").alias("day")).distinct()


def _unit() -> F.Column:
    return F.concat_ws("_", *[F.col(c).cast("string") for c in KEY])


def _untouched(events: DataFrame, since: DataFrame) -> DataFrame:
    """Events of the keys in ``since`` (with the time of their first late row) that end more than a gap before it, as a run from the first on."""
    touched = gap_seconds("since", "event_end") <= carried._limit(F.col("anch1_port2"))
    before = Window.partitionBy(*KEY).orderBy("group_id").rowsBetween(Window.unboundedPreceding, 0)
    return events.join(since, KEY).withColumn("_touched", F.max(touched).over(before)).filter("NOT _touched")


def repair_stays(spark: SparkSession, path: str, schema: StructType | str, events: DataFrame, store: str, ts: str = "dt_pos_utc") -> int:
    """Makes the events of all ships and kinds with late rows again; how many of these there are.

    ``path``: what :func:`split_feed` wrote; ``events``: what the stream gave, with a least stay of 0.
    """
    late = ports.slow_rows(tracks.with_identity(late_rows(spark, path, schema))).filter("mmsi is not null")
    since = late.groupBy("imo_key", F.col("mmsi").cast("bigint").alias("mmsi"), "anch1_port2").agg(F.min(ts).alias("since"))
    manifest = Manifest(spark, store)
    keys = since.select(_unit().alias("unit")).distinct()
    if keys.isEmpty():
        return 0
    run = manifest.plan(keys)
    events = events.select(*carried.EVENT)
    kept = _untouched(events, since)
    newest = kept.groupBy(*KEY).agg(F.max_by(F.struct("event_end", "group_id", "port_name"), "group_id").alias("_k"))
    rows = ports.slow_rows(tracks.with_identity(all_rows(spark, path, schema)))
    open_ = rows.join(since.select(*KEY).join(newest, KEY, "left"), KEY)
    # Of rows of the same moment as the end of the last event left alone, those in a port of a greater name come after it.
    after = F.col("_k").isNull() | (F.col(ts) > F.col("_k.event_end")) | ((F.col(ts) == F.col("_k.event_end")) & (F.col("Name") > F.col("_k.port_name")))
    again = ports.stay_events(open_.filter(after).select(*rows.columns), min_stay=0)
    numbered = again.join(newest, KEY, "left").withColumn("group_id", F.col("group_id") + F.coalesce("_k.group_id", F.lit(0)))
    whole = carried._typed(kept.select(*carried.EVENT)).unionByName(carried._typed(numbered.select(*carried.EVENT)))
    manifest.store_many(run, stays=whole.withColumn("unit", _unit()))
    manifest.commit(run)
    return keys.count()


def repaired_stays(spark: SparkSession, events: DataFrame, store: str, min_stay: int = K.PORT_MIN_STAY) -> DataFrame:
    """The stream's events, those of re-opened ships and kinds from their last repair; short port stays are left out."""
    manifest = Manifest(spark, store)
    untouched = events.withColumn("unit", _unit()).join(manifest.owners().select("unit"), "unit", "left_anti")
    both = untouched.select(*carried.EVENT).unionByName(manifest.read("stays", STORED).select(*carried.EVENT))
    return both.filter((F.col("anch1_port2") == ports.ANCHORAGE_SPELL) | (gap_seconds("event_end", "event_start") >= min_stay))
