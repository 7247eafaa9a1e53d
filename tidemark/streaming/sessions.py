"""Anchorage sessions and emission totals on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions import constants as K
from tidemark.operators.zones import anchoring_off_zone
from tidemark.sources.results import EMISSION_KEY


def anchorage_sessions(
    tagged: DataFrame, watermark: str = "2 hours", gap: int = K.ANCHORAGE_GAP, ts: str = "dt_pos_utc"
) -> DataFrame:
    """Slow spells outside every port, as session windows of a streaming (or batch) input.

    A session window holds a row that comes exactly ``gap`` seconds after the
    previous one, as the batch rule does. Rows later than the watermark are lost. Sessions that are open when an
    input ends are closed by a :func:`closing_row`.
    """
    rows = tagged.filter(anchoring_off_zone())
    if rows.isStreaming:
        rows = rows.withWatermark(ts, watermark)
    sessions = rows.groupBy("imo", "mmsi", F.session_window(ts, f"{gap} seconds")).agg(
        F.min(ts).alias("anch_start"), F.max(ts).alias("anch_end"), F.count(F.lit(1)).alias("n_positions")
    )
    return sessions.drop("session_window")


def closing_row(tagged: DataFrame, watermark: str = "2 hours", gap: int = K.ANCHORAGE_GAP, ts: str = "dt_pos_utc") -> DataFrame:
    """One row that ends a stream's input: read as its last batch, it moves the watermark past every open session.

    It belongs to no ship (identity -1) and its own session stays open, so it never shows in the results.
    """
    late = F.max(ts) + F.expr(f"INTERVAL {watermark}") + F.expr(f"INTERVAL {2 * gap + 1} seconds")
    last = tagged.agg(late.alias(ts)).filter(F.col(ts).isNotNull())
    values = {"imo": F.lit(-1), "mmsi": F.lit(-1), ts: F.col(ts), "sog": F.lit(2.0)}
    return last.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in tagged.schema.fields])


def emission_totals(sums: DataFrame, path: str) -> DataStreamWriter:
    """Writer that keeps each micro-batch's sums under its batch number.

    A repeated batch replaces its own partition, so a restart does not count
    twice; :func:`read_totals` adds the batches up.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
        )

    return sums.writeStream.outputMode("append").foreachBatch(store)


def read_totals(batches: DataFrame) -> DataFrame:
    return batches.groupBy(*EMISSION_KEY).agg(F.sum("emission_value").alias("emission_value"))
