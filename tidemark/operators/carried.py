"""Port calls over consecutive ranges: events that are open at a border are carried into the next range.

A table of events stands for all positions before a border. It holds, per ship, what later
positions can still change or have to know: events that may go on, calls whose own end or whose wait's end is not certain
yet, the event before each of these, and the last event of each kind, for its number. That
is a few rows a ship, however long the ranges. Calls are given out once they are settled.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import constants as K
from tidemark.functions.time import gap_seconds
from tidemark.operators import ports

KEY = [*ports.SHIP, "anch1_port2"]
EVENT = [*KEY, "group_id", "imo", "port_name", "event_start", "event_end"]
CARRY = (
    "imo_key bigint, mmsi bigint, anch1_port2 int, group_id bigint, imo bigint, port_name string, "
    "event_start timestamp, event_end timestamp, given boolean"
)
CALLS = (
    "imo bigint, mmsi bigint, port_group_id bigint, port_name string, port_start timestamp, port_end timestamp, "
    "anchorage_group_id bigint, anch_start timestamp, anch_end timestamp"
)


def _limit(kind: Column) -> Column:
    return F.when(kind == ports.PORT, F.lit(K.PORT_GAP)).otherwise(F.lit(K.ANCHORAGE_GAP))


def _typed(events: DataFrame) -> DataFrame:
    kinds = dict(pair.rsplit(" ", 1) for pair in CARRY.split(", "))
    return events.select(*[F.col(c).cast(kinds[c]).alias(c) for c in events.columns if c in kinds], *[c for c in events.columns if c not in kinds])


def continued(rows: DataFrame, before: DataFrame, border: date) -> DataFrame:
    """Events of ``rows`` (see :func:`~tidemark.operators.ports.port_calls`), joined to those carried from earlier rows.

    ``border``: the day after the last one of ``rows``. Adds ``closed``: no row from the border on can be part of the event, and ``last``: it is
    the last of its ship and kind. Short stays are still there.
    """
    fresh = _typed(ports.stay_events(rows, min_stay=0).select(*EVENT))
    newest = before.groupBy(*KEY).agg(F.max_by(F.struct(*[c for c in EVENT if c not in KEY]), "group_id").alias("_b"))
    # The first event of a ship and kind may go on with the last one carried; the numbers of the others follow.
    goes_on = (gap_seconds("event_start", "_b.event_end") <= _limit(F.col("anch1_port2"))) & (F.col("port_name") == F.col("_b.port_name"))
    opening = fresh.filter("group_id = 1").join(newest, KEY).select(*KEY, "_b", goes_on.alias("_goes_on"))
    joined = fresh.join(opening, KEY, "left")
    merged = F.coalesce(F.col("_goes_on"), F.lit(False)) & (F.col("group_id") == 1)
    shift = F.coalesce(F.col("_b.group_id") - F.col("_goes_on").cast("int"), F.lit(0))
    new = joined.select(
        *KEY, (F.col("group_id") + shift).alias("group_id"),
        *[F.when(merged, F.col(f"_b.{c}")).otherwise(F.col(c)).alias(c) for c in ("imo", "port_name", "event_start")], "event_end", F.lit(False).alias("given"))
    replaced = opening.filter("_goes_on").select(*KEY, F.col("_b.group_id").alias("group_id"))
    events = before.select(*EVENT, "given").join(replaced, [*KEY, "group_id"], "left_anti").unionByName(_typed(new))
    last = F.col("group_id") == F.max("group_id").over(Window.partitionBy(*KEY))
    past = gap_seconds(F.lit(border).cast("timestamp"), "event_end") > _limit(F.col("anch1_port2"))
    return events.withColumn("last", last).withColumn("closed", ~F.col("last") | past)


def _counts() -> Column:
    return (F.col("anch1_port2") == ports.ANCHORAGE_SPELL) | (gap_seconds("event_end", "event_start") >= K.PORT_MIN_STAY)


def _order():
    return Window.partitionBy(*ports.SHIP).orderBy(*ports.ORDER)


def _calls(events: DataFrame) -> DataFrame:
    """Port stays with the wait ``_b`` before them, as in :func:`~tidemark.operators.ports.port_calls`."""
    linked = (F.col("_b.anch1_port2") == ports.ANCHORAGE_SPELL) & (gap_seconds("event_start", "_b.event_end") <= K.LINK_GAP)
    return events.select(
        "imo", "mmsi", F.col("group_id").alias("port_group_id"), "port_name", F.col("event_start").alias("port_start"), F.col("event_end").alias("port_end"),
        *[F.when(linked, F.col(f"_b.{c}")).alias(n) for c, n in (("group_id", "anchorage_group_id"), ("event_start", "anch_start"), ("event_end", "anch_end"))])


def _in_sequence(events: DataFrame) -> DataFrame:
    """Events that count or may yet, with the one before (``_b``), and whether they are calls that can change no more (``settled``)."""
    sequence = events.filter(_counts() | ~F.col("closed")).withColumn("_b", F.lag(F.struct(*EVENT, "closed")).over(_order()))
    certain = F.col("closed") & F.coalesce(F.col("_b.closed") | (F.col("_b.anch1_port2") == ports.PORT), F.lit(True))
    return sequence.withColumn("settled", (F.col("anch1_port2") == ports.PORT) & _counts() & certain)


def settled_calls(events: DataFrame) -> DataFrame:
    """Calls of :func:`continued` events that are certain now and were not given before."""
    return _calls(_in_sequence(events).filter("settled AND NOT given"))


def carry(events: DataFrame) -> DataFrame:
    """What the next range has to know of :func:`continued` events."""
    sequence = _in_sequence(events).withColumn("given", F.col("given") | F.col("settled"))
    unsettled = (F.col("anch1_port2") == ports.PORT) & ~F.col("given")
    needed = F.col("last") | ~F.col("closed") | unsettled | F.coalesce(F.lead(unsettled).over(_order()), F.lit(True))
    kept = sequence.withColumn("_needed", needed).filter("_needed").select(*EVENT, "given")
    short = events.filter(F.col("last") & F.col("closed") & ~_counts()).select(*EVENT, "given")
    return _typed(kept.unionByName(short))


def open_calls(carried: DataFrame) -> DataFrame:
    """Calls not yet given, as they are if no more rows come."""
    sequence = carried.filter(_counts()).withColumn("_b", F.lag(F.struct(*EVENT)).over(_order()))
    return _calls(sequence.filter((F.col("anch1_port2") == ports.PORT) & ~F.col("given")))
