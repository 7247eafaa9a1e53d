"""Port calls, anchorage waits, and port-stop visits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import constants as K
from tidemark.functions.time import gap_seconds
from tidemark.operators import tracks
from tidemark.operators.lookup import lookup_join
from tidemark.operators.zones import anchoring_off_zone, in_port
from tidemark.sources.durable import checkpoint

TS = "dt_pos_utc"
SHIP = ("imo_key", "mmsi")
VISIT = ("mmsi", "flag")


PORT, ANCHORAGE_SPELL = 2, 1
ORDER = ("event_start", "anch1_port2", "group_id")


def _new_stay(port_gap: int, anchorage_gap: int):
    def rule(prev, cur) -> Column:
        limit = F.when(cur("anch1_port2") == PORT, F.lit(port_gap)).otherwise(F.lit(anchorage_gap))
        return (gap_seconds(cur(TS), prev(TS)) > limit) | (cur("Name") != prev("Name"))
    return rule


# ---- Port calls ---------------------------------------------------------


def slow_rows(tagged: DataFrame) -> DataFrame:
    """Rows stopped in a port (``anch1_port2`` 2) or slow outside every port (1)."""
    kind = F.when(in_port(), F.lit(PORT)).when(anchoring_off_zone(), F.lit(ANCHORAGE_SPELL))
    return tagged.withColumn("anch1_port2", kind).filter(F.col("anch1_port2").isNotNull())


def port_groups(tagged: DataFrame, gap: int = K.PORT_GAP) -> DataFrame:
    """Stopped rows in a port with the running ``group_id`` of their stay, from 1."""
    rows = slow_rows(tagged).filter(F.col("anch1_port2") == PORT)
    rule = _new_stay(gap, K.ANCHORAGE_GAP)
    return tracks.number_groups(rows, SHIP, [TS, "Name", "anch1_port2"], {"group_id": rule}, start=1)


def stay_events(
    tagged: DataFrame, port_gap: int = K.PORT_GAP, anchorage_gap: int = K.ANCHORAGE_GAP,
    min_stay: int = K.PORT_MIN_STAY,
) -> DataFrame:
    """Port stays of at least ``min_stay`` seconds and anchorage spells, numbered from 1 by kind.

    Both kinds come from one pass: the kind is part of the track key.
    """
    events = tracks.islands(
        slow_rows(tagged), [*SHIP, "anch1_port2"], [TS, "Name", "anch1_port2"], _new_stay(port_gap, anchorage_gap),
        "group_id", start=1,
        first={"imo": F.col("imo"), "port_name": F.coalesce(F.col("Name"), F.lit("anch"))},
        least={"event_start": F.col(TS)}, greatest={"event_end": F.col(TS)},
    )
    long_enough = gap_seconds("event_end", "event_start") >= min_stay
    return events.filter((F.col("anch1_port2") == ANCHORAGE_SPELL) | long_enough)


def port_events(tagged: DataFrame) -> DataFrame:
    """One row per port stay."""
    return stay_events(tagged).filter(F.col("anch1_port2") == PORT).select(
        *SHIP, "imo", F.col("group_id").alias("port_group_id"), "port_name",
        F.col("event_start").alias("port_start"), F.col("event_end").alias("port_end"),
    )


def anchorage_events(tagged: DataFrame) -> DataFrame:
    """One row per slow spell outside every port."""
    return stay_events(tagged).filter(F.col("anch1_port2") == ANCHORAGE_SPELL).select(
        *SHIP, "imo", F.col("group_id").alias("anchorage_group_id"),
        F.col("event_start").alias("anch_start"), F.col("event_end").alias("anch_end"),
    )


def event_sequence(events: DataFrame) -> DataFrame:
    """Port and anchorage events of a ship in order, each with its successor.

    Port stays last an hour or more and anchorage spells are an hour or more
    apart, so a ship has at most some 50 rows per day here.
    """
    order = Window.partitionBy(*SHIP).orderBy(*ORDER)
    return events.select(
        *SHIP, "imo", "group_id", "port_name", "event_start", "event_end", "anch1_port2",
        F.lead("anch1_port2").over(order).alias("next_type"),
        F.lead("group_id").over(order).alias("next_group_id"),
        F.lead("event_start").over(order).alias("next_start"),
        F.lead("port_name").over(order).alias("next_port_name"),
    ).withColumn("time_to_next", gap_seconds("next_start", "event_end"))


def anch_port_links(sequence: DataFrame, gap: int = K.LINK_GAP) -> DataFrame:
    """Anchorage spells whose next event is a port stay that starts within ``gap`` seconds."""
    linked = (
        (F.col("anch1_port2") == ANCHORAGE_SPELL) & (F.col("next_type") == PORT) & (F.col("time_to_next") <= gap)
    )
    return sequence.filter(linked).select(
        *SHIP, "imo", F.col("group_id").alias("anchorage_group_id"), F.col("event_start").alias("anch_start"),
        F.col("event_end").alias("anch_end"), F.col("next_group_id").alias("port_group_id"),
    )


def port_calls(tagged: DataFrame, specs: DataFrame | None = None, gap: int = K.LINK_GAP) -> DataFrame:
    """Port stays with the anchorage wait before them, and the ship's specifications.

    A stay can only be linked to the event right before it, so the link is read
    off the event sequence with ``lag`` instead of a self-join.
    """
    order = Window.partitionBy(*SHIP).orderBy(*ORDER)
    before = F.lag(F.struct("anch1_port2", "group_id", "event_start", "event_end")).over(order)
    near = gap_seconds("event_start", "_b.event_end") <= gap
    linked = (F.col("_b.anch1_port2") == ANCHORAGE_SPELL) & near
    calls = stay_events(tagged).withColumn("_b", before).filter(F.col("anch1_port2") == PORT).select(
        "imo", "mmsi", F.col("group_id").alias("port_group_id"), "port_name",
        F.col("event_start").alias("port_start"), F.col("event_end").alias("port_end"),
        F.when(linked, F.col("_b.group_id")).alias("anchorage_group_id"),
        F.when(linked, F.col("_b.event_start")).alias("anch_start"),
        F.when(linked, F.col("_b.event_end")).alias("anch_end"),
    )
    return calls if specs is None else lookup_join(calls, specs, ["mmsi"], "left")


# ---- Port-stop visits -----------------------------------------------------


def _visit_break(gap: int):
    def rule(prev, cur) -> Column:
        after_port = cur("Name").isin(K.ANCHORAGES) & prev("Name").isin(K.PORTS)
        return (gap_seconds(cur(TS), prev(TS)) >= gap) | after_port
    return rule


def number_visits(tagged: DataFrame, gap: int = K.SEGMENT_GAP) -> DataFrame:
    """Port and anchorage rows with visit number ``flag`` and zone segment number ``segr``."""
    rows = tagged.filter(F.col("Name").isin(K.PORTS + K.ANCHORAGES))
    return tracks.number_groups(
        rows, ["mmsi"], [TS, "Name"],
        {"flag": _visit_break(gap), "segr": lambda prev, cur: cur("Name") != prev("Name")},
    )


def visit_tests(visits: DataFrame) -> DataFrame:
    """Per visit: whether it has a port row and an anchorage row."""
    return visits.groupBy(*VISIT).agg(
        F.max(F.col("Name").isin(K.PORTS)).alias("has_port"),
        F.max(F.col("Name").isin(K.ANCHORAGES)).alias("has_anchorage"),
    )


def port_stops_cutoff(tagged: DataFrame, gap: int = K.SEGMENT_GAP) -> DataFrame:
    """Rows of the visits that hold both a port row and an anchorage row.

    The numbered rows are read twice, to judge visits and to pick rows, so they
    are written out once first.
    """
    visits = checkpoint(number_visits(tagged, gap))
    kept = visit_tests(visits).filter("has_port AND has_anchorage").select(*VISIT)
    return lookup_join(visits, kept, VISIT, "left_semi", grows=True)


def port_ships(stops: DataFrame) -> DataFrame:
    """Distinct ships with port stops."""
    return stops.select("mmsi").distinct()


def _joins_previous(reference: str, limit: int) -> Column:
    same = (F.col("op_phase") == reference) & (F.col("_prev_phase") == reference)
    return F.coalesce(same, F.lit(False))


def merge_stop_segments(stops: DataFrame, reference: str, protected: str, limit: int = K.HOUR) -> DataFrame:
    """Give a reference-phase row the previous row's ``segr`` if that row has the phase too, within ``limit``.

    Only the first row of a following segment changes; :func:`merge_stop_islands` merges whole runs.
    """
    found = tracks.lag_within(stops, VISIT, {"_prev_phase": "op_phase", "_prev_segr": "segr"}, limit)
    take = _joins_previous(reference, limit) & (F.col("op_phase") != protected)
    return found.withColumn("segr", F.when(take, F.col("_prev_segr")).otherwise(F.col("segr"))).drop(
        "_prev_phase", "_prev_segr"
    )


def merge_stop_islands(stops: DataFrame, reference: str, protected: str, limit: int = K.HOUR) -> DataFrame:
    """Give every row of a reference-phase run the ``segr`` of the run's first row."""
    found = tracks.lag_within(stops, VISIT, {"_prev_phase": "op_phase"}, limit)
    take = _joins_previous(reference, limit) & (F.col("op_phase") != protected)
    opening = found.withColumn("_opening", F.when(~take, F.col("segr"))).drop("_prev_phase")
    filled = tracks.fill_forward(opening, VISIT, "_opening", "_merged")
    return filled.withColumn("segr", F.col("_merged")).drop("_opening", "_merged")


def berth_spans(stops: DataFrame) -> DataFrame:
    return stops.filter(F.col("op_phase") == K.BERTH).groupBy(*VISIT, "segr").agg(
        F.min(TS).alias("berth_min_dt_pos_utc"), F.max(TS).alias("berth_max_dt_pos_utc")
    )


def visit_name(stops: DataFrame, mode: bool = False) -> DataFrame:
    """Berth name of each visit: the earliest, or with ``mode`` the most frequent (ties: least name)."""
    berths = stops.filter((F.col("op_phase") == K.BERTH) & F.col("Name").isNotNull())
    if not mode:
        return berths.groupBy(*VISIT).agg(F.min_by("Name", F.col(TS)).alias("mode_name"))
    counts = berths.groupBy(*VISIT, "Name").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*VISIT).agg(F.min_by("Name", F.struct(-F.col("_n"), F.col("Name"))).alias("mode_name"))


def anchorage_spans(stops: DataFrame, drop_last: bool = True) -> DataFrame:
    """Anchorage spans per segment; ``drop_last`` leaves out each visit's last anchorage row."""
    rows = stops.filter(F.col("op_phase") == K.ANCHORAGE)
    if drop_last:
        ends = rows.groupBy(*VISIT).agg(F.max(TS).alias("_end"))
        rows = lookup_join(rows, ends, VISIT, "inner", grows=True).filter(F.col(TS) < F.col("_end"))
    return rows.groupBy(*VISIT, "segr").agg(
        F.min(TS).alias("anchorage_min_dt_pos_utc"), F.max(TS).alias("anchorage_max_dt_pos_utc")
    )


BERTH_COLUMNS = (
    "flag", "mmsi", "mode_name", "berth_min_dt_pos_utc", "berth_max_dt_pos_utc",
    "anchorage_min_dt_pos_utc", "anchorage_max_dt_pos_utc",
)


def berth_anchorage(stops: DataFrame, mode: bool = False) -> DataFrame:
    """Each berth span with the anchorage spans of its visit; the result itself lists all of them.

    :func:`berth_anchorage_nearest` gives the one preceding wait instead.
    """
    joined = berth_spans(stops).join(anchorage_spans(stops).drop("segr"), list(VISIT), "left")
    return joined.join(visit_name(stops, mode), list(VISIT), "left").select(*BERTH_COLUMNS)


def berth_anchorage_nearest(stops: DataFrame, mode: bool = False) -> DataFrame:
    """Each berth span with the last anchorage span that ended before it began.

    The as-of match is a forward fill over the merged span list, not a join.
    """
    berths = berth_spans(stops).select(
        *VISIT, F.col("berth_min_dt_pos_utc").alias("_at"), F.lit(1).alias("_is_berth"),
        "berth_min_dt_pos_utc", "berth_max_dt_pos_utc",
    )
    waits = anchorage_spans(stops, drop_last=False).select(
        *VISIT, F.col("anchorage_max_dt_pos_utc").alias("_at"), F.lit(0).alias("_is_berth"),
        F.struct("anchorage_min_dt_pos_utc", "anchorage_max_dt_pos_utc").alias("_wait"),
    )
    both = berths.unionByName(waits, allowMissingColumns=True)
    order = Window.partitionBy(*VISIT).orderBy("_at", F.col("_is_berth").desc(), "_wait")
    last_wait = F.last("_wait", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    matched = both.withColumn("_wait", last_wait).filter(F.col("_is_berth") == 1).select(
        *VISIT, "berth_min_dt_pos_utc", "berth_max_dt_pos_utc", "_wait.*"
    )
    return matched.join(visit_name(stops, mode), list(VISIT), "left").select(*BERTH_COLUMNS)


