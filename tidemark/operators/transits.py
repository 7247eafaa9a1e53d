"""Canal transits.

A transit is decided from zone visits, not from single positions. Positions are
therefore reduced to segments (a run of rows in one zone without a 72 h gap)
right after the only shuffle of position rows; anchors, pairs, access and lock
tests, stays and the final table are all computed on segments. Only
:func:`transit_candidates`, whose result is position rows, goes back to them.

``ship`` is the key of every step (see :func:`tidemark.operators.tracks.with_ship`):
ships with and without an IMO number are handled in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import constants as K
from tidemark.functions.time import gap_seconds
from tidemark.operators import tracks
from tidemark.operators.lookup import lookup_join
from tidemark.operators.zones import at_anchor, at_stop

TS = "dt_pos_utc"
SHIP = ["ship"]
IDENTITY = ["ship", "imo", "mmsi"]


def _along(*extra: str):
    return Window.partitionBy("ship", *extra).orderBy("part")


def _rows_up_to(window):
    return window.rowsBetween(Window.unboundedPreceding, 0)


def _new_segment(gap: int):
    def rule(prev, cur) -> Column:
        return (gap_seconds(cur(TS), prev(TS)) >= gap) | (cur("Name") != prev("Name"))
    return rule


# ---- Stage 1: segments ------------------------------------------------------


def transit_segments(tagged: DataFrame, gap: int = K.SEGMENT_GAP) -> DataFrame:
    """Position rows with their running segment number ``segr``."""
    return tracks.number_groups(tagged, SHIP, [TS, "Name"], {"segr": _new_segment(gap)})


def segments(tagged: DataFrame, gap: int = K.SEGMENT_GAP) -> DataFrame:
    """Segments as rows: zone, span, spans of slow rows and draught counts in locks.

    A segment during which the ship's MMSI changes is given as several parts,
    one per MMSI run; ``is_head`` marks the part that opens the segment. For a
    closing anchorage only the very first row counts, hence ``first_at_*``.
    """
    breaks = _new_segment(gap)
    lock = F.col("Name").isin(K.LOCKS)
    parts = tracks.islands(
        tagged, SHIP, [TS, "Name", "mmsi"],
        lambda prev, cur: breaks(prev, cur) | (cur("mmsi") != prev("mmsi")), "part",
        first={
            "imo": F.col("imo"), "mmsi": F.col("mmsi"), "Name": F.col("Name"),
            "first_at_anchor": at_anchor(), "first_at_stop": at_stop(),
        },
        least={
            "seg_start": F.col(TS),
            "anchor_in": F.when(at_anchor(), F.col(TS)), "stop_in": F.when(at_stop(), F.col(TS)),
        },
        greatest={
            "seg_end": F.col(TS),
            "anchor_out": F.when(at_anchor(), F.col(TS)), "stop_out": F.when(at_stop(), F.col(TS)),
        },
        tally=("draughts", F.col("draught"), lock),
    )
    changed = F.col("Name") != F.lag("Name").over(_along())
    far = gap_seconds("seg_start", F.lag("seg_end").over(_along())) >= gap
    opens = F.coalesce(changed | far, F.lit(False))
    parts = parts.select(
        "*",
        F.coalesce(changed, F.lit(False)).alias("name_changed"), opens.alias("_opens"),
        (opens | F.lag("part").over(_along()).isNull()).alias("is_head"),
    )
    so_far = _rows_up_to(_along())
    return parts.select(
        "*",
        F.sum(F.col("_opens").cast("long")).over(so_far).alias("segr"),
        F.sum(F.col("Name").isin(K.PORTS).cast("long")).over(so_far).alias("ports_so_far"),
    ).drop("_opens")


# ---- Stages 2-8: anchors, pairs, transit numbers ------------------------------
#
# Each step marks segments instead of filtering them, and its windows take the
# mark into their partition. The marked rows then see only each other, nothing
# is joined back, and all windows share the one hash partitioning by ship.


def mark_anchors(segs: DataFrame) -> DataFrame:
    """``anchor``: the segment opens in the Atlantic or Pacific anchorage."""
    return segs.withColumn("anchor", F.col("is_head") & F.col("Name").isin(K.ANCHORAGES))


def mark_port_filter(marked: DataFrame) -> DataFrame:
    """Unmark anchors followed by an anchor of the same zone with a port in between.

    Before the first anchor of a track the port count starts at zero, so a port
    visited before it counts as well.
    """
    among = _along("anchor")
    out = marked.select(
        "*",
        F.lead(F.struct("Name", "ports_so_far")).over(among).alias("_next"),
        F.when(F.lag("part").over(among).isNull(), F.lit(0)).otherwise(F.col("ports_so_far")).alias("_from"),
    )
    revisit = (F.col("_next.Name") == F.col("Name")) & (F.col("_next.ports_so_far") > F.col("_from"))
    out = out.withColumn("anchor", F.col("anchor") & ~F.coalesce(revisit, F.lit(False)))
    return out.drop("_next", "_from")


def mark_pairs(marked: DataFrame, undecided_gap: int = K.UNDECIDED_GAP) -> DataFrame:
    """Keep only the opening and closing anchor of each transit, ``run_row`` 1 and 2.

    Anchors that alternate between the two anchorages form a ``run``. A run of
    two is a pair. In a longer run, anchors whose successor is more than
    ``undecided_gap`` seconds later go; if two are left they are a pair,
    otherwise the run is discarded. ``close_segr`` is the pair's last segment.
    """
    among, in_run = _along("anchor"), _along("anchor", "run")
    whole = in_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    repeated = F.coalesce(F.col("Name") == F.lag("Name").over(among), F.lit(False)).cast("long")
    out = marked.withColumn("_repeat", repeated)
    out = out.withColumn("run", F.sum("_repeat").over(_rows_up_to(among)))
    out = out.select(
        "*",
        F.count(F.lit(1)).over(whole).alias("_size"),
        gap_seconds(F.lead("seg_start").over(in_run), "seg_start").alias("_wait"),
    )
    long_wait = F.coalesce(F.col("_wait") > undecided_gap, F.lit(False))
    out = out.withColumn("_kept", (F.col("_size") == 2) | ((F.col("_size") > 2) & ~long_wait))
    out = out.select(
        "*",
        F.sum(F.col("_kept").cast("long")).over(whole).alias("_left"),
        F.sum(F.col("_kept").cast("long")).over(_rows_up_to(in_run)).alias("run_row"),
        F.max(F.when(F.col("_kept"), F.col("segr"))).over(whole).alias("close_segr"),
    )
    out = out.withColumn("anchor", F.col("anchor") & F.col("_kept") & (F.col("_left") == 2))
    return out.drop("_repeat", "_size", "_wait", "_kept", "_left")


def mark_flags(marked: DataFrame) -> DataFrame:
    """Carry the latest opening anchor forward as ``opening`` = (close_segr, open_segr, open_zone).

    ``flag`` is the running count of accepted anchors; the closing anchor keeps
    the number of its opening one.
    """
    opening = F.struct("close_segr", F.col("segr").alias("open_segr"), F.col("Name").alias("open_zone"))
    opens = F.when(F.col("anchor") & (F.col("run_row") == 1), opening)
    so_far = _rows_up_to(_along())
    out = marked.select(
        "*",
        F.last(opens, ignorenulls=True).over(so_far).alias("opening"),
        F.sum(F.col("anchor").cast("long")).over(so_far).alias("_count"),
    )
    closes = F.col("anchor") & (F.col("run_row") == 2)
    return out.withColumn("flag", F.col("_count") - F.when(closes, 1).otherwise(0)).drop("_count")


def transit_anchors(segs: DataFrame) -> DataFrame:
    """Segments that open in an anchorage."""
    return mark_anchors(segs).filter("anchor")


def transit_port_filter(segs: DataFrame) -> DataFrame:
    """Anchors left by the port-between test."""
    return mark_port_filter(mark_anchors(segs)).filter("anchor")


def transit_pairs(segs: DataFrame) -> DataFrame:
    """Opening and closing anchors with ``run`` and ``run_row``."""
    return mark_pairs(mark_port_filter(mark_anchors(segs))).filter("anchor")


def transit_flags(segs: DataFrame) -> DataFrame:
    """One row per pair: ``flag`` and the segment range."""
    marked = mark_flags(mark_pairs(mark_port_filter(mark_anchors(segs))))
    return marked.filter(F.col("anchor") & (F.col("run_row") == 1)).select(
        "ship", "flag", "opening.open_segr", "opening.close_segr", "opening.open_zone"
    )


def transit_members(segs: DataFrame) -> DataFrame:
    """Segments inside a transit, up to the first row of the closing one (``is_close``).

    ``transit_segr`` recounts the zone changes within the transit, and
    ``left_opening`` tells whether the other anchorage has been reached.
    """
    marked = mark_flags(mark_pairs(mark_port_filter(mark_anchors(segs))))
    closing = F.col("segr") == F.col("opening.close_segr")
    inside = marked.filter((F.col("segr") < F.col("opening.close_segr")) | (closing & F.col("is_head")))
    so_far = _rows_up_to(_along("flag"))
    other = F.col("Name").isin(K.ANCHORAGES) & (F.col("Name") != F.col("opening.open_zone"))
    return inside.select(
        *segs.columns, "flag", F.col("opening.open_zone").alias("open_zone"), closing.alias("is_close"),
        F.sum(F.col("name_changed").cast("long")).over(so_far).alias("transit_segr"),
        F.max(other).over(so_far).alias("left_opening"),
    )


# ---- Stages 9-10: access and locks ------------------------------------------


def transit_tests(members: DataFrame) -> DataFrame:
    """Add, per transit, ``access`` and whether the locks of each pair changed: true, false, or null for none."""
    over = Window.partitionBy("ship", "flag")

    def changed(pair: list[str]) -> Column:
        name = F.when(F.col("Name").isin(pair), F.col("Name"))
        return F.min(name).over(over) != F.max(name).over(over)

    return members.select(
        "*",
        F.max(F.col("Name").isin(K.ACCESS_ZONES)).over(over).alias("access"),
        changed(K.ORIGINAL_LOCK_PAIR).alias("original_locks"), changed(K.NEO_LOCK_PAIR).alias("neo_locks"),
    )


def transit_access(tested: DataFrame) -> DataFrame:
    """Segments of transits that touch an access zone."""
    return tested.filter("access")


def transit_locks(tested: DataFrame, strict_locks: bool = False) -> DataFrame:
    """Segments of transits that used the locks, with ``neo_transit``.

    By default one lock of a pair is enough; ``strict_locks`` asks for both.
    """
    def used(test: str) -> Column:
        return F.coalesce(F.col(test), F.lit(False)) if strict_locks else F.col(test).isNotNull()

    kept = tested.filter(used("original_locks") | used("neo_locks"))
    return kept.withColumn("neo_transit", used("neo_locks").cast("int"))


def transit_attributes(members: DataFrame) -> DataFrame:
    """Add ``anchoring_group``, ``port_group`` and ``dir``."""
    anchorage = F.col("Name").isin(K.ANCHORAGES)
    return members.select(
        "*",
        F.when(anchorage & ~F.col("left_opening"), F.lit(1)).alias("anchoring_group"),
        F.when(F.col("Name").isin(K.PORTS + K.STOPS), F.lit(1)).alias("port_group"),
        F.when(F.col("open_zone") == K.ATLANTIC_ANCHORAGE, "South").otherwise("North").alias("dir"),
    )


def transit_visits(segs: DataFrame, strict_locks: bool = False) -> DataFrame:
    """All segments of accepted transits with their attributes (stages 2 to 11)."""
    tested = transit_tests(transit_members(segs))
    return transit_attributes(transit_locks(transit_access(tested), strict_locks))


def transit_candidates(tagged: DataFrame, strict_locks: bool = False, gap: int = K.SEGMENT_GAP) -> DataFrame:
    """Position rows of accepted transits with flag, recounted segr and attributes."""
    rows = transit_segments(tagged, gap)
    visits = transit_visits(segments(tagged, gap), strict_locks).filter("is_head").select(
        "ship", "segr", "flag", "transit_segr", "is_close", "seg_start",
        "neo_transit", "anchoring_group", "port_group", "dir",
    )
    joined = lookup_join(rows, visits, ["ship", "segr"], "inner", grows=True)
    joined = joined.filter(~F.col("is_close") | (F.col(TS) == F.col("seg_start")))
    return joined.drop("segr", "is_close", "seg_start").withColumnRenamed("transit_segr", "segr")


# ---- Stays, locks, draught, final table -------------------------------------


def zone_visits(visits: DataFrame) -> DataFrame:
    """Segments of a transit merged by the recounted segment number, per identity."""
    first_row = {kind: F.when(F.col(f"first_at_{kind}"), F.col("seg_start")) for kind in ("anchor", "stop")}
    spans = visits.select(
        *IDENTITY, "flag", "transit_segr", "Name", "neo_transit", "seg_start", "seg_end", "draughts",
        *[
            F.when(F.col("is_close"), first_row[kind]).otherwise(F.col(f"{kind}_{end}")).alias(f"{kind}_{end}")
            for kind in first_row for end in ("in", "out")
        ],
    )
    return spans.groupBy(*IDENTITY, "flag", "transit_segr").agg(
        F.min("Name").alias("Name"), F.max("neo_transit").alias("neo_transit"),
        F.min("seg_start").alias("seg_start"), F.max("seg_end").alias("seg_end"),
        *[F.min(f"{kind}_in").alias(f"{kind}_in") for kind in first_row],
        *[F.max(f"{kind}_out").alias(f"{kind}_out") for kind in first_row],
        F.flatten(F.collect_list("draughts")).alias("draughts"),
    )


def anchorage_stays(visits: DataFrame) -> DataFrame:
    """Slow spells in an anchorage during a transit."""
    return zone_visits(visits).filter(F.col("anchor_in").isNotNull()).select(
        *IDENTITY, "flag", F.col("anchor_in").alias("anchoring_in"), F.col("anchor_out").alias("anchoring_out"),
        F.col("Name").alias("anch_area"),
    )


def transit_stops(visits: DataFrame) -> DataFrame:
    """Slow spells in a port or Gatun Anchorage during a transit."""
    return zone_visits(visits).filter(F.col("stop_in").isNotNull()).select(
        *IDENTITY, "flag", F.col("stop_in").alias("stop_time_in"), F.col("stop_out").alias("stop_time_out"),
        F.col("Name").alias("stop_area"),
    )


def _most_frequent(entries: Column) -> Column:
    """Value with the largest total ``n`` in an array of (value, n); ties least, null only if alone."""
    def total(value: Column) -> Column:
        same = F.filter(entries, lambda e: e["value"].eqNullSafe(value))
        return F.aggregate(same, F.lit(0).cast("long"), lambda acc, e: acc + e["n"])

    values = F.array_distinct(F.transform(entries, lambda e: e["value"]))
    ranked = F.transform(values, lambda v: F.struct(v.isNull().alias("_1"), (-total(v)).alias("_2"), v.alias("_3")))
    return F.array_min(ranked)["_3"]


def transit_summary(visits: DataFrame) -> DataFrame:
    """One row per identity and transit with locks: lock times and names, direction, draught, stays."""
    lock = F.col("Name").isin(K.LOCKS)
    stay = F.struct(F.col("anchor_in").alias("anchoring_in"), F.col("anchor_out").alias("anchoring_out"))
    summary = zone_visits(visits).groupBy(*IDENTITY, "flag").agg(
        F.max("neo_transit").alias("neo_transit"),
        F.min(F.when(lock, F.col("seg_start"))).alias("lock_in"),
        F.max(F.when(lock, F.col("seg_end"))).alias("lock_out"),
        F.min_by("Name", F.when(lock, F.col("seg_start"))).alias("first_lock_name"),
        F.max_by("Name", F.when(lock, F.col("seg_end"))).alias("last_lock_name"),
        F.max(F.col("stop_in").isNotNull()).alias("_stopped"),
        F.flatten(F.collect_list("draughts")).alias("_draughts"),
        F.collect_list(F.when(F.col("anchor_in").isNotNull(), stay)).alias("stays"),
    ).filter(F.col("lock_in").isNotNull())
    north = F.col("first_lock_name").isin(K.NORTHBOUND_FIRST_LOCKS)
    return summary.select(
        *IDENTITY, "flag", "neo_transit", "lock_in", "lock_out", "first_lock_name", "last_lock_name",
        F.when(north, "North").otherwise("South").alias("direction"),
        F.when(F.col("_stopped"), F.lit(0)).otherwise(F.lit(1)).alias("direct_transit"),
        _most_frequent(F.col("_draughts")).alias("draught"),
        "stays",
    )


def lock_summary(visits: DataFrame) -> DataFrame:
    """First and last lock of each transit, with their times and the direction."""
    return transit_summary(visits).drop("direct_transit", "draught", "stays")


def draught_mode(visits: DataFrame) -> DataFrame:
    """Most frequent draught in the locks of each transit; ties go to the smallest, null never beats a value."""
    return transit_summary(visits).select(*IDENTITY, "flag", "draught")


def direct_transit(visits: DataFrame) -> DataFrame:
    """1 for a transit through the locks without a stop, else 0."""
    return transit_summary(visits).select(*IDENTITY, "flag", "direct_transit")


def transits(visits: DataFrame, specs: DataFrame | None = None, one_row: bool = False) -> DataFrame:
    """The transit table.

    One row per anchorage stay (a transit without a stay has one row with null
    times); ``one_row`` keeps the earliest stay only.
    """
    summary = transit_summary(visits)
    stay = F.array_min("stays") if one_row else F.explode_outer("stays")
    table = summary.withColumn("_stay", stay).select(
        "imo", "mmsi", "flag", "lock_in", "lock_out", "_stay.anchoring_in", "_stay.anchoring_out",
        "direct_transit", "direction", "neo_transit", "draught",
    )
    return table if specs is None else lookup_join(table, specs, ["mmsi"], "left")
