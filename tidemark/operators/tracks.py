"""Ordered-track operators that never put a whole ship into one task.

A track is the time-ordered rows of one ship. A single ship may own a large part
of the data, so windows are not run over the whole track. Each track is cut into
fixed time slices; window functions run inside (ship, slice), and what has to
cross a slice border travels through a small table with one row per ship and
slice. A slice holds what one ship's receivers report in a week, however long its
track; :func:`dedup_positions`, where a caller asks for it, bounds that by one row per second.

Rows are in total order: by time, then by the other columns in the order in which the
table has them. So rows of the same second all count, and their order does not depend on how they arrive.

Key columns must not be null; use :func:`with_ship` to get a single such key. Lags, numbers, groups, fills and islands leave
out rows without a key or a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.constants import SLICE_WIDTH
from tidemark.functions.time import gap_seconds, seconds, time_slice

SLICE = "_slice"
#: (value of a column on the previous row, value on this row) -> "a new group starts here"
Break = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _known_imo(least: int) -> Column:
    """The IMO number; null below ``least``. Receivers send 0 for none, which would make one track of many ships."""
    imo = F.col("imo").cast("long")
    return F.when(imo >= least, imo)


def with_ship(df: DataFrame, name: str = "ship", least_imo: int = 1) -> DataFrame:
    """Add one non-null ship key: the IMO number, or the negated MMSI without a valid one."""
    return df.withColumn(name, F.coalesce(_known_imo(least_imo), -F.col("mmsi").cast("long")))


def with_identity(df: DataFrame, name: str = "imo_key", least_imo: int = 1) -> DataFrame:
    """Add a non-null form of ``imo`` so that (imo_key, mmsi) can key joins."""
    return df.withColumn(name, F.coalesce(_known_imo(least_imo), F.lit(-1).cast("long")))


def dedup_positions(
    df: DataFrame, key: Sequence[str], ts: str = "dt_pos_utc", tie: Sequence[str] = ()
) -> DataFrame:
    """Keep one row per key and second: the least by ``ts``, ``tie``, then all columns.

    Grouped aggregation, so repeats are combined before the shuffle and the
    shuffle key (ship, second) cannot be hot.
    """
    order = [ts, *tie]
    rest = [c for c in df.columns if c not in order and c not in key]
    least = F.min(F.struct(*order, *rest)).alias("_row")
    grouped = df.groupBy(*key, seconds(ts).alias("_second")).agg(least)
    return grouped.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def row_order(df: DataFrame, key: Sequence[str], ts: str) -> list[str]:
    """Columns that put the rows of a track into total order, up to equal rows."""
    return [ts, *[f.name for f in df.schema.fields if f.name not in (*key, ts) and not isinstance(f.dataType, T.MapType)]]


def _windows(key: Sequence[str], order: Sequence[str]):
    inside = Window.partitionBy(*key, SLICE).orderBy(*order)
    across = Window.partitionBy(*key).orderBy(SLICE)
    return inside, across


def _sliced(df: DataFrame, key: Sequence[str], ts: str, width: int) -> DataFrame:
    """Rows with a key and a time, and their slice.

    All operators of this module slice a table alike and sort it by all its columns, and none of the values is null any more,
    so that no join adds a filter to one of several uses: Spark then shuffles the table once for all of them.
    """
    known = df.filter(F.col(ts).isNotNull())
    for c in key:
        known = known.filter(F.col(c).isNotNull())
    return known.withColumn(SLICE, F.coalesce(time_slice(ts, width), F.lit(0).cast("long")))


def _local(df: DataFrame, key: Sequence[str], ts: str, width: int, order: Sequence[str], made: Mapping[str, Column]) -> DataFrame:
    """Sliced rows, the ``made`` window columns and ``_closes``: the last row of its slice.

    A track is numbered or filled along its rows by a prefix scan in two levels. What a slice hands on stands
    on its closing row: :func:`_handed_on` combines those rows along the track, and a join brings the result back. Both
    sides need the same columns of the sliced rows, hence Spark reads the input and shuffles it once and uses that shuffle twice.
    """
    inside = _windows(key, order)[0]
    return _sliced(df, key, ts, width).select("*", *[c.alias(n) for n, c in made.items()], F.lead(F.lit(1)).over(inside).isNull().alias("_closes"))


def _handed_on(local: DataFrame, key: Sequence[str], made: Mapping[str, Column]) -> DataFrame:
    """One row per track and slice with the ``made`` columns, which may look along the closing rows of the track."""
    return local.filter("_closes").select(*key, SLICE, *[c.alias(n) for n, c in made.items()])


def track_lag(
    df: DataFrame,
    key: Sequence[str],
    cols: Mapping[str, str],
    ts: str = "dt_pos_utc",
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Add the previous row's values: ``cols`` maps new column -> source column."""
    order = row_order(df, key, ts)
    inside, across = _windows(key, order)
    made = {"_opens": F.lag(F.lit(1)).over(inside).isNull()} | {f"_lag_{new}": F.lag(src).over(inside) for new, src in cols.items()}
    local = _local(df, key, ts, width, order, made)
    packed = F.struct(*[F.col(src).alias(new) for new, src in cols.items()])
    joined = local.join(_handed_on(local, key, {"_before": F.lag(packed).over(across)}), [*key, SLICE])
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[F.when(F.col("_opens"), F.col(f"_before.{new}")).otherwise(F.col(f"_lag_{new}")).alias(new) for new in cols],
    )


def track_rownum(
    df: DataFrame, key: Sequence[str], name: str = "row", ts: str = "dt_pos_utc",
    tie: Sequence[str] = (), width: int = SLICE_WIDTH,
) -> DataFrame:
    """Number the rows of every track from 1."""
    order = [ts, *tie, *[c for c in row_order(df, key, ts)[1:] if c not in tie]]
    inside, across = _windows(key, order)
    local = _local(df, key, ts, width, order, {"_row": F.row_number().over(inside)})
    total = F.sum("_row").over(across.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_row")
    joined = local.join(_handed_on(local, key, {"_before": total}), [*key, SLICE])
    return joined.withColumn(name, F.col("_row") + F.col("_before")).select(*df.columns, name)


def lag_within(
    df: DataFrame,
    key: Sequence[str],
    cols: Mapping[str, str],
    limit: int,
    ts: str = "dt_pos_utc",
    width: int = SLICE_WIDTH,
    ahead: bool = False,
) -> DataFrame:
    """Previous (or next, with ``ahead``) row's values if at most ``limit`` seconds away, else null.

    Rows near a slice border are copied into the neighbouring slice, so one
    shuffle and no join is enough when the look-back is bounded.
    """
    if not 0 < limit <= width:
        raise ValueError("limit must be positive and not exceed the slice width")
    offset = F.pmod(seconds(ts), F.lit(width))
    near = offset < F.lit(limit) if ahead else offset >= F.lit(width - limit)
    other = F.col(SLICE) + F.lit(-1 if ahead else 1)
    copies = F.when(near, F.array(F.col(SLICE), other)).otherwise(F.array(F.col(SLICE)))
    sliced = (
        df.withColumn(SLICE, time_slice(ts, width))
        .withColumn("_home", F.col(SLICE))
        .withColumn(SLICE, F.explode(copies))
    )
    inside = Window.partitionBy(*key, SLICE).orderBy(*row_order(df, key, ts))
    step = F.lead if ahead else F.lag
    found = sliced.select(
        "*", step(ts).over(inside).alias("_at"), *[step(src).over(inside).alias(f"_near_{new}") for new, src in cols.items()]
    ).filter(F.col("_home") == F.col(SLICE))
    distance = gap_seconds("_at", ts) if ahead else gap_seconds(ts, "_at")
    return found.select(
        *[F.col(c) for c in df.columns],
        *[F.when(distance <= limit, F.col(f"_near_{new}")).alias(new) for new in cols],
    )


def fill_forward(
    df: DataFrame, key: Sequence[str], source: str, name: str, ts: str = "dt_pos_utc", width: int = SLICE_WIDTH
) -> DataFrame:
    """Last non-null value of ``source`` at or before each row."""
    order = row_order(df, key, ts)
    inside, across = _windows(key, order)
    so_far = F.last(source, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    local = _local(df, key, ts, width, order, {"_value": so_far})
    before = F.last("_value", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1))
    joined = local.join(_handed_on(local, key, {"_before": before}), [*key, SLICE])
    return joined.withColumn("_value", F.coalesce("_value", "_before")).select(*df.columns, F.col("_value").alias(name))


def _true(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False)).cast("long")


def number_groups(
    df: DataFrame,
    key: Sequence[str],
    carry: Sequence[str],
    ids: Mapping[str, Break],
    start: int = 0,
    ts: str = "dt_pos_utc",
    width: int = SLICE_WIDTH,
) -> DataFrame:
    """Running count of breaks along each track, one id column per entry of ``ids``.

    ``carry`` lists the columns the break rules look at. The first row of a
    track gets ``start``; a rule that yields null does not break.
    """
    order = row_order(df, key, ts)
    inside, across = _windows(key, order)
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    here = F.struct(*carry)
    first = {f"_head_{c}": F.first(c).over(running) for c in carry}
    local = _local(df, key, ts, width, order, _previous(carry, ts, inside) | first)
    local = local.select("*", *[F.sum(_local_break(rule, ts)).over(running).alias(f"_cut_{n}") for n, rule in ids.items()])

    tail = F.lag(here).over(across)
    border = _handed_on(local, key, {"_head": F.struct(*[F.col(f"_head_{c}").alias(c) for c in carry]), "_before": tail} | {f"_n_{n}": F.col(f"_cut_{n}") for n in ids})
    total = across.rowsBetween(Window.unboundedPreceding, 0)
    offsets = []
    for n, rule in ids.items():
        edge = F.when(F.col("_before").isNull(), F.lit(0).cast("long")).otherwise(
            _true(rule(_field("_before"), _field("_head")))
        )
        border = border.withColumn(f"_edge_{n}", edge)
        offsets.append((F.sum(F.col(f"_n_{n}") + F.col(f"_edge_{n}")).over(total) - F.col(f"_n_{n}")).alias(f"_off_{n}"))
    border = border.select(*key, SLICE, *offsets)

    joined = local.join(border, [*key, SLICE])
    return joined.select(
        *[F.col(c) for c in df.columns if c not in ids],
        *[(F.col(f"_cut_{n}") + F.col(f"_off_{n}") + F.lit(start)).alias(n) for n in ids],
    )


def _field(struct: str) -> Callable[[str], Column]:
    return lambda name: F.col(f"{struct}.{name}")


def _previous(carry: Sequence[str], ts: str, inside: Window) -> dict[str, Column]:
    """The previous row's carry columns inside the slice.

    Plain columns, because a packed struct would be built before the shuffle
    and travel through it next to its parts.
    """
    return {f"_prev_{c}": F.lag(c).over(inside) for c in dict.fromkeys([*carry, ts])}


def _local_break(rule: Break, ts: str) -> Column:
    """1 where a row starts a new group inside its slice; a slice's first row is judged later."""
    opens = _true(rule(lambda name: F.col(f"_prev_{name}"), F.col))
    return F.when(F.col(f"_prev_{ts}").isNull(), F.lit(0).cast("long")).otherwise(opens)


def value_counts(entries: Column) -> Column:
    """Array of struct(value) to array of (value, n), one per distinct value."""
    def count(one: Column) -> Column:
        return F.size(F.filter(entries, lambda e: e["value"].eqNullSafe(one["value"]))).cast("long")

    return F.transform(
        F.array_distinct(entries), lambda one: F.struct(one["value"].alias("value"), count(one).alias("n"))
    )


def islands(
    df: DataFrame,
    key: Sequence[str],
    carry: Sequence[str],
    rule: Break,
    name: str,
    start: int = 0,
    ts: str = "dt_pos_utc",
    width: int = SLICE_WIDTH,
    least: Mapping[str, Column] | None = None,
    greatest: Mapping[str, Column] | None = None,
    first: Mapping[str, Column] | None = None,
    tally: tuple[str, Column, Column] | None = None,
) -> DataFrame:
    """One row per island (run without a break) of each track, numbered from ``start``.

    Rows are first reduced to fragments inside (ship, slice), in the same
    partitioning as the window that finds the breaks. Only fragments, about one
    per island or ship-week, are then linked along the whole track and merged.

    ``least``/``greatest`` are min/max of an expression and ``first`` its value
    on the island's first row. ``tally`` is (name, value, condition): an array of
    (value, n) with the count of each distinct value over the rows that meet the
    condition; a value may come up once per fragment. It is counted inside
    (ship, slice), so no list is longer than a slice has rows.
    """
    least, greatest, first = dict(least or {}), dict(greatest or {}), dict(first or {})
    order = row_order(df, key, ts)
    inside, _ = _windows(key, order)
    here = F.struct(*carry)
    at = [F.col(c).alias(f"_t{k}") for k, c in enumerate(order)]
    sliced = _sliced(df, key, ts, width)
    local = sliced.select("*", *[c.alias(n) for n, c in _previous(carry, ts, inside).items()]).withColumn("_cut", _local_break(rule, ts))
    local = local.select(
        *key, SLICE,
        F.sum("_cut").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("_part"),
        F.struct(*at, here.alias("_c")).alias("_head"),
        F.struct(*at, here.alias("_c")).alias("_tail"),
        F.struct(*at, *[e.alias(n) for n, e in first.items()]).alias("_opening"),
        *[e.alias(n) for n, e in least.items()],
        *[e.alias(n) for n, e in greatest.items()],
        *([F.when(tally[2], F.struct(tally[1].alias("value"))).alias("_tallied")] if tally else []),
    )
    merge = [
        F.min("_opening").alias("_opening"),
        *[F.min(n).alias(n) for n in least],
        *[F.max(n).alias(n) for n in greatest],
    ]
    ends = [F.min("_head").alias("_head"), F.max("_tail").alias("_tail")]
    lists = [F.collect_list("_tallied").alias("_tallied")] if tally else []
    fragments = local.groupBy(*key, SLICE, "_part").agg(*merge, *ends, *lists)
    if tally:
        fragments = fragments.withColumn(tally[0], value_counts(F.col("_tallied"))).drop("_tallied")

    along = Window.partitionBy(*key).orderBy("_head")
    fragments = fragments.withColumn("_before", F.lag("_tail._c").over(along))
    edge = F.when(F.col("_before").isNull(), F.lit(0).cast("long")).otherwise(
        _true(rule(_field("_before"), _field("_head._c")))
    )
    fragments = fragments.withColumn("_edge", edge).withColumn(
        name, F.sum("_edge").over(along.rowsBetween(Window.unboundedPreceding, 0)) + F.lit(start)
    )
    if tally:
        lists = [F.flatten(F.collect_list(tally[0])).alias(tally[0])]
    merged = fragments.groupBy(*key, name).agg(*merge, *lists)
    return merged.select(
        *key, name,
        *[F.col(f"_opening.{n}").alias(n) for n in first],
        *least, *greatest, *([tally[0]] if tally else []),
    )


def track_freq(df: DataFrame, key: Sequence[str] = ("ship",), ts: str = "dt_pos_utc", limit: int = 3600) -> DataFrame:
    """Hours since the ship's previous row as ``freq``; rows without one within ``limit`` seconds go."""
    found = lag_within(df, key, {"_prev_ts": ts}, limit, ts)
    return (
        found.withColumn("freq", gap_seconds(ts, "_prev_ts") / F.lit(3600.0))
        .filter(F.col("freq").isNotNull())
        .drop("_prev_ts")
    )


def interpolate_track(
    df: DataFrame,
    key: Sequence[str] = ("ship",),
    ts: str = "dt_pos_utc",
    step: int = 600,
    max_gap: int = 7200,
    cols: Sequence[str] = ("latitude", "longitude"),
) -> DataFrame:
    """Insert linearly interpolated rows every ``step`` seconds into gaps up to ``max_gap``."""
    nxt = {f"_n_{c}": c for c in cols} | {"_n_ts": ts}
    found = lag_within(df.select(*key, ts, *cols), key, nxt, max_gap, ts, ahead=True)
    gap = gap_seconds("_n_ts", ts)
    last = F.coalesce(F.floor((gap - 1) / F.lit(float(step))), F.lit(0)).cast("int")
    steps = found.withColumn("_gap", gap).withColumn("_k", F.explode(F.sequence(F.lit(0), F.greatest(last, F.lit(0)))))
    share = F.when(F.col("_k") == 0, F.lit(0.0)).otherwise(F.col("_k") * F.lit(float(step)) / F.col("_gap"))
    return steps.select(
        *key,
        F.when(F.col("_k") == 0, F.col(ts)).otherwise(F.timestamp_seconds(seconds(ts) + F.col("_k") * step)).alias(ts),
        *[
            F.when(F.col("_k") == 0, F.col(c)).otherwise(F.col(c) + (F.col(f"_n_{c}") - F.col(c)) * share).alias(c)
            for c in cols
        ],
        (F.col("_k") > 0).alias("interpolated"),
    )


def merge_overlaps(
    df: DataFrame, key: Sequence[str], start: str, end: str, least: Sequence[str] = (), greatest: Sequence[str] = ()
) -> DataFrame:
    """Coalesce overlapping [start, end] intervals of the same key, nulls being a key value.

    Input rows are finished events (transits, calls), a few per ship and day.
    """
    order = Window.partitionBy(*key).orderBy(start, end)
    seen = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    flagged = df.withColumn("_seen", seen)
    flagged = flagged.withColumn("_new", F.when(F.col(start) <= F.col("_seen"), 0).otherwise(1))
    grouped = flagged.withColumn("_grp", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy(*key, "_grp").agg(
        F.min(start).alias(start), F.max(end).alias(end),
        *[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in greatest],
    ).drop("_grp")
