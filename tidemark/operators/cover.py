"""Polygons as quad cells of mixed size: large cells inside, small ones along the outline.

A cell is split while the outline touches it, down to the ``finest`` level. Cells that no edge touches lie wholly
inside (kept, no point in them is tested any more) or wholly outside (dropped), so the number of rows
follows the length of the outline and not the area. A border cell keeps the edges that its points need:

* an edge left of the cell, above or below it cannot cut a ray to the right that starts in the cell;
* an edge right of the cell that spans its whole height cuts every such ray: it only turns ``flip``;
* all others are kept.

Even-odd over the kept edges, turned by ``flip``, is then the same test as over all edges. Splitting is an explode
per level, without shuffles; rows are spread over tasks once, so that a huge polygon is not one task.

Where only the least name of a point is wanted, a polygon that fills a cell rules out all others with greater names
there. A cover made for that (``least``) drops them level by level, before they are split, so that many polygons over one
area cost little more than a few; the one row of each cell and level that is compared with the others is its least filled name.
Many polygons are taken in batches of rising names: what earlier batches fill, put together to larger cells, rules most of a later one
out before its outlines are looked at.

Null or empty polygons have no cells. Points without coordinates, or outside -180 <= x < 180, are in no polygon.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cells, polygons
from tidemark.operators.lookup import lookup_join
from tidemark.sources.durable import checkpoint

FINEST = 17
ROUNDS = 8
PIVOT = 2
#: Polygons of the first batch by name, how many times as many follow in the next, and about how many names tell the borders.
BATCH, GROWTH, SAMPLE = 1 << 16, 16, 1 << 13
#: Cells that one task of :func:`zone_tag_polygons` compares with points at once.
PAIRS = 1 << 22
_CELL = ["level", "_row", "_col"]
_SLACK = 1e-9


@dataclass(frozen=True)
class Cover:
    """Rows of :func:`polygon_cover` with a ``Name``, and the level they were made for."""

    cells: DataFrame
    finest: int = FINEST


def _touches(e: Column, box: Column) -> Column:
    """Whether an edge comes within the slack of the box."""
    near = (
        (F.greatest(e["x1"], e["x2"]) >= box["x0"]) & (F.least(e["x1"], e["x2"]) <= box["x1"])
        & (F.greatest(e["y1"], e["y2"]) >= box["y0"]) & (F.least(e["y1"], e["y2"]) <= box["y1"]))
    sides = [
        (e["x2"] - e["x1"]) * (box[y] - e["y1"]) - (e["y2"] - e["y1"]) * (box[x] - e["x1"]) for x in ("x0", "x1") for y in ("y0", "y1")]
    return near & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def _judged(rows: DataFrame) -> DataFrame:
    """Clip the edges of undecided cells, and decide those that no edge touches."""
    return judged(rows, cells.quad_side(F.col("level")), 180.0)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once; a column used in several places would be worked out in each of them."""
    return F.transform(F.array(value), body)[0]


def judged(rows: DataFrame, side: Column, south: float) -> DataFrame:
    """Rows with ``edges``, ``flip``, ``inner`` and a cell (_row, _col) of a width, rows counted from ``south`` degrees south, decided like those of a cover."""
    low, high = (lambda e: F.least(e["y1"], e["y2"])), (lambda e: F.greatest(e["y1"], e["y2"]))
    empty = F.array().cast(rows.schema["edges"].dataType)

    def spans(e: Column, box: Column) -> Column:
        return (F.least(e["x1"], e["x2"]) > box["x1"]) & (low(e) <= box["y0"]) & (high(e) >= box["y1"])

    def reaches(e: Column, box: Column) -> Column:
        return (F.greatest(e["x1"], e["x2"]) >= box["x0"]) & (high(e) >= box["y0"]) & (low(e) <= box["y1"])

    def clipped(box: Column) -> Column:
        turned = F.size(F.filter("edges", lambda e: spans(e, box))) % 2 == 1
        kept = F.filter("edges", lambda e: reaches(e, box) & ~spans(e, box))
        return _let(F.struct(kept.alias("edges"), (F.col("flip") != turned).alias("flip")), lambda c: decided(box, c))

    def decided(box: Column, c: Column) -> Column:
        free = ~F.exists(c["edges"], lambda e: _touches(e, box))
        return _let(F.when(F.col("inner"), True).otherwise(free), lambda inner: F.struct(
            F.when(inner, empty).otherwise(c["edges"]).alias("edges"), F.when(inner, True).otherwise(c["flip"]).alias("flip"), inner.alias("inner"),
            (inner & (polygons.contains(c["edges"], (box["x0"] + box["x1"]) / 2, (box["y0"] + box["y1"]) / 2) == c["flip"])).alias("outside")))

    def edge(step: Column, shift: float, slack: float, name: str) -> Column:
        return (step * side - shift + slack).alias(name)

    box = F.struct(
        edge(F.col("_col"), 180.0, -_SLACK, "x0"), edge(F.col("_col") + 1, 180.0, _SLACK, "x1"),
        edge(F.col("_row"), south, -_SLACK, "y0"), edge(F.col("_row") + 1, south, _SLACK, "y1"))
    rest = [c for c in rows.columns if c not in ("edges", "flip", "inner")]
    found = rows.select(*rest, F.explode(F.filter(F.array(_let(box, clipped)), lambda j: ~j["outside"])).alias("_j"))
    return found.select(*rest, "_j.edges", "_j.flip", "_j.inner")


def _least_only(rows: DataFrame, name: str, cell: list[str], fills: Column, bounds: DataFrame | None = None) -> DataFrame:
    """Rows that can still give a point the least name: none with a greater name than one that fills their cell, and one of those that fill it with that name.

    A null name counts only where no name is known. ``bounds``: names known to fill cells, see :func:`_bounds`.
    """
    filled = rows.filter(fills).select(*cell, F.col(name).alias("_best"))
    best = (filled if bounds is None else filled.union(bounds)).groupBy(*cell).agg(F.min("_best").alias("_best")).filter("_best IS NOT NULL")
    found = lookup_join(rows, best, cell, "left")
    can = F.col("_best").isNull() | F.coalesce(F.col(name) < F.col("_best"), F.lit(False)) | (fills & F.col(name).eqNullSafe(F.col("_best")))
    return found.filter(can).drop("_best")


def _borders(parsed: DataFrame, name: str) -> list:
    """Names at which to divide polygons into batches, from a part of the names; none if they are few."""
    n = parsed.count()
    every = max(1, n // SAMPLE)
    ranks, size = [], BATCH
    while 2 * size < n:
        ranks.append(size)
        size *= GROWTH
    if not ranks:
        return []
    some = parsed.filter(F.col(name).isNotNull() & (F.pmod(F.xxhash64(name), F.lit(every)) == 0)).groupBy(name).count().orderBy(name).collect()
    borders, before = [], 0
    for row in some:
        before += row["count"] * every
        if ranks and before >= ranks[0]:
            borders.append(row[name])
            ranks = [r for r in ranks if r > before]
    return borders


def _bounds(filled: DataFrame, finest: int, top: int) -> DataFrame:
    """(level, _row, _col, _best): for each point of the cell a polygon with that name or a lesser one is known, as one fills it or some fill its quarters."""
    levels, below = [], None
    for level in range(finest, top - 1, -1):
        own = filled.filter(F.col("level") == level).select("_row", "_col", "_best")
        if below is not None:
            up = below.groupBy(F.floor(F.col("_row") / 2).alias("_row"), F.floor(F.col("_col") / 2).alias("_col"))
            own = own.union(up.agg(F.max("_best").alias("_best"), F.count(F.lit(1)).alias("_n")).filter("_n = 4").drop("_n"))
        below = checkpoint(own.groupBy("_row", "_col").agg(F.min("_best").alias("_best")))
        levels.append(below.select(F.lit(level).alias("level"), "_row", "_col", "_best"))
    return reduce(DataFrame.union, levels)


def _bounds_of(rows: DataFrame, bounds: DataFrame, top: int) -> DataFrame:
    """The least bound of each cell of ``rows`` and of the larger cells around it."""
    own = rows.select(*_CELL).distinct().withColumn("_up", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("level") - top))))
    side = F.pow(F.lit(2.0), F.col("_up"))
    around = own.select(*[F.col(c).alias(f"_o{c}") for c in _CELL], (F.col("level") - F.col("_up")).alias("level"),
                        *[F.floor(F.col(c) / side).alias(c) for c in ("_row", "_col")])
    found = lookup_join(around, bounds, _CELL, grows=True)
    return found.groupBy(*[F.col(f"_o{c}").alias(c) for c in _CELL]).agg(F.min("_best").alias("_best"))


def polygon_cover(parsed: DataFrame, finest: int = FINEST, rounds: int = ROUNDS, least: str | None = None) -> DataFrame:
    """One row per polygon and cell of its cover: the columns of ``parsed`` but its box, ``cell``, ``level``, ``inner``, ``edges``, ``flip``.

    ``parsed`` is the result of :func:`geo.parse_wkt`. A polygon begins with the cells of about its own size, at most ``rounds`` levels
    above ``finest``; a larger one begins with more cells. ``least`` names a column of which a point needs the least value only
    (:func:`zone_tag_polygons`): cells of a polygon that cannot give it are left out.
    """
    if least is None:
        rows = _split(parsed, finest, rounds, None, None)
    else:
        parsed = checkpoint(parsed)
        borders, covers, bounds = _borders(parsed, least), [], None
        for k, low in enumerate([None, *borders]):
            above = F.lit(True) if low is None else F.col(least).isNull() | (F.col(least) > F.lit(low))
            upto = F.coalesce(F.col(least) <= F.lit(borders[k]), F.lit(False)) if k < len(borders) else F.lit(True)
            covers.append(checkpoint(_split(parsed.filter(above & upto), finest, rounds, least, bounds)))
            if k < len(borders):
                filled = reduce(DataFrame.union, covers).filter(F.col("inner") & F.col(least).isNotNull())
                bounds = _bounds(filled.select(*_CELL, F.col(least).alias("_best")), finest, max(0, finest - rounds))
        rows = reduce(DataFrame.union, covers)
    return rows.withColumn("cell", cells.quad_id(F.col("_row"), F.col("_col"), F.col("level"))).drop("_row", "_col")


def _split(parsed: DataFrame, finest: int, rounds: int, least: str | None, bounds: DataFrame | None) -> DataFrame:
    """The cells of a cover under their level, row and column; ``bounds``: names that rule out greater ones."""
    width = F.greatest(F.col("box.x1") - F.col("box.x0"), F.col("box.y1") - F.col("box.y0"), F.lit(1e-12))
    start = F.least(F.lit(finest), F.greatest(F.lit(max(0, finest - rounds)), F.floor(F.log2(F.lit(360.0) / width)))).cast("int")
    begun = parsed.filter(F.col("box.x0").isNotNull()).withColumn("level", start)
    last = F.pow(F.lit(2.0), F.col("level")).cast("long") - 1

    def steps(low: str, high: str) -> Column:
        first = F.greatest(F.lit(0), F.least(last, cells.quad_step(F.col(low) - _SLACK, F.col("level"))))
        return F.explode(F.sequence(first, F.greatest(F.lit(0), F.least(last, cells.quad_step(F.col(high) + _SLACK, F.col("level"))))))

    rows = begun.withColumn("_row", steps("box.y0", "box.y1")).withColumn("_col", steps("box.x0", "box.x1"))
    rows = rows.withColumn("flip", F.lit(False)).withColumn("inner", F.lit(False))
    if bounds is not None:
        rows = _least_only(rows, least, _CELL, F.lit(False), _bounds_of(rows, bounds, max(0, finest - rounds)))
    # A number of its own: the work of a row does not show in its bytes.
    rows = rows.repartition(int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_row", "_col", F.hash("box")).drop("box")
    settle = _judged if least is None else lambda rows: _least_only(checkpoint(_judged(rows)), least, _CELL, F.col("inner"), bounds)
    rows = settle(rows)
    for _ in range(min(rounds, finest)):
        split = ~F.col("inner") & (F.col("level") < finest)
        children = F.when(split, F.array(*map(F.lit, range(4)))).otherwise(F.array(F.lit(None).cast("int")))
        rows = rows.withColumn("_child", F.explode(children))
        child = F.col("_child").isNotNull()
        rows = rows.select(
            *[c for c in rows.columns if c not in ("level", "_row", "_col", "_child")],
            (F.col("level") + child.cast("int")).alias("level"),
            F.when(child, F.col("_row") * 2 + F.floor(F.col("_child") / 2)).otherwise(F.col("_row")).alias("_row"),
            F.when(child, F.col("_col") * 2 + F.col("_child") % 2).otherwise(F.col("_col")).alias("_col"))
        rows = settle(rows)
    return rows


def _pivoted(cover: DataFrame, finest: int, pivot: int) -> DataFrame:
    """Cells under the level of ``pivot`` they belong to; larger ones laid out into their descendants of that level."""
    down = F.greatest(F.lit(0), F.lit(finest - pivot) - F.col("level"))
    many = F.call_function("shiftleft", F.lit(1).cast("long"), 2 * down)
    laid = cover.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), many - 1)))
    cell = F.call_function("shiftleft", F.col("cell"), 2 * down) + F.col("_k")
    level = F.col("level") + down
    return laid.select(
        *[c for c in cover.columns if c not in ("cell", "level")], cell.alias("cell"), (F.lit(finest) - level).alias("_up"),
        F.call_function("shiftright", cell, 2 * (level - (finest - pivot))).alias("_pivot"))


def _celled(points: DataFrame, lat: str, lon: str, finest: int, pivot: int) -> DataFrame:
    """Points with their finest cell and its ancestor at the pivot level."""
    celled = points.withColumn("_fine", cells.quad_cell(F.col(lat), F.col(lon), finest))
    return celled.withColumn("_pivot", F.shiftright("_fine", 2 * pivot))


def _holds(c: Column, x: Column, y: Column, fine: Column) -> Column:
    """Whether a cell of the cover holds a point and the polygon does, too."""
    same = F.call_function("shiftright", fine, 2 * c["_up"]) == c["cell"]
    return same & F.when(c["inner"], True).otherwise(polygons.contains(c["edges"], x, y) != c["flip"])


def points_in_cover(
    points: DataFrame, cover: DataFrame, finest: int = FINEST, lat: str = "latitude", lon: str = "longitude", pivot: int = PIVOT,
) -> DataFrame:
    """Points joined with the polygons that contain them; only points in border cells are tested against edges."""
    cell = F.struct("_up", "cell", "inner", "edges", "flip").alias("_c")
    own = ["cell", "_up", "inner", "edges", "flip", "_pivot"]
    pivoted = _pivoted(cover, finest, pivot)
    lookup = pivoted.select("_pivot", *[c for c in pivoted.columns if c not in own], cell)
    joined = lookup_join(_celled(points, lat, lon, finest, pivot), lookup, ["_pivot"], grows=True)
    return joined.filter(_holds(F.col("_c"), F.col(lon), F.col(lat), F.col("_fine"))).drop("_c", "_fine", "_pivot")


def _dealt_join(celled: DataFrame, gathered: DataFrame, how: str) -> DataFrame:
    """Points with the cells of their pivot cell. One with much work is dealt over tasks, as bytes do not tell it, and so are points without one."""
    celled = checkpoint(celled.withColumn("_nth", F.monotonically_increasing_id()))
    counts = celled.groupBy("_pivot").agg(F.count(F.lit(1)).alias("_n"))
    work = lookup_join(counts, gathered.select("_pivot", F.size("_cells").alias("_m")), ["_pivot"], "left", grows=True)
    parts = checkpoint(work.select("_pivot", F.ceil(F.col("_n") * F.coalesce("_m", F.lit(1)) / PAIRS).cast("int").alias("_parts")).filter("_parts > 1"))
    tasks = int(celled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.coalesce("_parts", F.lit(1))
    part = F.pmod("_nth", F.when(F.col("_pivot").isNull(), tasks).otherwise(own)).cast("int")
    dealt = lookup_join(celled, parts, ["_pivot"], "left").withColumn("_part", part).drop("_parts", "_nth")
    copies = lookup_join(gathered, parts, ["_pivot"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), own - 1))).drop("_parts")
    on = ["_pivot", "_part"]
    return lookup_join(dealt.repartition(tasks, *on), copies.repartition(tasks, *on), on, how, grows=True).drop("_part")


def zone_tag_polygons(
    points: DataFrame, cover: DataFrame, how: str = "inner", finest: int = FINEST,
    lat: str = "latitude", lon: str = "longitude", pivot: int = PIVOT,
) -> DataFrame:
    """Add ``Name``, the least of the polygons that contain a point; ``how='left'`` keeps points outside every polygon.

    The cells below a pivot cell are gathered before the join, so that it repeats no point. There are at most 4**pivot of
    them for each polygon that reaches into the pivot cell and whose name is not greater than one that fills that cell, or its own cell there.
    """
    here = F.struct("Name", "_up", "cell", "inner", "edges", "flip")
    pivoted = checkpoint(_pivoted(cover, finest, pivot))
    able = _least_only(pivoted, "Name", ["_pivot"], F.col("inner") & (F.col("_up") >= pivot))
    able = _least_only(able, "Name", ["_up", "cell"], F.col("inner"))
    gathered = checkpoint(able.groupBy("_pivot").agg(F.collect_list(here).alias("_cells")))
    celled = _celled(points, lat, lon, finest, pivot)
    if points.isStreaming:
        joined = lookup_join(celled, gathered, ["_pivot"], how, grows=True)
    else:
        joined = _dealt_join(celled, gathered, how)
    found = F.filter("_cells", lambda c: _holds(c, F.col(lon), F.col(lat), F.col("_fine")))
    tagged = joined.withColumn("Name", F.array_min(F.transform(found, lambda c: c["Name"])))
    return (tagged if how == "left" else tagged.filter(F.size(found) > 0)).drop("_cells", "_fine", "_pivot")
