"""Polygons as arrays of (x, y) vertices, handled with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wkt_rings(wkt: Column | str) -> Column:
    """Rings of a WKT POLYGON or MULTIPOLYGON: array of arrays of struct(x, y)."""
    col = F.col(wkt) if isinstance(wkt, str) else wkt
    rings = F.regexp_extract_all(col, F.lit(r"\(([^()]+)\)"), F.lit(1))

    def vertex(text: Column) -> Column:
        xy = F.split(F.trim(text), r"\s+")
        return F.struct(xy[0].cast("double").alias("x"), xy[1].cast("double").alias("y"))

    return F.transform(rings, lambda ring: F.transform(F.split(ring, ","), vertex))


def ring_edges(rings: Column) -> Column:
    """All edges of all rings as array of struct(x1, y1, x2, y2)."""
    def edges(ring: Column) -> Column:
        starts = F.slice(ring, F.lit(1), F.size(ring) - 1)
        ends = F.slice(ring, F.lit(2), F.size(ring) - 1)
        return F.zip_with(
            starts, ends,
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
        )
    return F.flatten(F.transform(rings, edges))


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Does a ray to the right from (x, y) cross the edge?"""
    spans = (e["y1"] > y) != (e["y2"] > y)
    at = (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
    return F.when(spans, x < at).otherwise(F.lit(False))


def contains(edges: Column, x: Column, y: Column) -> Column:
    """Even-odd ray cast: is (x, y) inside the polygon with these edges?"""
    hits = F.aggregate(edges, F.lit(0), lambda n, e: n + _crosses(e, x, y).cast("int"))
    return hits % 2 == 1


def contains_few(edges: Column, x: Column, y: Column, few: int = 3) -> Column:
    """:func:`contains` for edges that are mostly no more than ``few``: those are tested in generated code, without a lambda function."""
    hits = sum((_crosses(F.get(edges, F.lit(k)), x, y).cast("int") for k in range(few)), F.lit(0))
    return F.when(F.size(edges) <= few, hits % 2 == 1).otherwise(contains(edges, x, y))


def bounds(rings: Column) -> Column:
    """struct(x0, x1, y0, y1) around all vertices."""
    points = F.flatten(rings)
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"),
        F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"),
    )
