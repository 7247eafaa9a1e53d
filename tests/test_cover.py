"""Quad cells and polygon covers against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions import cells
from tidemark.operators import cover, geo
from tidemark.plans import jobs

STAR = [(math.cos(k * math.pi / 9) * (1 if k % 2 else 0.4), math.sin(k * math.pi / 9) * (1 if k % 2 else 0.4)) for k in range(18)]
SHAPES = {
    "star": [[(-79.5 + 0.31 * x, 9.0 + 0.27 * y) for x, y in STAR]],
    "holed": [[(-80, 8.5), (-79, 8.5), (-79, 9.5), (-80, 9.5)], [(-79.7, 8.8), (-79.2, 8.8), (-79.2, 9.1), (-79.7, 9.1)]],
    "on the grid": [[(-78.75, 8.4375), (-78.046875, 8.4375), (-78.046875, 9.140625), (-78.75, 9.140625)]],
    "sliver": [[(-80.2, 8.1), (-78.2, 9.9), (-78.2, 9.9001)]],
    "tiny": [[(-79.50001, 9.00001), (-79.5, 9.00001), (-79.5, 9.0)]],
    "two": [[(-79.9, 9.6), (-79.8, 9.6), (-79.85, 9.7)], [(-78.9, 8.2), (-78.8, 8.2), (-78.85, 8.3)]],
}


def wkt(rings):
    return "MULTIPOLYGON ((" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in [*r, r[0]]) + ")" for r in rings) + "))"


def inside(rings, x, y):
    hits = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            hits += (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
    return hits % 2 == 1


@pytest.fixture
def parsed(frame):
    rows = [(name, "x", wkt(rings)) for name, rings in SHAPES.items()] + [("none", "x", None), ("empty", "x", "POLYGON EMPTY")]
    return geo.parse_wkt(frame("Name string, TERRITORY1 string, WKT_geom string", rows)).drop("TERRITORY1")


@pytest.fixture
def points(frame):
    rng = random.Random(3)
    spots = [(rng.uniform(8, 10), rng.uniform(-80.5, -78)) for _ in range(3000)]
    spots += [(y + dy, x + dx) for rings in SHAPES.values() for r in rings for x, y in r for dx in (-1e-6, 0, 1e-6) for dy in (-1e-6, 0, 1e-6)]
    spots += [(None, -79.0), (9.0, None), (-89.0, 179.9), (9.0, 181.0)]
    return [(k, *p) for k, p in enumerate(spots)]


@pytest.mark.parametrize("finest, rounds, pivot", [(13, 8, 2), (11, 3, 0), (9, 9, 4)])
def test_points_in_covers_equal_the_polygons(frame, parsed, points, finest, rounds, pivot):
    df = frame("event_id long, latitude double, longitude double", points)
    want = sorted((k, n) for k, y, x in points if None not in (x, y) for n, rings in SHAPES.items() if inside(rings, x, y))
    made = cover.polygon_cover(parsed, finest, rounds)
    assert rows_of(cover.points_in_cover(df, made, finest, pivot=pivot), "event_id", "Name") == want
    least = {}
    for k, n in want:
        least[k] = min(n, least.get(k, n))
    assert rows_of(cover.zone_tag_polygons(df, made, finest=finest, pivot=pivot), "event_id", "Name") == sorted(least.items())
    left = rows_of(cover.zone_tag_polygons(df, made, "left", finest, pivot=pivot), "event_id", "Name")
    assert dict(left) == {k: least.get(k) for k, *_ in points} and len(left) == len(points)


def test_rows_follow_the_outline_and_inner_cells_have_no_edges(parsed):
    counts = {}
    for finest in (11, 13, 14, 15):
        rows = cover.polygon_cover(parsed.filter("Name = 'holed'"), finest, 9).collect()
        counts[finest] = len(rows)
        assert len({r.cell for r in rows}) == len(rows)
        assert all((not r.edges) == r.inner for r in rows) and (finest < 13 or any(r.inner and r.level < finest - 1 for r in rows))
        # No cell of a cover lies in another one.
        kept = {r.cell for r in rows}
        assert not any(r.cell >> 2 * up in kept for r in rows for up in range(1, r.level))
    assert counts[15] < 2.5 * counts[14] < 7 * counts[13], counts


def test_parents_and_neighbours_of_quad_cells(frame, points):
    df = frame("event_id long, latitude double, longitude double", points).select("latitude", "longitude")
    for level in (0, 1, 7, 17, cells.QUAD_FINEST):
        at = df.select("*", cells.quad_cell(F.col("latitude"), F.col("longitude"), level).alias("cell")).filter("cell is not null")
        row, col = cells.quad_row_col(F.col("cell"))
        found = at.select(
            "*", row.alias("r"), col.alias("c"), cells.quad_level(F.col("cell")).alias("level"),
            cells.quad_parent(F.col("cell"), max(0, level - 3)).alias("up"), cells.quad_neighbours(F.col("cell")).alias("around")).collect()
        side = 360 / 2**level
        encode = lambda r, c: int("1" + "".join(f"{r >> k & 1}{c >> k & 1}" for k in reversed(range(level))), 2)  # noqa: E731, B023
        for x in found:
            assert (x.level, x.r, x.c) == (level, int((x.latitude + 180) // side), int((x.longitude + 180) // side))
            assert x.cell == encode(x.r, x.c) and x.up == x.cell >> 2 * min(3, level)
            n = 2**level
            near = {encode(x.r + a, (x.c + b) % n) for a in (-1, 0, 1) for b in (-1, 0, 1) if 0 <= x.r + a < n} - {x.cell}
            assert x.around == sorted(near)


def test_jobs_take_polygons(frame):
    zones = frame("Name string, H3_int_index_10 long", [("Gatun Locks", 1), ("Pacific Anchorage", 2)])
    squares = [("Gatun Locks", "x", wkt([[(-80, 9), (-79.9, 9), (-79.9, 9.1), (-80, 9.1)]])),
               ("Pacific Anchorage", "x", wkt([[(-79.6, 8.8), (-79.5, 8.8), (-79.5, 8.9), (-79.6, 8.9)]]))]
    parsed = geo.parse_wkt(frame("Name string, TERRITORY1 string, WKT_geom string", squares))
    rows = [(k, 100 + k % 2, 9.05 if k % 3 else 8.85, -79.95 if k % 3 else -79.55, 1 if k % 3 else 2, 60 * k) for k in range(30)]
    rows += [(30 + k, 100, 5.0, 5.0, 3, 60 * k) for k in range(3)]
    positions = frame("event_id long, mmsi long, latitude double, longitude double, H3_int_index_10 long, dt_pos_utc timestamp", rows).select(
        "*", F.lit(9000000).cast("long").alias("imo"), F.lit("SHIP").alias("vessel_name"), F.lit(0.1).alias("sog"), F.lit(9.0).alias("draught"))
    made = cover.Cover(cover.polygon_cover(parsed.drop("TERRITORY1"), 13), 13)
    for job in (jobs.canal_positions, jobs.port_positions):
        by_cell, by_polygon = (rows_of(job(positions, z, ("event_id",)), "event_id", "Name") for z in (zones, made))
        assert by_cell == by_polygon and len(by_cell) >= 30


def test_a_cover_of_least_names_stays_small_under_many_polygons(frame, points):
    rng = random.Random(5)
    shapes = {f"zone {k}": [[(x, y), (x + w, y), (x + w, y + h / 2), (x + w / 2, y + h), (x, y + h)]] for k, (x, y, w, h) in enumerate(
        (rng.uniform(-80, -79), rng.uniform(8.5, 9.5), rng.uniform(0.05, 0.9), rng.uniform(0.05, 0.9)) for _ in range(200))}
    rows = [(name, wkt(rings)) for name, rings in shapes.items()] + [(None, wkt([[(-80.4, 8), (-78.9, 8), (-78.9, 10), (-80.4, 10)]])), ("zone 7", wkt(shapes["zone 7"]))]
    parsed = geo.parse_wkt(frame("Name string, WKT_geom string", rows))
    whole, least = cover.polygon_cover(parsed, 12), cover.polygon_cover(parsed, 12, least="Name")
    assert least.count() * 4 < whole.count()
    df = frame("event_id long, latitude double, longitude double", points)
    want = {k: min((n for n, rings in shapes.items() if inside(rings, x, y)), default=None) for k, y, x in points if None not in (x, y)}
    for made in (whole, least):
        assert dict(rows_of(cover.zone_tag_polygons(df, made, "left", 12), "event_id", "Name")) == {k: want.get(k) for k, *_ in points}
        found = rows_of(cover.zone_tag_polygons(df, made, finest=12), "event_id", "Name")
        assert found == rows_of(cover.zone_tag_polygons(df, whole, finest=12), "event_id", "Name")
        assert any(n is None for _, n in found)


def test_batches_of_names_give_the_same_and_begin_with_few_cells(frame, points, monkeypatch):
    rng = random.Random(6)
    shapes = {f"zone {k}": [[(x, y), (x + w, y), (x + w, y + h / 2), (x + w / 2, y + h), (x, y + h)]] for k, (x, y, w, h) in enumerate(
        (rng.uniform(-80, -79), rng.uniform(8.5, 9.5), rng.uniform(0.05, 0.9), rng.uniform(0.05, 0.9)) for _ in range(200))}
    big, inner = [[(-81.5, 7.5), (-77.5, 7.5), (-77.5, 11), (-81.5, 11)]], [[(-80, 9), (-79, 9), (-79, 9.5)]]
    rows = [(name, wkt(rings)) for name, rings in shapes.items()] + [("zone 0x", wkt(big)), (None, wkt(inner)), ("zone 7", wkt(shapes["zone 7"])), ("zone 9", None)]
    parsed = geo.parse_wkt(frame("Name string, WKT_geom string", rows))
    df = frame("event_id long, latitude double, longitude double", points + [(k + len(points), 9.0, -79.4) for k in range(300)])
    want = sorted(rows_of(cover.zone_tag_polygons(df, cover.polygon_cover(parsed, 12, least="Name"), "left", 12), "event_id", "Name"), key=str)
    monkeypatch.setattr(cover, "BATCH", 8)
    monkeypatch.setattr(cover, "GROWTH", 4)
    monkeypatch.setattr(cover, "PAIRS", 50)
    borders = cover._borders(parsed, "Name")
    assert 1 < len(borders) < 5 and borders == sorted(borders)
    begun = []
    whole = cover._split
    monkeypatch.setattr(cover, "_split", lambda rows, *rest: begun.append(whole(rows, *rest)) or begun[-1])
    made = cover.polygon_cover(parsed, 12, least="Name")
    assert sorted(rows_of(cover.zone_tag_polygons(df, made, "left", 12), "event_id", "Name"), key=str) == want
    # The large polygon of the first batch rules out all of the last one.
    assert len(begun) == len(borders) + 1 and begun[-1].count() == 0
