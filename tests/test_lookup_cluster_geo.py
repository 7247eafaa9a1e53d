import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.functions import cells, polygons
from tidemark.operators import cluster, components, geo, specs
from tidemark.operators.lookup import lookup_join


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_growing_lookups_join_alike_without_a_broadcast(spark, frame, how):
    large = frame("k long, v long", [(1, i) for i in range(200)] + [(2, 1), (3, 2)])
    small = frame("k long, w long", [(1, 10), (3, 30), (3, 31)])
    cols = ("k", "v", "w") if how in ("inner", "left") else ("k", "v")
    grown = lookup_join(large, small, ["k"], how, grows=True)
    assert "Broadcast" not in grown._jdf.queryExecution().executedPlan().toString()
    assert rows_of(grown, *cols) == rows_of(lookup_join(large, small, ["k"], how), *cols)


def test_exploded_sides_are_not_broadcast(spark, frame):
    points = frame("latitude double, longitude double, mmsi long, dt_pos_utc timestamp", [(1.0, 1.0, 1, 0)])
    huge = "POLYGON ((-170 -80, 170 -80, 170 80, -170 80, -170 -80))"
    parsed = geo.parse_wkt(frame("Name string, TERRITORY1 string, WKT_geom string", [("z", "x", huge)]))
    plan = geo.points_in_zone(points, parsed, 0.005)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_open_ended_versions_stay_small(spark):
    versions = spark.sql("SELECT TIMESTAMP'2020-01-01' AS from_date, TIMESTAMP'9999-12-31 23:59:59' AS to_date, 'A' AS version")
    rows = spark.sql("SELECT 1L AS mmsi, TIMESTAMP'2024-05-05 10:00:00' AS dt_pos_utc UNION ALL SELECT 2L, TIMESTAMP'2019-12-31 23:59:59'")
    assert rows_of(specs.version_join(rows, versions), "mmsi", "version") == [(1, "A"), (2, None)]
    assert specs.version_rows(versions).count() == 7980


def test_newest_version_goes_by_date_not_by_text(frame):
    versions = frame("from_date timestamp, to_date timestamp, version string", [(0, 9, "9"), (10, 19, "10")])
    rows = frame("mmsi long, version string, length double", [(1, "9", 9.0), (1, "10", 10.0), (2, "9", 1.0), (3, "x", 5.0)])
    assert rows_of(specs.latest_specs(rows, ("length",), versions), "mmsi", "length") == [(1, 10.0), (2, 1.0), (3, 5.0)]


def brute(points, eps):
    """Labels by the definition: core points, connected cores, borders to the lowest cluster."""
    near = [[j for j, q in enumerate(points) if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= eps * eps] for p in points]
    core = [len(n) >= 3 for n in near]
    label, n = {}, 0
    for i in range(len(points)):
        if core[i] and i not in label:
            stack = [i]
            while stack:
                a = stack.pop()
                if a not in label:
                    label[a] = n
                    stack += [b for b in near[a] if core[b]]
            n += 1
    return [label.get(i, min((label[j] for j in near[i] if core[j]), default=-1)) for i in range(len(points))]


def random_points(seed):
    rng = random.Random(seed)
    points = [(rng.uniform(0, 12), rng.uniform(0, 12)) for _ in range(60)]
    hub = (rng.uniform(2, 8), rng.uniform(2, 8))
    points += [(hub[0] + rng.gauss(0, 0.5), hub[1] + rng.gauss(0, 0.5)) for _ in range(60)]
    points += [(1.0 + 0.9 * i, 11.0) for i in range(10)] + [hub] * 20
    rng.shuffle(points)
    return points


def test_dbscan_equals_brute_force(frame):
    data = {1: random_points(1), 2: random_points(2)}
    rows = [(k, i, x, y, 1.0) for k, pts in data.items() for i, (x, y) in enumerate(pts)]
    df = frame("ship long, o long, longitude double, latitude double, eps double", rows)
    got = {(r["ship"], r["o"]): r["cluster"] for r in cluster.dbscan(df, ["ship"], "o").collect()}
    assert got == {(k, i): c for k, pts in data.items() for i, c in enumerate(brute(pts, 1.0))}


def test_dbscan_without_broadcasts(frame, no_broadcast):
    pts = random_points(3)
    df = frame("ship long, o long, longitude double, latitude double, eps double",
               [(1, i, x, y, 1.0) for i, (x, y) in enumerate(pts)])
    got = {r["o"]: r["cluster"] for r in cluster.dbscan(df, ["ship"], "o").collect()}
    assert got == dict(enumerate(brute(pts, 1.0)))


def test_components_of_a_chain_and_a_star(frame):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)]
    got = dict(rows_of(components.components(frame("u long, v long", edges)), "node", "component"))
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(40)}}


def test_polyfill_and_points_agree(spark, frame):
    shape = "POLYGON ((0 0, 4 0, 4 4, 2 1, 0 4, 0 0), (0.5 0.5, 1.0 0.5, 1.0 1.0, 0.5 1.0, 0.5 0.5))"
    parsed = geo.parse_wkt(frame("Name string, TERRITORY1 string, WKT_geom string", [("z", "x", shape)]))
    filled = geo.polyfill(parsed, 0.25)
    lat, lon = cells.grid_centre(F.col("cell"), 0.25)
    every = spark.range(0, 20 * 20).select(
        ((F.floor(F.col("id") / 20) - 1) * 0.25 + 0.125).alias("latitude"), ((F.col("id") % 20 - 1) * 0.25 + 0.125).alias("longitude"),
    )
    found = geo.points_in_zone(every, parsed, 0.7)
    assert rows_of(found, "latitude", "longitude") == rows_of(
        filled.select(lat.alias("latitude"), lon.alias("longitude")), "latitude", "longitude")
    assert found.count() > 50


def test_points_of_one_cell_are_dealt_over_tasks(frame, monkeypatch):
    monkeypatch.setattr(geo, "PAIRS", 100, raising=False)
    shapes = [(f"z{k}", "x", f"POLYGON ((0 0, {0.1 + 0.01 * k} 0, {0.1 + 0.01 * k} 0.9, 0 0.9, 0 0))") for k in range(40)]
    parsed = geo.parse_wkt(frame("Name string, TERRITORY1 string, WKT_geom string", shapes + [("all", "x", "POLYGON ((-9 -9, 9 -9, 9 9, -9 9, -9 -9))")]))
    rows = [(i, 0.5, 0.001 * i) for i in range(1, 600)] + [(1000, None, 0.1), (1001, 0.5, None), (1002, float("nan"), 0.1), (1003, -0.5, 360.1)]
    found = geo.points_in_zone(frame("id long, latitude double, longitude double", rows), parsed, 1.0)
    want = [(i, f"z{k}") for i, y, x in rows[:599] for k in range(40) if x < 0.1 + 0.01 * k] + [(i, "all") for i in range(1, 600)]
    assert rows_of(found, "id", "Name") == sorted(want)
    assert found.select(F.spark_partition_id()).distinct().count() > 1


def test_cell_ids(frame):
    ident = int("8a2a1072b59ffff", 16)
    row = frame("c long", [(ident,)]).select(
        cells.cell_text(F.col("c")).alias("t"), cells.cell_parent(F.col("c"), 5).alias("p"),
        cells.cell_parent(F.col("c"), 12).alias("finer"), cells.cell_resolution(F.col("c")).alias("r"),
        cells.cell_number(cells.cell_text(F.col("c"))).alias("n"),
    ).first()
    assert (row["t"], f"{row['p']:x}", row["finer"], row["r"], row["n"]) == ("8a2a1072b59ffff", "852a1073fffffff", None, 10, ident)


def test_near_cells_are_the_occupied_ones_within_reach(frame):
    cells = {(ship, x, y) for ship in (1, 2) for x, y in [(-9, -9), (-8, -7), (0, 0), (2, -2), (3, 0), (7, 7), (8, 9), (10, 9), (500, 500)]} - {(2, 0, 0)}
    near = cluster._near_cells(frame("ship long, cx long, cy long", sorted(cells) * 2), ["ship"])
    want = sorted((s, a, b, x, y) for s, a, b in cells for t, x, y in cells if s == t and abs(a - x) <= cluster.REACH and abs(b - y) <= cluster.REACH)
    assert rows_of(near, "ship", "hx", "hy", "cx", "cy") == want


def test_few_edges_are_tested_like_many(frame):
    """The test in generated code agrees with the one over the whole list, also on vertices, level edges and odd values."""
    nan, inf = float("nan"), float("inf")
    shapes = [[], [(0, 0, 1, 1)], [(0, 1, 1, 0), (1, 0, 0, 0)], [(0, 0, 2, 0), (2, 0, 1, 2), (1, 2, 0, 0)], [(0, 0, 2, 0), (2, 0, 2, 2), (2, 2, 0, 2), (0, 2, 0, 0)],
              [(0, 0, nan, 1)], [(None, 0, 1, 1)], [(0, 0, 1, 1), (0, 0, 1, None)]]
    edge = "struct<x1:double,y1:double,x2:double,y2:double>"
    values = ["array(" + ", ".join("struct(" + ", ".join("cast('%s' as double)" % v if v is not None else "cast(null as double)" for v in e) + ")" for e in s) + ")"
              for s in shapes]
    spots = frame("x double, y double", [(x, y) for x in (-1.0, 0.0, 0.5, 1.0, 2.0, nan, inf, None) for y in (-1.0, 0.0, 0.5, 1.0, 2.0, nan, None)])
    every = None
    for v in values:
        one = spots.select("x", "y", F.expr(f"cast({v} as array<{edge}>)").alias("edges"))
        every = one if every is None else every.union(one)
    found = every.select(polygons.contains_few(F.col("edges"), F.col("x"), F.col("y")).alias("a"), polygons.contains(F.col("edges"), F.col("x"), F.col("y")).alias("b"))
    rows = found.collect()
    assert len(rows) == 448 and all(r.a == r.b for r in rows) and {True, False} <= {r.a for r in rows}
