"""Sliced track operators against brute force over whole tracks."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import tracks

WIDTH = 1000  # narrow slices, so that tracks cross many borders


@pytest.fixture(scope="module")
def track():
    rng = random.Random(7)
    rows = []
    for ship in (1, 2, 3):
        t = rng.randrange(500)
        for _ in range(120 if ship == 1 else 25):
            rows.append((ship, t, rng.choice("ABC"), rng.choice([None, 1, 2])))
            t += rng.choice([1, 7, 60, 400, 999, 1000, 1001, 2500])
    rng.shuffle(rows)
    return rows


@pytest.fixture
def df(frame, track):
    return frame("ship long, dt_pos_utc timestamp, Name string, v long", track)


def by_ship(track):
    out = {}
    for row in sorted(track):
        out.setdefault(row[0], []).append(row)
    return out.values()


def test_lag_and_rownum_cross_slices(df, track):
    want = sorted(
        (r[0], r[1], i + 1, rows[i - 1][2] if i else "-", rows[i - 1][1] if i else -1)
        for rows in by_ship(track) for i, r in enumerate(rows)
    )
    lagged = tracks.track_lag(df, ["ship"], {"before": "Name", "at": "dt_pos_utc"}, width=WIDTH)
    both = tracks.track_rownum(lagged, ["ship"], width=WIDTH)
    got = [(a, b, c, d or "-", -1 if e is None else e) for a, b, c, d, e in
           rows_of(both, "ship", "dt_pos_utc", "row", "before", "at")]
    assert sorted(got) == want


def test_number_groups_and_islands(df, track):
    rule = lambda prev, cur: (cur("Name") != prev("Name")) | (
        F.unix_timestamp(cur("dt_pos_utc")) - F.unix_timestamp(prev("dt_pos_utc")) >= 1000)
    want, spans = [], {}
    for rows in by_ship(track):
        n = 5
        for i, r in enumerate(rows):
            if i and (r[2] != rows[i - 1][2] or r[1] - rows[i - 1][1] >= 1000):
                n += 1
            want.append((r[0], r[1], n))
            lo, hi, name, counts = spans.get((r[0], n), (r[1], r[1], r[2], {}))
            counts[r[3]] = counts.get(r[3], 0) + 1
            spans[r[0], n] = (min(lo, r[1]), max(hi, r[1]), name, counts)
    numbered = tracks.number_groups(df, ["ship"], ["dt_pos_utc", "Name"], {"g": rule}, start=5, width=WIDTH)
    assert rows_of(numbered, "ship", "dt_pos_utc", "g") == sorted(want)

    found = tracks.islands(
        df, ["ship"], ["dt_pos_utc", "Name"], rule, "g", start=5, width=WIDTH, first={"name": F.col("Name")},
        least={"lo": F.col("dt_pos_utc")}, greatest={"hi": F.col("dt_pos_utc")},
        tally=("counts", F.col("v"), F.lit(True)),
    )
    got = {}
    for r in found.collect():
        counts = {}
        for e in r["counts"]:
            counts[e["value"]] = counts.get(e["value"], 0) + e["n"]
        got[r["ship"], r["g"]] = (r["name"], counts)
    assert got == {k: (v[2], v[3]) for k, v in spans.items()}
    assert rows_of(found, "ship", "g", "lo", "hi") == sorted((*k, v[0], v[1]) for k, v in spans.items())


@pytest.mark.parametrize("limit", [60, 999, 1000])
def test_lag_within_is_exact_at_the_limit(df, track, limit):
    want = []
    for rows in by_ship(track):
        for i, r in enumerate(rows):
            near = i > 0 and r[1] - rows[i - 1][1] <= limit
            want.append((r[0], r[1], rows[i - 1][2] if near else None))
    got = tracks.lag_within(df, ["ship"], {"before": "Name"}, limit, width=WIDTH)
    assert rows_of(got, "ship", "dt_pos_utc", "before") == sorted(want, key=lambda t: t[:2])


def test_lag_within_rejects_a_limit_beyond_the_slice(df):
    with pytest.raises(ValueError):
        tracks.lag_within(df, ["ship"], {"before": "Name"}, WIDTH + 1, width=WIDTH)


def test_fill_forward(df, track):
    want = []
    for rows in by_ship(track):
        last = None
        for r in rows:
            last = r[3] if r[3] is not None else last
            want.append((r[0], r[1], last))
    got = tracks.fill_forward(df, ["ship"], "v", "last", width=WIDTH)
    assert rows_of(got, "ship", "dt_pos_utc", "last") == sorted(want, key=lambda t: t[:2])


def test_slice_width_and_partitions_do_not_change_results(df):
    rule = lambda prev, cur: cur("Name") != prev("Name")
    wide = tracks.number_groups(df, ["ship"], ["Name"], {"g": rule})
    narrow = tracks.number_groups(df.repartition(7), ["ship"], ["Name"], {"g": rule}, width=13)
    assert rows_of(wide, "ship", "dt_pos_utc", "g") == rows_of(narrow, "ship", "dt_pos_utc", "g")


def test_dedup_keeps_the_least_row(frame):
    df = frame("ship long, dt_pos_utc timestamp, event_id long, sog double",
               [(1, 5, 9, 1.0), (1, 5, 3, 2.0), (1, 6, 4, 3.0), (2, 5, 1, 4.0)])
    got = tracks.dedup_positions(df, ["ship"], tie=["event_id"])
    assert rows_of(got, "ship", "dt_pos_utc", "event_id", "sog") == [(1, 5, 3, 2.0), (1, 6, 4, 3.0), (2, 5, 1, 4.0)]


def test_interpolation_leaves_long_gaps(frame):
    df = frame("ship long, dt_pos_utc timestamp, latitude double, longitude double",
               [(1, 0, 0.0, 0.0), (1, 1800, 3.0, 6.0), (1, 1800 + 7201, 9.0, 9.0)])
    got = tracks.interpolate_track(df)
    assert rows_of(got, "dt_pos_utc", "latitude", "longitude", "interpolated") == [
        (0, 0.0, 0.0, False), (600, 1.0, 2.0, True), (1200, 2.0, 4.0, True), (1800, 3.0, 6.0, False),
        (9001, 9.0, 9.0, False),
    ]


def test_merge_overlaps_uses_the_running_end(frame):
    df = frame("k long, a long, b long", [(1, 0, 100), (1, 10, 20), (1, 50, 60), (1, 101, 110), (None, 0, 1), (None, 1, 2)])
    got = tracks.merge_overlaps(df, ["k"], "a", "b")
    assert rows_of(got, "k", "a", "b") == [(1, 0, 100), (1, 101, 110), (None, 0, 2)]


def test_rows_of_the_same_second_all_count_in_a_total_order(frame):
    rng = random.Random(9)
    rows = [(1, rng.randrange(40) * 20000, k, rng.choice("AB")) for k in range(300)]
    df = frame("ship long, dt_pos_utc timestamp, event_id long, Name string", rows)
    changes = lambda prev, cur: prev("Name") != cur("Name")
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    want, group = [], 0
    for k, row in enumerate(ordered):
        group += k > 0 and ordered[k - 1][3] != row[3]
        want.append((row[2], group))
    for data in (df, df.repartition(7, "event_id")):
        assert rows_of(tracks.number_groups(data, ["ship"], ["Name"], {"g": changes}), "event_id", "g") == sorted(want)
        assert rows_of(tracks.track_rownum(data, ["ship"]), "event_id", "row") == sorted((r[2], k + 1) for k, r in enumerate(ordered))
        lagged = rows_of(tracks.track_lag(data, ["ship"], {"before": "event_id"}), "event_id", "before")
        assert [r for r in lagged if r[1] is not None] == sorted((b[2], a[2]) for a, b in zip(ordered, ordered[1:]))
        found = tracks.islands(data, ["ship"], ["Name"], changes, "g", least={"low": F.col("event_id")}, first={"head": F.col("event_id")})
        heads = {g: next(e for e, x in want if x == g) for _, g in want}
        lows = {g: min(e for e, x in want if x == g) for _, g in want}
        assert rows_of(found, "g", "head", "low") == sorted((g, heads[g], lows[g]) for g in heads)


def test_prefix_scans_read_their_input_once(spark, frame, tmp_path):
    """Slices and what they hand on use one scan and one shuffle by (ship, slice)."""
    week = 7 * 86400
    rows = [(s, i, i * 40000 + s, None if i % 3 else f"z{i % 4}") for s in range(5) for i in range(60)]
    frame("ship long, event_id long, dt_pos_utc timestamp, Name string", rows).repartition(3).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    far = lambda prev, cur: prev("Name").eqNullSafe(cur("Name")) == False  # noqa: E731, E712
    made = {
        "lag": tracks.track_lag(df, ["ship"], {"before": "event_id"}),
        "number": tracks.track_rownum(df, ["ship"]),
        "groups": tracks.number_groups(df, ["ship"], ["Name"], {"island": far}),
        "filled": tracks.fill_forward(df, ["ship"], "Name", "last_name"),
    }
    assert max(r[2] for r in rows) > 3 * week
    for name, found in made.items():
        assert found.count() == len(rows)
        found = found.select("ship", found.columns[-1])
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") == 1 and "ReusedExchange" in plan, name
