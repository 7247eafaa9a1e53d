"""Runs that break off, are repeated, overlap or are taken back; events carried over the borders of ranges."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from checks import fixture_view as fx
from checks.compare import canonical
from checks.queries import View
from tests.conftest import HOUR, rows_of
from tidemark.operators import carried, ports, tracks
from tidemark.plans import jobs, runs
from tidemark.sources.durable import checkpoint, scratch_path
from tidemark.sources.manifest import Manifest

SMALL = "/root/testdata/sf0.001"
DAY = 24 * HOUR


def units(frame, *names):
    return frame("unit string", [(n,) for n in names])


def owned(manifest):
    return dict(map(tuple, manifest.owners().collect()))


def test_readers_see_committed_units_once(spark, frame):
    m = Manifest(spark, scratch_path(spark, "m"))
    assert m.read("t", "v long").count() == 0 and owned(m) == {}
    first = m.plan(units(frame, "a", "b", "b"))
    m.store(first, t=frame("unit string, v long", [("a", 1), ("b", 2)]))
    assert m.read("t", "v long").count() == 0
    assert [tuple(r) for r in m.unfinished().collect()] == [(first.name, "stored")]
    m.commit(first)
    m.commit(first)
    assert rows_of(m.read("t", "v long"), "unit", "v") == [("a", 1), ("b", 2)]
    # A later run takes over a unit as a whole, also without rows for it.
    second = m.plan(units(frame, "b", "c"))
    m.store(second, t=frame("unit string, v long", [("c", 5)]))
    assert rows_of(m.pending(units(frame, "a", "b", "c")), "unit") == [("c",)]
    m.commit(second)
    assert rows_of(m.read("t", "v long"), "unit", "v") == [("a", 1), ("c", 5)]
    m.retract(units(frame, "a"))
    assert rows_of(m.read("t", "v long"), "unit") == [("c",)] and rows_of(m.pending(units(frame, "a", "b")), "unit") == [("a",)]
    third = m.plan(units(frame, "a"))
    m.store(third, t=frame("unit string, v long", [("a", 9)]))
    m.commit(third)
    assert rows_of(m.read("t", "v long"), "unit", "v") == [("a", 9), ("c", 5)]
    assert m.unfinished().count() == 0


def test_many_units_need_few_files(spark, frame):
    path = scratch_path(spark, "m")
    m = Manifest(spark, path)
    many = [f"u{k}" for k in range(300)]
    runs = [m.plan(units(frame, *many)), m.plan(units(frame, "u7", "u8")), m.plan(units(frame, "u9"))]
    m.store_many(runs[0], t=frame("unit string, v long", [(u, k) for k, u in enumerate(many)]))
    assert m.read("t", "v long").count() == 0
    m.commit(runs[0])
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) < 20
    # A unit belongs to its last run, however that stored it; u8 has no rows any more.
    m.store(runs[1], t=frame("unit string, v long", [("u7", 1000)]))
    m.store_many(runs[2], t=frame("unit string, v long", [("u9", 2000), ("u9", 2001)]))
    m.commit(runs[1])
    m.commit(runs[2])
    want = [(u, k) for k, u in enumerate(many) if u not in ("u7", "u8", "u9")] + [("u7", 1000), ("u9", 2000), ("u9", 2001)]
    assert rows_of(m.read("t", "v long"), "unit", "v") == sorted(want)


def test_run_names_that_look_like_numbers_stay_text(spark, frame, monkeypatch):
    m = Manifest(spark, scratch_path(spark, "m"))
    monkeypatch.setattr("tidemark.sources.manifest.uuid.uuid4", lambda: type("U", (), {"hex": "00123e45"}))
    run = m.plan(units(frame, "2024-01-01", "007"))
    m.store(run, t=frame("unit string, v long", [("2024-01-01", 1), ("007", 2)]))
    m.commit(run)
    assert rows_of(m.read("t", "v long"), "unit") == [("007",), ("2024-01-01",)]


@pytest.fixture(scope="module")
def view(spark):
    return View(spark, SMALL)


@pytest.mark.parametrize("step", ["plan", "store", "commit"])
def test_emissions_broken_at_any_step_and_repeated_with_other_days(spark, view, monkeypatch, step):
    days = view.positions.select(F.date_format("dt_pos_utc", "yyyy-MM-dd").alias("day")).distinct()
    run = lambda part, path: runs.run_emissions(view.positions, view.registry, view.factors, view.layers, part, path, fx.TIE)
    once, path = scratch_path(spark, "once"), scratch_path(spark, "broken")
    run(days, once)
    whole = getattr(Manifest, step)

    def breaks(self, *args, **kw):
        whole(self, *args, **kw) if step == "store" else None
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Manifest, step, breaks)
        with pytest.raises(RuntimeError):
            run(days.filter("day < '2024-02-10'"), path)
    run(days.filter("day > '2024-01-20'"), path)
    run(days, path)
    assert run(days, path) == 0
    rounded = lambda p: canonical(runs.emission_sums(spark, p).withColumn("emission_value", F.round("emission_value", 6)).toPandas())
    assert rounded(path) == rounded(once) and len(rounded(once)) > 0


SCHEMA = "imo long, mmsi long, dt_pos_utc timestamp, Name string, sog double"
SHOWN = ("imo", "mmsi", "port_group_id", "port_name", "port_start", "port_end", "anchorage_group_id", "anch_start", "anch_end")


def feed(seed, ships=5, n=150):
    rng, rows = random.Random(seed), []
    for ship in range(ships):
        t = rng.randrange(DAY)
        for _ in range(n):
            t += rng.choice([300, 600, 1800, HOUR, HOUR + 1, 5 * HOUR, DAY, DAY + 1])
            rows.append(([9000000 + ship, 0, None, 9000001, 9000001][ship % 5], 100 + ship, t, rng.choice(["Balboa", "Balboa", "Colon", None, None]), rng.choice([0.0, 0.5, 1.0, 2.0, 3.0, 9.0])))
    return rows


@pytest.mark.parametrize("seed, step", [(2, 2), (3, 3)])
def test_events_carried_over_ranges_equal_one_run(frame, seed, step):
    rows = feed(seed)
    tagged = tracks.with_identity(frame(SCHEMA, rows)).cache()
    want = rows_of(ports.port_calls(tagged), *SHOWN)
    start = dt.date(2024, 1, 1)
    last = max(r[2] for r in rows) // DAY + 1
    spark = tagged.sparkSession
    state, given = spark.createDataFrame([], carried.CARRY), []
    for day in range(0, last, 7 * step):
        a, b = start + dt.timedelta(days=day), start + dt.timedelta(days=day + 7 * step)
        part = tagged.filter(F.col("dt_pos_utc").between(F.lit(str(a)).cast("timestamp"), F.lit(str(b)).cast("timestamp") - F.expr("INTERVAL 1 SECOND")))
        events = checkpoint(carried.continued(part, state, b))
        given += rows_of(carried.settled_calls(events), *SHOWN)
        state = checkpoint(carried.carry(events))
        assert state.count() <= 8 * 5
    found = sorted(given + rows_of(carried.open_calls(state), *SHOWN), key=lambda t: tuple((x is None, x) for x in t))
    assert found == want and len(want) > 20


def rows_as_text(df):
    return canonical(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).toPandas())


def test_runs_of_port_calls_go_on_from_one_another(spark, view, frame):
    """Every prefix of ranges shows what one job over its positions shows; a range that comes late re-opens those after it."""
    path = scratch_path(spark, "calls")
    ranges = [(dt.date(2024, 1, 1), dt.date(2024, 1, 20)), (dt.date(2024, 1, 21), dt.date(2024, 1, 31)), (dt.date(2024, 2, 1), dt.date(2024, 4, 15))]

    def go(*which):
        wanted = frame("from_date date, to_date date", [ranges[k] for k in which])
        done = []
        while found := runs.run_port_calls(view.positions, view.port_cells, wanted, path, fx.TIE):
            done.append(found[0])
        return done

    def until(day):
        rows = view.positions.filter(F.col("dt_pos_utc") < F.lit(day).cast("timestamp"))
        return rows_as_text(jobs.port_calls_job(rows, view.port_cells, view.registry, fx.TIE))

    shown = lambda: rows_as_text(runs.port_call_table(spark, path, view.registry))
    assert go(0) == ["2024-01-01"] and shown() == until("2024-01-21")
    assert go(0) == []
    assert go(0, 2) == ["2024-02-01"]
    assert go(0, 1, 2) == ["2024-01-21", "2024-02-01"]
    assert shown() == until("2024-04-16") and len(shown()) > 3
    with pytest.raises(ValueError, match="overlaps"):
        runs.run_port_calls(view.positions, view.port_cells, frame("from_date date, to_date date", [(dt.date(2024, 1, 15), dt.date(2024, 1, 25))]), path)
