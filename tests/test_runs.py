"""Ledgers, writes, streams and plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks import fixture_view as fx
from checks.compare import canonical, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES, View
from tests.conftest import HOUR, rows_of
from tidemark.functions.constants import SLICE_WIDTH
from tidemark.operators import tracks, transits
from tidemark.plans import jobs
from tidemark.sources import ledger, results
from tidemark.sources import positions as scans
from tidemark.sources.durable import scratch_path
from tidemark.streaming import sessions

SMALL = "/root/testdata/sf0.001"
D = dt.date


def test_ranges(frame):
    names = frame("path string", [("a/transits_pc_in_2024-01-01&2024-01-15.parquet",), ("a/transits_pc_in_2024-01-10&2024-02-20.parquet",),
                                  ("a/stops_in_transits_pc_in_2024-05-01&2024-05-02.parquet",), ("a/transits_pc_in.parquet",)])
    ranges = ledger.processed_ranges(names, "transits_pc_in", exclude="stops")
    assert rows_of(ranges, "from_date", "to_date") == [(D(2024, 1, 1), D(2024, 1, 15)), (D(2024, 1, 10), D(2024, 2, 20))]
    assert ledger.resolve_range(ranges, D(2024, 3, 1)) == (D(2024, 2, 5), D(2024, 2, 29))
    assert ledger.resolve_range(ranges, D(2024, 3, 1), D(2024, 1, 1), D(2024, 1, 2)) == (D(2024, 1, 1), D(2024, 1, 2))
    empty = ranges.filter("false")
    assert ledger.resolve_range(empty, D(2024, 3, 1)) == (D(2024, 2, 14), D(2024, 2, 29))
    with pytest.raises(ledger.RangeError):
        ledger.resolve_range(ranges, D(2024, 1, 1))


def test_days_and_ranges_to_do(frame):
    ranges = frame("from_date date, to_date date", [(D(2024, 1, 1), D(2024, 1, 3)), (D(2024, 1, 5), D(2024, 1, 6))])
    done = frame("date_done string", [("2024-01-02",)])
    assert [r[0] for r in rows_of(ledger.days_to_do(ranges, done), "day")] == [f"2024-01-0{i}" for i in (1, 3, 4, 5, 6)]
    assert rows_of(ledger.ranges_to_do(ranges, ranges.filter("from_date = DATE'2024-01-01'")), "from_date") == [(D(2024, 1, 5),)]


def test_writing_a_range_again_replaces_only_that_range(spark, frame):
    path = scratch_path(spark, "test")
    results.write_results(frame("a long", [(1,), (2,)]), path, "2024-01-01", "2024-01-15")
    results.write_results(frame("a long", [(3,)]), path, "2024-01-16", "2024-01-30")
    results.write_results(frame("a long", [(9,)]), path, "2024-01-01", "2024-01-15")
    stored = results.read_results(spark, path)
    assert rows_of(stored, "a") == [(3,), (9,)]
    assert results.written_ranges(stored).count() == 2
    assert scans.read_positions(spark, path + "-absent") is None


def test_stream_sessions_match_the_batch_rule(frame, spark):
    rows = frame("imo long, mmsi long, dt_pos_utc timestamp, Name string, sog double",
                 [(1, 7, t, None, 2.0) for t in (0, HOUR, 2 * HOUR + 1, 100 * HOUR)])
    source, sink, log = (scratch_path(spark, n) for n in ("in", "out", "log"))
    rows.write.parquet(source)
    found = sessions.anchorage_sessions(spark.readStream.schema(rows.schema).parquet(source))
    run = lambda: found.writeStream.option("checkpointLocation", log).trigger(availableNow=True).start(sink, format="parquet").awaitTermination()
    run()
    sessions.closing_row(rows).write.mode("append").parquet(source)
    run()
    got = spark.read.schema(found.schema).parquet(sink)
    assert rows_of(got, "anch_start", "anch_end", "n_positions") == [(0, HOUR, 2), (2 * HOUR + 1, 2 * HOUR + 1, 1), (100 * HOUR, 100 * HOUR, 1)]


def test_emission_totals_do_not_count_a_repeated_batch_twice(frame, spark):
    sums = frame("year int, month int, emission_type string, StandardVesselType string, h3resolution int, resolution_id long, emission_value double",
                 [(2024, 1, "co2_t", None, 6, 1, 2.0), (2024, 1, "co2_t", None, 6, 1, 3.0)])
    source, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    sums.write.parquet(source)
    for log in ("log-a", "log-b"):  # a new log repeats batch 0
        stream = spark.readStream.schema(sums.schema).parquet(source)
        writer = sessions.emission_totals(stream, out).option("checkpointLocation", scratch_path(spark, log))
        writer.trigger(availableNow=True).start().awaitTermination()
    assert rows_of(sessions.read_totals(spark.read.parquet(out)), "emission_value") == [(5.0,)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_transit_plan_shuffles_positions_by_slice_and_segments_by_ship(spark):
    view = View(spark, SMALL)
    from_positions, from_segments = plan_of(view.segments), plan_of(transits.transits(view.visits))
    slices = re.findall(r"hashpartitioning\(ship#\d+L, _slice#\d+L", from_segments)
    ships = re.findall(r"hashpartitioning\(ship#\d+L, \d+\)", from_segments)
    assert len(slices) == 1 and len(ships) == 1
    assert "SortMergeJoin" not in from_segments
    assert len(re.findall("Exchange hash", from_segments)) == len(re.findall("Exchange hash", from_positions))


def test_no_python_workers_in_plans(spark):
    view = View(spark, SMALL)
    for df in (
        jobs.transits_job(view.positions, view.zone_cells, view.registry),
        jobs.port_calls_job(view.positions, view.port_cells, view.registry),
        jobs.emissions_job(view.positions, view.registry, view.factors, view.layers),
    ):
        plan = plan_of(df)
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    path = scratch_path(spark, "positions")
    dated = fx.positions(spark, SMALL).withColumn("day", F.to_date("dt_pos_utc"))
    dated.write.partitionBy("day").parquet(path)
    stored = scans.read_positions(spark, path)
    got = scans.scan_range(stored, "2024-01-05", "2024-01-07", date_column="day").select("mmsi", "sog")
    plan = plan_of(got)
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(dt_pos_utc" in plan
    assert re.search(r"ReadSchema: struct<dt_pos_utc:timestamp,mmsi:bigint,sog:double>", plan)


def test_slice_bound_is_what_the_doc_says():
    assert SLICE_WIDTH == 604800


ORACLE_SAMPLE = [
    "zone_tag", "dedup_positions", "port_calls", "match_specs", "adapt_specs", "local_emissions", "transits",
    "transit_candidates", "transit_locks_strict", "draught_mode", "port_stop_records", "merge_stop_islands",
    "merge_overlaps", "points_in_zone", "polyfill", "days_to_do", "dbscan_stops", "scan_with_index",
    "transits_from_registry", "transit_tables",
    "emissions_increment", "port_call_runs", "write_results", "stream_anchorage_sessions", "first_pending_range",
]


@pytest.mark.parametrize("name", ORACLE_SAMPLE)
def test_query_equals_its_sql(spark, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    want = connect(SMALL).execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want) and len(got) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_an_empty_run_replaces_the_range_and_is_noted(frame, spark):
    path, log = scratch_path(spark, "results"), scratch_path(spark, "log")
    rows = frame("a long", [(1,), (2,), (3,)])
    assert results.logged_ranges(spark, log).count() == 0
    for df in (rows, rows.limit(0)):
        results.write_results(df, path, "2024-01-01", "2024-01-15")
        results.log_range(spark, log, "2024-01-01", "2024-01-15")
    results.write_results(rows.limit(1), path, "2024-01-16", "2024-01-30")
    assert results.read_results(spark, path).select("a").count() == 1
    assert [tuple(map(str, r)) for r in results.logged_ranges(spark, log).collect()] == [("2024-01-01", "2024-01-15")]


def test_new_days_reach_the_scan_as_a_range(frame, spark):
    path = scratch_path(spark, "days")
    frame("mmsi long, dt_pos_utc timestamp", [(1, 0), (2, 86400), (3, 5 * 86400)]).write.parquet(path)
    days = frame("day string", [("2024-01-02",), ("2024-01-03",)])
    found = ledger.new_days_only(spark.read.parquet(path), days)
    assert [r.mmsi for r in found.collect()] == [2]
    assert "GreaterThanOrEqual(dt_pos_utc" in found._jdf.queryExecution().executedPlan().toString()
    assert ledger.new_days_only(spark.read.parquet(path), days.limit(0)).count() == 0


def test_invalid_imo_numbers_do_not_merge_ships(frame):
    rows = tracks.with_ship(frame("imo long, mmsi long", [(0, 5), (0, 6), (-1, 7), (9, 8), (None, 9)]))
    assert rows_of(rows, "ship") == [(-9,), (-7,), (-6,), (-5,), (9,)]
