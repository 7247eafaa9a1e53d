"""A stream that loses late rows, and their repair."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from checks import fixture_view as fx
from checks.compare import canonical
from checks.queries import View
from tests.conftest import HOUR, rows_of
from tests.test_port_sessions import SCHEMA, SHOWN, feed
from tidemark.operators import ports, tracks
from tidemark.plans import runs
from tidemark.sources.durable import scratch_path
from tidemark.streaming import port_sessions, repair


def stored_feed(spark, frame, batches):
    """The feed split by batch; where, and its schema."""
    source, path, log = (scratch_path(spark, n) for n in ("source", "feed", "log"))
    for batch in batches:
        frame(SCHEMA, batch).coalesce(1).write.mode("append").parquet(source)
        time.sleep(0.02)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    repair.split_feed(stream, path).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
    return path


def streamed(spark, path, whole):
    port_sessions.use_rocks_db(spark)
    sink, log = scratch_path(spark, "sink"), scratch_path(spark, "log")
    found = port_sessions.stream_stays(repair.rows_in_time(spark, path, SCHEMA, 2), min_stay=0)

    def run():
        found.writeStream.option("checkpointLocation", log).trigger(availableNow=True).start(sink, format="parquet").awaitTermination()

    run()
    port_sessions.closing_rows(whole).coalesce(1).write.parquet(f"{path}/batch=999999999/late=false")
    run()
    return spark.read.schema(found.schema).parquet(sink)


@pytest.mark.parametrize("seed", [2])
def test_stream_and_repair_equal_the_batch_rule(spark, frame, seed):
    rows, rng = feed(seed), random.Random(seed)
    # A tenth of the rows comes days late.
    arrival = sorted(rows, key=lambda r: r[2] + (rng.randrange(2 * HOUR - 60) if rng.random() < 0.9 else rng.randrange(5, 400) * HOUR))
    cuts = sorted(rng.sample(range(1, len(rows)), 5))
    whole = frame(SCHEMA, rows)
    path = stored_feed(spark, frame, [arrival[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])])
    late = repair.late_rows(spark, path, SCHEMA)
    assert 0 < late.count() < len(rows) / 5
    assert rows_of(repair.all_rows(spark, path, SCHEMA), "mmsi", "dt_pos_utc", "sog") == rows_of(whole, "mmsi", "dt_pos_utc", "sog")
    events, store = streamed(spark, path, whole), scratch_path(spark, "repairs")
    want = rows_of(ports.stay_events(tracks.with_identity(whole)), *SHOWN)
    assert rows_of(repair.repaired_stays(spark, events, store), *SHOWN) != want
    for _ in range(2):  # a second repair changes nothing
        assert repair.repair_stays(spark, path, SCHEMA, events, store) > 0
        found = repair.repaired_stays(spark, events, store).filter("mmsi <> -1")
        assert rows_of(found, *SHOWN) == want and len(want) > 40


def test_repairs_of_many_ships_write_few_files(spark, frame):
    ships = range(1, 60)
    early = [(None, m, t, "Balboa", 0.0) for m in ships for t in (0, HOUR, 30 * HOUR)]
    late = [(None, m, 2 * HOUR, "Balboa", 0.0) for m in ships]
    path, store = stored_feed(spark, frame, [early, late]), scratch_path(spark, "repairs")
    whole = frame(SCHEMA, early + late)
    events = streamed(spark, path, whole)
    assert repair.repair_stays(spark, path, SCHEMA, events, store) == len(ships)
    assert len([f for _, _, names in os.walk(store) for f in names if f.endswith(".parquet")]) < len(ships) / 2
    found = repair.repaired_stays(spark, events, store).filter("mmsi <> -1")
    assert rows_of(found, *SHOWN) == rows_of(ports.stay_events(tracks.with_identity(whole)), *SHOWN)


def test_a_repeated_batch_is_not_stored_twice(spark, frame):
    path = None
    rows = [(1, 7, 0, "Balboa", 0.0), (1, 7, HOUR, "Balboa", 0.0)]
    source, path = scratch_path(spark, "source"), scratch_path(spark, "feed")
    frame(SCHEMA, rows).coalesce(1).write.parquet(source)
    for log in ("a", "b"):  # a new log repeats batch 0
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        repair.split_feed(stream, path).option("checkpointLocation", scratch_path(spark, log)).trigger(availableNow=True).start().awaitTermination()
    assert repair.all_rows(spark, path, SCHEMA).count() == 2 and repair.late_rows(spark, path, SCHEMA).count() == 0
    assert repair.repair_stays(spark, path, SCHEMA, spark.createDataFrame([], repair.STORED), scratch_path(spark, "repairs")) == 0


def test_late_rows_reopen_the_days_of_emissions(spark):
    view = View(spark, "/root/testdata/sf0.001")
    days = view.positions.select(F.date_format("dt_pos_utc", "yyyy-MM-dd").alias("day")).distinct()
    late = view.positions.filter("event_id % 7 = 3 AND dt_pos_utc < '2024-01-12'")
    early = view.positions.join(late.select("event_id"), "event_id", "left_anti")
    once, path = scratch_path(spark, "once"), scratch_path(spark, "late")
    run = lambda rows, where: runs.run_emissions(rows, view.registry, view.factors, view.layers, days, where, fx.TIE)
    rounded = lambda p: canonical(runs.emission_sums(spark, p).withColumn("emission_value", F.round("emission_value", 6)).toPandas())
    run(view.positions, once)
    run(early, path)
    assert rounded(path) != rounded(once)
    runs.reopen_days(spark, path, repair.late_days(late))
    assert 0 < run(view.positions, path) < days.count()
    assert rounded(path) == rounded(once)
