"""Port stays on a stream against the batch rule."""

import random
import subprocess
import sys
import time
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark import cloudpickle

from tests.conftest import HOUR, rows_of
from tidemark.operators import ports, tracks
from tidemark.sources.durable import scratch_path
from tidemark.streaming import port_sessions

SCHEMA = "imo long, mmsi long, dt_pos_utc timestamp, Name string, sog double"
SHOWN = ("imo_key", "mmsi", "anch1_port2", "group_id", "imo", "port_name", "event_start", "event_end")
DAY = 24 * HOUR


def streamed(spark, frame, batches, schema=SCHEMA):
    """All events of a feed that arrives in the given batches, one micro-batch each."""
    port_sessions.use_rocks_db(spark)
    source, sink, log = (scratch_path(spark, n) for n in ("in", "out", "log"))
    everything = frame(schema, [r for b in batches for r in b])
    for batch in batches:
        frame(schema, batch).coalesce(1).write.mode("append").parquet(source)
        time.sleep(0.02)
    port_sessions.closing_rows(everything).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(everything.schema).option("maxFilesPerTrigger", 1).parquet(source)
    found = port_sessions.stream_stays(stream)
    writer = found.writeStream.outputMode("append").option("checkpointLocation", log).trigger(availableNow=True)
    writer.start(sink, format="parquet").awaitTermination()
    return spark.read.schema(found.schema).parquet(sink)


def feed(seed):
    rng, rows = random.Random(seed), []
    for ship in range(4):
        t = rng.randrange(HOUR)
        for _ in range(60):
            t += rng.choice([600, HOUR, HOUR + 1, 5 * HOUR, DAY, DAY + 1, 2 * DAY])
            name = rng.choice(["Balboa", "Colon", None])
            imo = [9000000 + ship, 0, None, 9000001][ship]
            rows.append((imo, 100 + ship, t, name, rng.choice([0.0, 0.5, 1.0, 2.0, 3.0, 9.0])))
            if rng.random() < 0.2:
                rows.append((imo, 100 + ship, t, rng.choice(["Balboa", "Colon"]), 0.1))
    return rows


@pytest.mark.parametrize("seed", [2])
def test_equals_the_batch_rule_in_any_order_within_the_watermark(spark, frame, seed):
    rows, rng = feed(seed), random.Random(seed)
    arrival = sorted(rows, key=lambda r: r[2] + rng.randrange(2 * HOUR - 60))
    cuts = sorted(rng.sample(range(1, len(rows)), 5))
    batches = [arrival[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    want = rows_of(ports.stay_events(tracks.with_identity(frame(SCHEMA, rows))), *SHOWN)
    assert rows_of(streamed(spark, frame, batches), *SHOWN) == want and len(want) > 40


def test_borders_of_gap_and_least_stay(spark, frame):
    rows = [(7, 1, 0, "Balboa", 0.0), (7, 1, HOUR, "Balboa", 0.0),  # an hour: counts
            (7, 1, HOUR + DAY, "Balboa", 0.0),  # a day later: the same stay
            (7, 1, HOUR + 2 * DAY + 1, "Balboa", 0.0),  # a second more: a new one, too short, but it has a number
            (7, 1, HOUR + 2 * DAY + 2, "Colon", 0.0), (7, 1, 2 * HOUR + 2 * DAY + 2, "Colon", 1.0),
            (None, 2, 0, None, 2.0), (None, 2, HOUR, None, 3.0), (None, 2, 2 * HOUR + 1, None, 1.5), (None, None, 5, "Balboa", 0.0)]
    found = rows_of(streamed(spark, frame, [rows]), "mmsi", "group_id", "port_name", "event_start", "event_end")
    assert found == [(1, 1, "Balboa", 0, HOUR + DAY), (1, 3, "Colon", HOUR + 2 * DAY + 2, 2 * HOUR + 2 * DAY + 2),
                     (2, 1, "anch", 0, HOUR), (2, 2, "anch", 2 * HOUR + 1, 2 * HOUR + 1)]


def test_a_stay_closed_by_the_clock_is_followed_by_the_next_number(spark, frame):
    # The second batch moves the watermark past the first stay; its ship goes on later.
    first = [(7, 1, 0, "Balboa", 0.0), (7, 1, 2 * HOUR, "Balboa", 0.0)]
    other = [(8, 2, 5 * DAY, "Colon", 0.0)]
    again = [(7, 1, 6 * DAY, "Balboa", 0.0), (7, 1, 6 * DAY + 2 * HOUR, "Balboa", 0.0)]
    found = rows_of(streamed(spark, frame, [first, other, again]), "mmsi", "group_id", "event_start")
    assert found == [(1, 1, 0), (1, 2, 6 * DAY)]


def test_an_empty_feed(spark, frame):
    assert streamed(spark, frame, [[]]).count() == 0


def test_the_processor_runs_where_the_package_is_not(tmp_path):
    path = tmp_path / "processor"
    path.write_bytes(cloudpickle.dumps(port_sessions.Stays({2: 5}, {2: 1})))
    load = f"import pickle; assert pickle.load(open({str(path)!r}, 'rb')).gaps == {{2: 5}}"
    subprocess.run([sys.executable, "-I", "-c", load], cwd=tmp_path, check=True)


class Held:
    """A state variable of one key, and how often it was asked or set."""

    def __init__(self, calls):
        self.value, self.calls = None, calls

    def __getattr__(self, name):
        self.calls.append(name)
        return {"exists": lambda: self.value is not None, "get": lambda: self.value, "clear": lambda: setattr(self, "value", None),
                "update": lambda v: setattr(self, "value", v), "put": lambda v: setattr(self, "value", v),
                "appendValue": lambda v: setattr(self, "value", [*(self.value or []), v])}[name]


@pytest.mark.parametrize("ships", [1, 500])
def test_calls_to_the_state_do_not_grow_with_the_ships(ships):
    calls, timers = [], set()
    handle = SimpleNamespace(getListState=lambda *_: Held(calls), getValueState=lambda *_: Held(calls), registerTimer=timers.add, deleteTimer=timers.discard)
    clock = lambda ms: SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)
    processor = port_sessions.Stays({2: DAY, 1: HOUR}, {2: HOUR, 1: 0})
    processor.init(handle)
    us = 1_000_000
    rows = pd.DataFrame([(-1, s, 2, t * us, "Balboa", s != 0, 2**60 + s) for t in (2 * HOUR, 0) for s in range(ships)], columns=port_sessions.ROW)
    assert not list(processor.handleInputRows((0,), iter([rows]), clock(-1)))
    events = pd.concat(processor.handleExpiredTimer((0,), clock(2 * DAY * 1000), None))
    assert sorted(events["mmsi"]) == list(range(ships)) and set(events["group_id"]) == {1}
    assert set(events["start_us"]) == {0} and set(events["end_us"]) == {2 * HOUR * us}
    assert events.loc[events["mmsi"] == 0, "imo"].isna().all() and all(events["imo"].dropna() > 2**60)
    assert len(calls) < 20
