"""Port stays and anchorage spells on a stream, by the batch rule of :func:`tidemark.operators.ports.stay_events`.

A stay ends at a gap or where the port's name changes, is numbered per ship and counts only
from a least length on; a session window can say none but the first of these. Ships are dealt over
buckets. A processor per bucket keeps rows until the watermark has passed them, as rows arrive out of order, and then takes
them ship by ship in order of time, all in one pass over arrays: calls to the state store follow the buckets, not the ships.
What a bucket holds is the last stay of each of its ships and kinds and their rows of the watermark's delay.

The class is shipped by value: executors need no copy of this package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import constants as K
from tidemark.operators import ports, tracks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SECOND = 1_000_000
#: Buckets of ships. A bucket's waiting rows and stays are in a task's memory together, and a stream keeps its number of buckets.
BUCKETS = 1024
ROW = ["imo_key", "mmsi", "kind", "us", "name", "has_imo", "imo"]
#: The last stay of a ship and kind: ``us`` is its end; a closed one stays for the number of the next.
STAY = [*ROW, "first", "number", "open"]
EVENT = "imo_key bigint, mmsi bigint, anch1_port2 int, group_id bigint, imo bigint, port_name string, start_us bigint, end_us bigint"


class Stays(StatefulProcessor):
    """Events of a bucket of ships. ``gaps``: seconds by kind; ``least``: shortest stay in seconds by kind."""

    def __init__(self, gaps: dict[int, int], least: dict[int, int]):
        self.gaps, self.least = gaps, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.stays = handle.getValueState("stays", "rows binary")
        self.due = handle.getValueState("due", "ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat([frame[ROW] for frame in rows], ignore_index=True)
        watermark, known = timerValues.getCurrentWatermarkInMs(), self._known()
        earliest = int(fresh["us"].min())
        if earliest > watermark * 1000 and (known is None or known > watermark + 1):
            # Nothing can be taken yet: what waits already need not be read.
            self.waiting.appendValue((_packed(fresh),))
            self._wake([earliest // 1000 + 1])
            return iter(())
        return self._advance(fresh, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()
        return self._advance(None, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, fresh: pd.DataFrame | None, watermark: int) -> Iterator[pd.DataFrame]:
        """Takes the rows that the watermark has passed; later rows wait."""
        passed = watermark * 1000
        parts = [_unpacked(value) for (value,) in self.waiting.get()] if self.waiting.exists() else []
        rows = pd.concat([*parts, *([] if fresh is None else [fresh])], ignore_index=True) if parts or fresh is not None else pd.DataFrame(columns=ROW)
        ready = rows["us"].to_numpy(np.int64) <= passed
        taken, rest = rows[ready], rows[~ready]
        before = [_unpacked(self.stays.get()[0])] if self.stays.exists() else []
        events, stays = self._taken(before, taken, passed)
        if len(taken):
            if len(rest):
                self.waiting.put([(_packed(rest),)])
            else:
                self.waiting.clear()
        elif fresh is not None:
            self.waiting.appendValue((_packed(fresh),))
        if len(stays):
            self.stays.update((_packed(stays),))
        going = stays[stays["open"]]
        ends = (going["us"] // SECOND + going["kind"].map(self.gaps) + 1) * 1000
        self._wake(([int(rest["us"].min()) // 1000 + 1] if len(rest) else []) + ([int(ends.min())] if len(going) else []))
        return iter([events] if len(events) else [])

    def _taken(self, before: list[pd.DataFrame], rows: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, pd.DataFrame]:
        """The events that end with ``rows`` or by the clock, and the last stay of each ship and kind."""
        marked = rows.assign(first=rows["us"], number=0, open=True, old=False)
        every = pd.concat([*[b.assign(old=True) for b in before], marked], ignore_index=True) if before else marked
        if not len(every):
            return pd.DataFrame(), every[STAY]
        # By ship and kind: the stay that was, then its rows by time, name and imo, nulls first.
        names = pd.Categorical(every["name"], categories=sorted(every["name"].dropna().unique())).codes
        held = {c: every[c].to_numpy() for c in STAY if c != "name"} | {"old": every["old"].to_numpy(bool), "code": names}
        order = np.lexsort([held["imo"], held["has_imo"], names, held["us"], ~held["old"], held["kind"], held["mmsi"], held["imo_key"]])
        t = {c: v[order] for c, v in held.items()}
        name = every["name"].to_numpy(object)[order]
        n, second = len(order), t["us"] // SECOND
        gap = pd.Series(t["kind"]).map(self.gaps).to_numpy()
        opens = np.ones(n, bool)  # the first of a ship and kind
        opens[1:] = (t["imo_key"][1:] != t["imo_key"][:-1]) | (t["mmsi"][1:] != t["mmsi"][:-1]) | (t["kind"][1:] != t["kind"][:-1])
        starts = opens.copy()
        starts[1:] |= ~t["open"][:-1].astype(bool) | (second[1:] - second[:-1] > gap[1:]) | (t["code"][1:] != t["code"][:-1])
        head = np.flatnonzero(starts)
        tail = np.append(head[1:], n) - 1
        final = np.append(opens[head[1:]], True)  # the last stay of its ship and kind
        # Numbers go on from the old stay's.
        new = np.cumsum(starts & ~t["old"])
        base = np.flatnonzero(opens)[np.cumsum(opens) - 1]
        number = t["number"][base] + new - new[base] + (~t["old"][base]).astype(int)
        end, going = t["us"][tail], t["open"][head].astype(bool)
        kind = t["kind"][head]
        ended = going & (~final | (passed // SECOND - end // SECOND > gap[head]))
        found = {c: t[c][head] for c in ("imo_key", "mmsi", "has_imo", "imo", "first")} | {"kind": kind, "us": end, "name": name[head], "number": number[head]}
        # A stay that ended by the clock is kept, closed.
        stays = pd.DataFrame(found | {"open": going & ~ended})[final][STAY]
        least = pd.Series(kind).map(self.least).to_numpy()
        e = pd.DataFrame(found)[ended & (end // SECOND - found["first"] // SECOND >= least)]
        return pd.DataFrame({
            "imo_key": e["imo_key"], "mmsi": e["mmsi"], "anch1_port2": e["kind"], "group_id": e["number"], "imo": e["imo"].astype("Int64").where(e["has_imo"]),
            "port_name": e["name"].where(e["name"].notna(), "anch"), "start_us": e["first"], "end_us": e["us"]}), stays

    def _known(self) -> int | None:
        return self.due.get()[0] if self.due.exists() else None

    def _wake(self, moments: list[int]) -> None:
        """One timer, at the first moment at which the watermark can change something."""
        known = self._known()
        if not moments or (known is not None and known <= min(moments)):
            return
        if known is not None:
            self.handle.deleteTimer(known)
        self.handle.registerTimer(min(moments))
        self.due.update((min(moments),))


def _packed(frame: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pydict({c: pa.array(frame[c], pa.string() if c == "name" else None, from_pandas=True) for c in frame.columns})
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _unpacked(value: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(value).read_all().to_pandas()


def stream_stays(
    tagged: DataFrame, watermark: str = "2 hours", port_gap: int = K.PORT_GAP, anchorage_gap: int = K.ANCHORAGE_GAP,
    min_stay: int = K.PORT_MIN_STAY, ts: str = "dt_pos_utc", buckets: int = BUCKETS,
) -> DataFrame:
    """The rows of :func:`~tidemark.operators.ports.stay_events`, each as soon as the watermark shows that it has ended.

    ``tagged``: a streaming input with imo, mmsi, Name and sog. Rows of the same time are ordered by Name, then imo.
    Rows later than the watermark are lost (see :mod:`tidemark.streaming.repair`), and rows without an MMSI are left out. The
    query needs the state store that :func:`use_rocks_db` sets. ``buckets``: more of them for more ships, or more rows in the watermark's delay.
    """
    slow = ports.slow_rows(tracks.with_identity(tagged)).filter("mmsi is not null").withWatermark(ts, watermark)
    # Nulls would make doubles of the numbers in a frame.
    narrow = slow.select(
        "imo_key", F.col("mmsi").cast("bigint").alias("mmsi"), F.col("anch1_port2").alias("kind"), ts,
        F.unix_micros(ts).alias("us"), F.col("Name").alias("name"),
        F.col("imo").isNotNull().alias("has_imo"), F.coalesce(F.col("imo").cast("bigint"), F.lit(0)).alias("imo"))
    narrow = narrow.withColumn("bucket", F.pmod(F.xxhash64("imo_key", "mmsi"), F.lit(buckets)))
    processor = Stays({ports.PORT: port_gap, ports.ANCHORAGE_SPELL: anchorage_gap}, {ports.PORT: min_stay, ports.ANCHORAGE_SPELL: 0})
    events = narrow.groupBy("bucket").transformWithStateInPandas(processor, EVENT, "Append", "EventTime")
    return events.select(
        "imo_key", "mmsi", "anch1_port2", "group_id", "imo", "port_name",
        F.timestamp_micros("start_us").alias("event_start"), F.timestamp_micros("end_us").alias("event_end"))


def closing_rows(tagged: DataFrame, watermark: str = "2 hours", longest_gap: int = K.PORT_GAP, ts: str = "dt_pos_utc") -> DataFrame:
    """Two rows that end a stream's input: read as its last batch, they move the watermark past every open event.

    They are of no ship (identity -1), one of each kind of event; their own events never end.
    """
    late = F.max(ts) + F.expr(f"INTERVAL {watermark}") + F.expr(f"INTERVAL {2 * longest_gap + 2} seconds")
    last = tagged.agg(late.alias(ts)).filter(F.col(ts).isNotNull())
    stopped = {"imo": F.lit(-1), "mmsi": F.lit(-1), ts: F.col(ts), "sog": F.lit(0.0), "Name": F.lit("")}
    adrift = stopped | {"sog": F.lit(2.0), "Name": F.lit(None)}
    both = [last.select(*[v.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in tagged.schema.fields]) for v in (stopped, adrift)]
    return both[0].unionByName(both[1])


def use_rocks_db(spark: SparkSession) -> None:
    """Sets the state store that processors with timers need, for queries that this session starts from now on."""
    spark.conf.set(STATE_STORE, ROCKS_DB)
