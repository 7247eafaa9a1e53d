"""Time the headline analyses; prints one JSON line.

BENCH_SF_DIR picks the data, BENCH_CPUS the local cores. Ship positions are
stored once, as a feed would be (timed as ``store_positions``), and the analyses
read the stored table. Every query runs once to warm up and once timed, into the
no-op sink, so the whole result is computed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from checks.queries import VIEW_QUERIES, View, plain
from tidemark.sources.durable import checkpoint

HEADLINE = [
    "zone_tag", "gap_islands", "track_freq", "port_calls", "transits", "transit_stops",
    "local_emissions", "port_stop_records", "points_in_zone", "interpolate_track",
]


def session(cores: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        # Keep small shuffles on all cores instead of merging them into one task.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str, positions: DataFrame) -> float:
    start = time.perf_counter()
    view = View(spark, sf_dir)
    view.positions = positions
    plain(VIEW_QUERIES[name](view)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    checkpoint(View(spark, sf_dir).positions)
    start = time.perf_counter()
    positions = checkpoint(View(spark, sf_dir).positions)
    times = {"store_positions": round(time.perf_counter() - start, 3)}
    for name in HEADLINE:
        timed(spark, name, sf_dir, positions)
        times[name] = round(timed(spark, name, sf_dir, positions), 3)
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
