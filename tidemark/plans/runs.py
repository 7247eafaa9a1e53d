"""Incremental runs: what is pending is read, analysed, stored and committed. Running again changes nothing.

Each run is an entry of a :class:`~tidemark.sources.manifest.Manifest`, and results are stored by unit: emissions by day, port
calls by date range. Readers see committed units only, each once. A run that breaks off at any step leaves its work
pending; the next one may cover the same units or others.

Port calls do not end where a range ends. What is still open there, and what later calls need to know, is carried
as a table of events, a few per ship, that the next range goes on from.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import carried
from tidemark.operators import emissions as em
from tidemark.operators.lookup import lookup_join
from tidemark.operators.specs import result_specs
from tidemark.plans import jobs
from tidemark.sources import ledger, results
from tidemark.sources import positions as scans
from tidemark.sources.durable import checkpoint
from tidemark.sources.manifest import Manifest

DAY_SUMS = "year int, month int, emission_type string, StandardVesselType string, h3resolution int, resolution_id bigint, emission_value double"


# ---- Port calls ---------------------------------------------------------


def _unit(from_date: object, to_date: object) -> str:
    return f"{from_date}_{to_date}"


def _ranges(units: DataFrame) -> DataFrame:
    """from_date and to_date of units of :func:`run_port_calls`."""
    parts = F.split("unit", "_")
    return units.withColumns({c: F.to_date(F.get(parts, F.lit(k))) for k, c in enumerate(results.RANGE_COLUMNS)})


def run_port_calls(
    positions: DataFrame, port_cells: DataFrame, wanted: DataFrame, path: str, tie: tuple[str, ...] = (), date_column: str | None = None,
) -> tuple[str, str] | None:
    """Port calls that the first range in ``wanted`` without results settles; that range, or None if all are done.

    Ranges must not overlap. They are taken in order, each going on from the events that were open at
    the end of the one before. If a range is wanted that lies before ranges already done, those are retracted and
    pending again.
    """
    spark = positions.sparkSession
    manifest = Manifest(spark, path)
    done = _ranges(manifest.owners())
    row = ledger.ranges_to_do(wanted, done.select(*results.RANGE_COLUMNS)).first()
    if row is None:
        return None
    first, last = row["from_date"], row["to_date"]
    clash = done.filter((F.col("from_date") <= F.lit(last)) & (F.col("to_date") >= F.lit(first)))
    if not clash.isEmpty():
        raise ValueError(f"{first} to {last} overlaps a range that is done")
    later = done.filter(F.col("from_date") > F.lit(last))
    if not later.isEmpty():
        manifest.retract(later)
    unit = _unit(first, last)
    run = manifest.plan(spark.range(1).select(F.lit(unit).alias("unit")))
    before = _carried(manifest, first)
    rows = jobs.port_positions(scans.scan_range(positions, f"{first} 00:00:00", f"{last} 23:59:59.999999", date_column=date_column), port_cells, tie)
    events = checkpoint(carried.continued(rows, before, last + timedelta(days=1)))
    named = F.lit(unit).alias("unit")
    manifest.store(run, calls=carried.settled_calls(events).select("*", named), carry=carried.carry(events).select("*", named))
    manifest.commit(run)
    return str(first), str(last)


def _carried(manifest: Manifest, day: object) -> DataFrame:
    """The events carried by the last range that ends before ``day``."""
    rows = _ranges(manifest.read("carry", carried.CARRY)).filter(F.col("to_date") < F.lit(day))
    last = _ranges(manifest.owners()).filter(F.col("to_date") < F.lit(day)).agg(F.max("to_date")).first()[0]
    return rows.filter(F.col("to_date") == F.lit(last).cast("date")).drop("unit", *results.RANGE_COLUMNS)


def port_call_table(spark: SparkSession, path: str, registry: jobs.Registry | None = None) -> DataFrame:
    """All port calls of the ranges done: those settled, and those still open at the end as they are now."""
    manifest = Manifest(spark, path)
    settled = manifest.read("calls", carried.CALLS).drop("unit")
    last = _ranges(manifest.owners()).agg(F.max("to_date")).first()[0]
    calls = settled
    if last is not None:
        calls = settled.unionByName(carried.open_calls(_carried(manifest, last + timedelta(days=1))))
    return calls if registry is None else lookup_join(calls, result_specs(registry.specs, registry.versions), ["mmsi"], "left")


# ---- Emissions ----------------------------------------------------------


def run_emissions(
    positions: DataFrame, registry: jobs.Registry, factors: em.FactorTables, layers: tuple[DataFrame, DataFrame, DataFrame],
    days: DataFrame, path: str, tie: tuple[str, ...] = (), ts: str = "dt_pos_utc",
) -> int:
    """Stores the emissions of those of ``days`` (column ``day``, text) that have none; how many there were.

    The day before a pending day is read too: elapsed time may begin there. It does not count itself.
    """
    manifest = Manifest(positions.sparkSession, path)
    pending = checkpoint(manifest.pending(days.select(F.col("day").alias("unit"))).withColumnRenamed("unit", "day"))
    count = pending.count()
    if not count:
        return 0
    run = manifest.plan(pending.select(F.col("day").alias("unit")))
    before = pending.select(F.date_format(F.date_sub(F.to_date("day"), 1), "yyyy-MM-dd").alias("day"))
    near = ledger.new_days_only(positions, pending.union(before), ts)
    rows = ledger.new_days_only(jobs.specified_positions(near, registry, factors, tie=tie), pending, ts)
    manifest.store(run, sums=em.local_emissions(em.emissions(rows, layers), by={"unit": F.date_format(ts, "yyyy-MM-dd")}))
    manifest.commit(run)
    return count


def emission_sums(spark: SparkSession, path: str) -> DataFrame:
    """Monthly sums over all committed days."""
    stored = Manifest(spark, path).read("sums", DAY_SUMS)
    return results.merge_emissions(stored, stored.limit(0))


def reopen_days(spark: SparkSession, path: str, days: DataFrame) -> None:
    """Takes back the emissions of ``days`` (column ``day``) and of the days after, whose elapsed times may begin in them."""
    after = days.select(F.date_format(F.date_add(F.to_date("day"), 1), "yyyy-MM-dd").alias("day"))
    units = days.select("day").union(after).select(F.col("day").alias("unit")).distinct()
    manifest = Manifest(spark, path)
    manifest.retract(units.join(manifest.owners().select("unit"), "unit", "left_semi"))
