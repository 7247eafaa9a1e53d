"""Every registered query: operator runs over the whole derived tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture_view as fx
from tidemark.functions import cells
from tidemark.functions import constants as K
from tidemark.operators import cluster, cover, geo, ports, specs, tracks, transits, zones
from tidemark.operators import emissions as em
from tidemark.plans import jobs, runs
from tidemark.sources import file_index, ledger, results, tables
from tidemark.sources import positions as scans
from tidemark.sources.durable import checkpoint, scratch_path
from tidemark.sources.manifest import Manifest
from tidemark.streaming import port_sessions, repair, sessions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
VIEW_QUERIES: dict[str, Callable[[View], DataFrame]] = {}

TODAY = date(2001, 9, 1)
GRID = 0.005
TS = "dt_pos_utc"


def plain(df: DataFrame) -> DataFrame:
    """Times as epoch seconds, dates as text, booleans as 0/1, doubles to 6 places."""
    cols = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            col = F.unix_timestamp(col)
        elif isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.BooleanType):
            col = col.cast("int")
        elif isinstance(field.dataType, T.DoubleType):
            col = F.round(col, 6)
        cols.append(col.alias(field.name))
    return df.select(*cols)


class View:
    """Inputs of one scale, built on demand."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    @cached_property
    def positions(self) -> DataFrame:
        return fx.positions(self.spark, self.dir)

    @cached_property
    def zone_cells(self) -> DataFrame:
        return fx.zone_cells(self.spark)

    @cached_property
    def port_cells(self) -> DataFrame:
        return fx.port_cells(self.spark)

    @cached_property
    def canal(self) -> DataFrame:
        return jobs.canal_positions(self.positions, self.zone_cells, fx.TIE)

    @cached_property
    def harbour(self) -> DataFrame:
        return jobs.port_positions(self.positions, self.port_cells, fx.TIE)

    @cached_property
    def registry(self) -> jobs.Registry:
        return fx.registry_of(self.spark, self.dir)

    @cached_property
    def layers(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return fx.layers(self.spark)

    @cached_property
    def factors(self) -> em.FactorTables:
        return fx.factors(self.spark)

    @cached_property
    def specified(self) -> DataFrame:
        return jobs.specified_positions(self.positions, self.registry, self.factors, tie=fx.TIE)

    @cached_property
    def active(self) -> DataFrame:
        return em.active_positions(self.specified, self.layers)

    @cached_property
    def segments(self) -> DataFrame:
        return transits.segments(self.canal)

    @cached_property
    def visits(self) -> DataFrame:
        return transits.transit_visits(self.segments)

    @cached_property
    def stop_rows(self) -> DataFrame:
        return jobs.port_stop_rows(self.positions, self.zone_cells, self.registry, self.layers, fx.TIE)

    @cached_property
    def phased_stops(self) -> DataFrame:
        """Port-stop rows with a phase, segments not merged."""
        tagged = zones.zone_tag(self.positions, self.zone_cells)
        stops = ports.port_stops_cutoff(tagged.select("mmsi", TS, "event_id", "Name", "sog"))
        slow = F.when(F.col("sog") <= 1, F.when(F.col("Name").isin(K.PORTS), K.BERTH).otherwise(K.ANCHORAGE))
        return checkpoint(stops.withColumn("op_phase", F.when(F.col("sog") <= 3, F.coalesce(slow, F.lit(K.ANCHORAGE))).otherwise(K.MANOEUVRING)))

    @cached_property
    def transit_ranges(self) -> DataFrame:
        return ledger.processed_ranges(fx.object_names(self.spark, self.dir), "transits_pc_in", exclude="stops")


def query(fn: Callable[[View], DataFrame], name: str | None = None) -> Callable[[View], DataFrame]:
    name = name or fn.__name__
    VIEW_QUERIES[name] = fn
    QUERIES[name] = lambda spark, sf_dir: plain(fn(View(spark, sf_dir)))
    return fn


# ---- Zones and projections --------------------------------------------------


@query
def zone_tag(v: View) -> DataFrame:
    return zones.zone_tag(v.positions, v.zone_cells).select("event_id", "mmsi", TS, "Name")


@query
def zone_tag_left(v: View) -> DataFrame:
    return zones.zone_tag(v.positions, v.port_cells, "left").select("event_id", "mmsi", TS, "Name")


@query
def exclude_tugs(v: View) -> DataFrame:
    return zones.exclude_tugs(v.positions).select("event_id", "mmsi", "vessel_name")


@query
def canon_zones(v: View) -> DataFrame:
    return zones.canon_zones(zones.zone_tag(v.positions, v.zone_cells)).select("event_id", "Name")


@query
def zone_class(v: View) -> DataFrame:
    tagged = zones.canon_zones(zones.zone_tag(v.positions, v.zone_cells, "left"))
    return tagged.select("event_id", "Name", zones.zone_class().alias("zone_class"))


@query
def speed_class(v: View) -> DataFrame:
    tagged = zones.zone_tag(v.positions, v.zone_cells, "left")
    flags = {
        "at_anchor": zones.at_anchor(), "at_stop": zones.at_stop(),
        "in_port": zones.in_port(), "off_zone": zones.anchoring_off_zone(),
    }
    return tagged.select("event_id", *[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()])


@query
def identity_split(v: View) -> DataFrame:
    with_imo, without = zones.identity_split(v.positions)
    count = F.count(F.lit(1)).alias("n_positions")
    first = with_imo.groupBy(F.col("imo").alias("ship_id")).agg(count).withColumn("kind", F.lit("imo"))
    second = without.groupBy(F.col("mmsi").alias("ship_id")).agg(count).withColumn("kind", F.lit("mmsi"))
    return first.unionByName(second)


# ---- Tracks -----------------------------------------------------------------


@query
def dedup_positions(v: View) -> DataFrame:
    base = tracks.with_ship(v.positions).select("ship", TS, "event_id", "sog")
    repeated = base.filter(F.col("event_id") % 3 == 0).select(
        "ship", TS, (F.col("event_id") + 100000000).alias("event_id"), (F.col("sog") + 1).alias("sog")
    )
    return tracks.dedup_positions(base.unionByName(repeated), ["ship"], tie=fx.TIE)


@query
def time_extent(v: View) -> DataFrame:
    return scans.time_extent(v.positions)


@query
def track_rownum(v: View) -> DataFrame:
    return tracks.track_rownum(v.canal, ["ship"]).select("ship", "event_id", "row")


@query
def track_lag(v: View) -> DataFrame:
    lagged = tracks.track_lag(v.canal, ["ship"], {"Name_lag": "Name", "dt_lag": TS})
    return lagged.select("ship", "event_id", "Name_lag", "dt_lag")


@query
def gap_islands(v: View) -> DataFrame:
    far = lambda prev, cur: F.unix_timestamp(cur(TS)) - F.unix_timestamp(prev(TS)) > K.HOUR
    return tracks.number_groups(v.canal, ["ship"], [TS], {"island": far}).select("ship", "event_id", "island")


@query
def track_freq(v: View) -> DataFrame:
    return tracks.track_freq(v.canal).select("ship", "event_id", "freq")


@query
def interpolate_track(v: View) -> DataFrame:
    base = tracks.dedup_positions(
        tracks.with_ship(v.positions).select("ship", TS, "latitude", "longitude", "event_id"), ["ship"], tie=fx.TIE
    )
    return tracks.interpolate_track(base)


# ---- Ports ------------------------------------------------------------------


@query
def port_groups(v: View) -> DataFrame:
    return ports.port_groups(v.harbour).select("imo", "mmsi", "event_id", "group_id")


@query
def port_events(v: View) -> DataFrame:
    return ports.port_events(v.harbour).select("imo", "mmsi", "port_group_id", "port_name", "port_start", "port_end")


@query
def anchorage_events(v: View) -> DataFrame:
    return ports.anchorage_events(v.harbour).select("imo", "mmsi", "anchorage_group_id", "anch_start", "anch_end")


@query
def event_sequence(v: View) -> DataFrame:
    return ports.event_sequence(ports.stay_events(v.harbour)).drop("imo_key")


@query
def anch_port_links(v: View) -> DataFrame:
    return ports.anch_port_links(ports.event_sequence(ports.stay_events(v.harbour))).drop("imo_key")


@query
def port_calls(v: View) -> DataFrame:
    return jobs.port_calls_job(v.positions, v.port_cells, v.registry, fx.TIE)


# ---- Specifications ---------------------------------------------------------


@query
def version_join(v: View) -> DataFrame:
    return specs.version_join(v.positions, v.registry.versions).select("event_id", TS, "version")


@query
def distinct_ships(v: View) -> DataFrame:
    return specs.distinct_ships(specs.version_join(v.positions, v.registry.versions))


@query
def match_specs(v: View) -> DataFrame:
    ships = specs.distinct_ships(specs.version_join(v.positions, v.registry.versions))
    return specs.match_specs(ships, specs.read_registry(fx.registry(v.spark, v.dir)))


@query
def adapt_specs(v: View) -> DataFrame:
    ships = specs.distinct_ships(specs.version_join(v.positions, v.registry.versions))
    matched = specs.match_specs(ships, specs.read_registry(fx.registry(v.spark, v.dir)))
    adapted = specs.adapt_specs(matched, fx.type_bins(v.spark))
    return adapted.select("mmsi", "version", "GrossTonnage", "StandardVesselType", "imobin")


@query
def enrich_specs(v: View) -> DataFrame:
    rows = specs.version_join(v.positions, v.registry.versions)
    return specs.enrich_specs(rows, v.registry.specs).select("event_id", "version", "Speed", "StandardVesselType")


# ---- Phase and emissions ----------------------------------------------------


@query
def near_coast_port(v: View) -> DataFrame:
    return zones.near_coast_port(v.positions, *v.layers).select("event_id", "coast5", "port1", "port5")


@query
def op_phase(v: View) -> DataFrame:
    return v.active.select("event_id", "sog", "load", "op_phase")


@query
def emission_factors(v: View) -> DataFrame:
    return em.with_factors(v.registry.specs, v.factors).select(
        "mmsi", "version", "YearOfBuild", "ae_sea", "ab_berth", "weather", "fouling", "sfc_base", "sfc_ae", "sfc_ab",
        "pilot_mdo", "ef_co2", "ef_ch4", "ef_ch4_ae", "ef_ch4_ab", "ef_n2o", "ef_n2o_ae", "ef_n2o_ab",
    )


@query
def aux_energy(v: View) -> DataFrame:
    return em.aux_energy(v.active).select("event_id", "ae_ene", "ab_ene")


@query
def main_energy(v: View) -> DataFrame:
    return em.main_energy(v.active).select("event_id", "me_pow", "me_ene")


@query
def fuel_use(v: View) -> DataFrame:
    used = em.fuel_use(em.main_energy(em.aux_energy(v.active)))
    return used.select("event_id", "sfc_me", "sfc_ae", "sfc_ab", "me_con", "ae_con", "ab_con", "pilot_con")


@query
def co2(v: View) -> DataFrame:
    return em.co2(em.fuel_use(em.main_energy(em.aux_energy(v.active)))).select("event_id", "co2_g")


@query
def ch4_n2o(v: View) -> DataFrame:
    return em.ch4_n2o(em.main_energy(em.aux_energy(v.active))).select("event_id", "ch4_g", "n2o_g")


@query
def emissions(v: View) -> DataFrame:
    tonnes = em.emissions(v.specified, v.layers)
    # In grams: per position, tonnes of the small gases vanish in six places.
    return tonnes.select("event_id", "op_phase", "freq", *[(F.col(f"{g}_t") * 1e6).alias(f"{g}_g") for g in ("co2", "ch4", "n2o")])


@query
def unpivot_emissions(v: View) -> DataFrame:
    long = em.unpivot_emissions(em.emissions(v.specified, v.layers), ["event_id"])
    return long.withColumn("emission_value", F.col("emission_value") * 1e6)


@query
def local_emissions(v: View) -> DataFrame:
    return jobs.emissions_job(v.positions, v.registry, v.factors, v.layers, fx.TIE)


@query
def null_emissions(v: View) -> DataFrame:
    return em.null_emissions(em.emissions(v.specified, v.layers))


# ---- Transits ---------------------------------------------------------------


@query
def transit_segments(v: View) -> DataFrame:
    return transits.transit_segments(v.canal).select("ship", "event_id", "segr")


@query
def stay_spans(v: View) -> DataFrame:
    spans = v.segments.groupBy("ship", "segr").agg(
        F.min("Name").alias("Name"), F.min("seg_start").alias("seg_start"), F.max("seg_end").alias("seg_end")
    )
    return spans


@query
def transit_anchors(v: View) -> DataFrame:
    return transits.transit_anchors(v.segments).select("ship", "segr", "Name", "seg_start")


@query
def transit_port_filter(v: View) -> DataFrame:
    return transits.transit_port_filter(v.segments).select("ship", "segr", "Name", "seg_start")


@query
def transit_pairs(v: View) -> DataFrame:
    return transits.transit_pairs(v.segments).select("ship", "segr", "run", "run_row")


@query
def transit_flags(v: View) -> DataFrame:
    flags = transits.transit_flags(v.segments)
    return flags.select("ship", "flag", "open_segr", "close_segr", "open_zone")


@query
def transit_access(v: View) -> DataFrame:
    return transits.transit_access(transits.transit_tests(transits.transit_members(v.segments))).select("ship", "flag", "segr", "is_close")


@query
def transit_locks(v: View) -> DataFrame:
    members = transits.transit_access(transits.transit_tests(transits.transit_members(v.segments)))
    return transits.transit_locks(members).select("ship", "flag", "segr", "neo_transit")


@query
def transit_locks_strict(v: View) -> DataFrame:
    members = transits.transit_access(transits.transit_tests(transits.transit_members(v.segments)))
    return transits.transit_locks(members, strict_locks=True).select("ship", "flag", "segr", "neo_transit")


@query
def transit_candidates(v: View) -> DataFrame:
    return transits.transit_candidates(v.canal).select(
        "imo", "mmsi", "event_id", TS, "Name", "flag", "segr", "neo_transit", "anchoring_group", "port_group", "dir"
    )


@query
def anchorage_stays(v: View) -> DataFrame:
    return transits.anchorage_stays(v.visits).drop("ship")


@query
def transit_stops(v: View) -> DataFrame:
    return jobs.transit_stops_job(v.positions, v.zone_cells, fx.TIE)


@query
def transits_from_registry(v: View) -> DataFrame:
    """Transits with specifications matched and adapted from the raw registry for the ships that were seen."""
    registry = jobs.seen_registry(v.positions, fx.raw_registry(v.spark, v.dir), v.registry.versions, fx.type_bins(v.spark))
    return jobs.transits_job(v.positions, v.zone_cells, registry, fx.TIE)


@query
def transit_tables(v: View) -> DataFrame:
    """Transits and the stops made during them, from one pass."""
    found, stops = jobs.transit_tables_job(v.positions, v.zone_cells, v.registry, fx.TIE)
    found = found.selectExpr("'transit' AS kind", "imo", "mmsi", "flag", "lock_in AS from_time", "lock_out AS to_time", "direction AS what")
    return found.union(stops.selectExpr("'stop'", "imo", "mmsi", "flag", "stop_time_in", "stop_time_out", "stop_area"))


@query
def lock_summary(v: View) -> DataFrame:
    return transits.lock_summary(v.visits).drop("ship")


@query
def draught_mode(v: View) -> DataFrame:
    return transits.draught_mode(v.visits).drop("ship")


@query
def direct_transit(v: View) -> DataFrame:
    return transits.direct_transit(v.visits).drop("ship")


def transits_table(v: View) -> DataFrame:
    return jobs.transits_job(v.positions, v.zone_cells, v.registry, fx.TIE)


query(transits_table, "transits")


@query
def transits_one_row(v: View) -> DataFrame:
    return jobs.transits_job(v.positions, v.zone_cells, v.registry, fx.TIE, one_row=True)


@query
def merge_overlaps(v: View) -> DataFrame:
    table = transits.transits(v.visits).withColumn("late", F.expr("lock_out + interval 120 hours"))
    return tracks.merge_overlaps(
        table.select("imo", "mmsi", "lock_in", "late", "direct_transit", "anchoring_in"), ["imo", "mmsi"],
        "lock_in", "late", least=["direct_transit", "anchoring_in"],
    )


# ---- Port stops -------------------------------------------------------------


@query
def port_stops_cutoff(v: View) -> DataFrame:
    return v.phased_stops.select("mmsi", "event_id", "Name", "flag", "segr")


@query
def visit_tests(v: View) -> DataFrame:
    tagged = zones.zone_tag(v.positions, v.zone_cells)
    rows = tagged.select("mmsi", TS, "event_id", "Name")
    return ports.visit_tests(ports.number_visits(rows))


@query
def merge_stop_segments(v: View) -> DataFrame:
    merged = ports.merge_stop_segments(v.phased_stops, K.ANCHORAGE, K.BERTH, 6 * K.HOUR)
    return merged.select("mmsi", "event_id", "flag", "segr")


@query
def merge_stop_islands(v: View) -> DataFrame:
    merged = ports.merge_stop_islands(v.phased_stops, K.ANCHORAGE, K.BERTH, 6 * K.HOUR)
    return merged.select("mmsi", "event_id", "flag", "segr")


@query
def berth_spans(v: View) -> DataFrame:
    return ports.berth_spans(v.phased_stops)


@query
def visit_name(v: View) -> DataFrame:
    return ports.visit_name(v.phased_stops)


@query
def visit_name_mode(v: View) -> DataFrame:
    return ports.visit_name(v.phased_stops, mode=True)


@query
def berth_anchorage(v: View) -> DataFrame:
    return ports.berth_anchorage(v.phased_stops)


@query
def berth_anchorage_nearest(v: View) -> DataFrame:
    return ports.berth_anchorage_nearest(v.phased_stops)


@query
def port_ships(v: View) -> DataFrame:
    return ports.port_ships(v.phased_stops)


@query
def port_stop_records(v: View) -> DataFrame:
    return ports.berth_anchorage(v.stop_rows)


# ---- Incremental runs -------------------------------------------------------


@query
def scan_positions(v: View) -> DataFrame:
    busy = v.positions.filter("sog > 17").select("H3_int_index_5")
    found = scans.scan_range(v.positions, "2024-01-05 00:00:00", "2024-02-10 12:00:00", busy)
    return found.select("event_id", TS, "H3_int_index_5")


@query
def scan_with_index(v: View) -> DataFrame:
    """The rows of ``scan_positions`` from stored files, of which an index names those that can hold them."""
    path, index = scratch_path(v.spark, "indexed"), scratch_path(v.spark, "file-index")
    v.positions.repartitionByRange(F.to_date(TS), "H3_int_index_5").write.parquet(path)
    file_index.index_files(v.spark, path, index)
    busy = v.positions.filter("sog > 17").select("H3_int_index_5")
    found = file_index.scan_indexed(v.spark, path, index, "2024-01-05 00:00:00", "2024-02-10 12:00:00", busy)
    return found.select("event_id", TS, "H3_int_index_5")


@query
def processed_ranges(v: View) -> DataFrame:
    return v.transit_ranges


@query
def next_range(v: View) -> DataFrame:
    return ledger.next_range(v.transit_ranges, TODAY)


@query
def freshness(v: View) -> DataFrame:
    return scans.freshness(v.positions, "2024-02-01 00:00:00")


@query
def days_to_do(v: View) -> DataFrame:
    """Days of the transit ranges on which no range of port stops begins."""
    done = ledger.processed_ranges(fx.object_names(v.spark, v.dir), "port_stops_in")
    return ledger.days_to_do(v.transit_ranges, done.select(F.col("from_date").alias("date_done")))


@query
def ranges_to_do(v: View) -> DataFrame:
    done = ledger.processed_ranges(fx.object_names(v.spark, v.dir), "port_stops_in")
    return ledger.ranges_to_do(v.transit_ranges, done, first_only=False)


@query
def first_pending_range(v: View) -> DataFrame:
    done = ledger.processed_ranges(fx.object_names(v.spark, v.dir), "port_stops_in")
    return ledger.ranges_to_do(v.transit_ranges, done)


@query
def emissions_from_csv(v: View) -> DataFrame:
    """The emissions of all positions with factor tables and layers from checked CSV files."""
    folder = scratch_path(v.spark, "csv")
    for name in tables.FACTORS:
        getattr(v.factors, name).coalesce(1).write.option("header", True).csv(f"{folder}/{name}.csv")
    for name, layer in zip(tables.LAYERS, v.layers):
        layer.coalesce(1).write.option("header", True).csv(f"{folder}/{name}.csv")
    factors, layers = tables.read_factors(v.spark, folder), tables.read_layers(v.spark, folder)
    return jobs.emissions_job(v.positions, v.registry, factors, layers, fx.TIE)


@query
def emissions_increment(v: View) -> DataFrame:
    """The emissions of all days in several runs; one is repeated, one breaks off before it is committed and is followed by one with more days."""
    path = scratch_path(v.spark, "sums")
    days = v.positions.select(F.date_format(TS, "yyyy-MM-dd").alias("day")).distinct()

    def run(part: DataFrame) -> None:
        runs.run_emissions(v.positions, v.registry, v.factors, v.layers, part, path, fx.TIE)

    run(days.filter("day < '2024-01-20'"))
    run(days.filter("day < '2024-01-20'"))
    manifest = Manifest(v.spark, path)
    broken = manifest.plan(days.filter("day < '2024-02-01'").withColumnRenamed("day", "unit"))
    stored = manifest.read("sums", runs.DAY_SUMS)
    manifest.store(broken, sums=stored)
    run(days)
    return runs.emission_sums(v.spark, path)


@query
def port_call_runs(v: View) -> DataFrame:
    """Port calls over consecutive ranges of 15 days from the first position to the last, one run each, and a range without positions long after."""
    path, stored = scratch_path(v.spark, "calls"), scratch_path(v.spark, "positions")
    # Stored by day, as positions are delivered: a run reads the days of its range only.
    dated = v.positions.withColumn("day", F.to_date(TS))
    dated.repartition("day", F.pmod(F.xxhash64("mmsi"), F.lit(4))).write.partitionBy("day").parquet(stored)
    positions = v.spark.read.schema(dated.schema).parquet(stored)
    extent = positions.agg(F.to_date(F.min(TS)).alias("a"), F.to_date(F.max(TS)).alias("b"))
    ranges = extent.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 15 DAYS"))).alias("from_date"))
    wanted = checkpoint(ranges.union(extent.select(F.date_add("b", 4000))).withColumn("to_date", F.date_add("from_date", 14)))
    while runs.run_port_calls(positions, v.port_cells, wanted, path, fx.TIE, "day"):
        pass
    return runs.port_call_table(v.spark, path, v.registry)


@query
def new_days_only(v: View) -> DataFrame:
    days = v.positions.filter("sog < 0.02").select(F.date_format(TS, "yyyy-MM-dd").alias("day"))
    return ledger.new_days_only(v.positions, days).select("event_id", TS)


@query
def merge_emissions(v: View) -> DataFrame:
    """All sums, added to older ones: twice the same, with one type unknown."""
    new = jobs.emissions_job(v.positions, v.registry, v.factors, v.layers, fx.TIE)
    known = F.when(F.col("StandardVesselType") != "Cruise", F.col("StandardVesselType"))
    old = new.withColumn("StandardVesselType", known)
    return results.merge_emissions(old.withColumn("emission_value", F.col("emission_value") * 2), new)


@query
def write_results(v: View) -> DataFrame:
    path = scratch_path(v.spark, "port-calls")
    calls = jobs.port_calls_job(v.positions, v.port_cells, v.registry, fx.TIE)
    results.write_results(calls, path, "2024-01-01", "2024-01-15")
    results.write_results(calls.filter("imo IS NULL"), path, "2024-01-16", "2024-01-30")
    results.write_results(calls, path, "2024-01-01", "2024-01-15")
    stored = results.read_results(v.spark, path)
    return stored.withColumn("from_date", F.col("from_date").cast("string")).withColumn(
        "to_date", F.col("to_date").cast("string")
    )


# ---- Geometry and clustering ------------------------------------------------


@query
def parse_wkt(v: View) -> DataFrame:
    parsed = geo.parse_wkt(fx.polygons(v.spark, v.dir))
    return parsed.select(
        "Name", F.size("edges").alias("n_edges"), "box.*",
        F.aggregate("edges", F.lit(0.0), lambda s, e: s + e["x1"] * e["y2"] - e["x2"] * e["y1"]).alias("twice_area"),
    )


@query
def polyfill(v: View) -> DataFrame:
    return geo.polyfill(geo.parse_wkt(fx.polygons(v.spark, v.dir), territory="Panama"), GRID).select("Name", "cell")


@query
def points_in_zone(v: View) -> DataFrame:
    parsed = geo.parse_wkt(fx.polygons(v.spark, v.dir), territory="Panama").select("Name", "edges", "box")
    points = v.positions.select("event_id", "mmsi", TS, "latitude", "longitude")
    return geo.points_in_zone(points, parsed, GRID).select("event_id", "Name")


@query
def zone_tag_from_polygons(v: View) -> DataFrame:
    """All positions with the least zone among all polygons that contain them, or null."""
    parsed = geo.parse_wkt(fx.polygons(v.spark, v.dir)).select("Name", "edges", "box")
    points = v.positions.select("event_id", "latitude", "longitude")
    return cover.zone_tag_polygons(points, cover.polygon_cover(parsed, least="Name"), "left").select("event_id", "Name")


@query
def quad_cells(v: View) -> DataFrame:
    """The cell of each position with its ancestor five levels up, its level, row and column, and how many cells are around it."""
    cell = F.col("cell")
    row, col = cells.quad_row_col(cell)
    celled = v.positions.select("event_id", cells.quad_cell(F.col("latitude"), F.col("longitude"), cover.FINEST).alias("cell"))
    return celled.select(
        "event_id", "cell", cells.quad_parent(cell, cover.FINEST - 5).alias("parent"), cells.quad_level(cell).alias("level"),
        row.alias("r"), col.alias("c"), F.size(cells.quad_neighbours(cell)).alias("n_around"))


@query
def cell_of(v: View) -> DataFrame:
    return v.positions.select("event_id", cells.grid_cell(F.col("latitude"), F.col("longitude"), GRID).alias("cell"))


@query
def cell_parent(v: View) -> DataFrame:
    """Resolution-10 hexagon ids built from each event's number, and two of their ancestors."""
    digits = F.lit(0).cast("long")
    for i in range(10):
        digits = digits * 8 + F.floor(F.col("event_id") / (7**i)) % 7
    ident = F.lit((1 << 59) | (10 << 52) | ((1 << 15) - 1)) + F.shiftleft(F.col("H3_int_index_6"), 45) + digits * 32768
    ids = v.positions.select("event_id", ident.alias("cell"))
    return ids.select(
        "event_id", "cell", cells.cell_parent(F.col("cell"), 8).alias("parent_8"),
        cells.cell_parent(F.col("cell"), 4).alias("parent_4"), cells.cell_text(F.col("cell")).alias("cell_text"),
        (cells.cell_number(cells.cell_text(F.col("cell"))) == F.col("cell")).alias("round_trip"),
    )


@query
def dbscan_stops(v: View) -> DataFrame:
    rows = checkpoint(tracks.dedup_positions(
        tracks.with_ship(v.positions).select("ship", TS, "latitude", "longitude", "event_id"), ["ship"], tie=fx.TIE
    )).withColumn("dir", F.when(F.col("ship") % 2 == 0, "South").otherwise("North"))
    eps = rows.groupBy("ship").agg(cluster.track_eps().alias("eps"))
    points = checkpoint(rows.join(eps, "ship").withColumn("second", F.unix_timestamp(TS)))
    return cluster.dbscan(points, ["ship"], "second").select("ship", "event_id", "cluster")


# ---- Streaming --------------------------------------------------------------


@query
def stream_anchorage_sessions(v: View) -> DataFrame:
    """Positions written as files, read back as a stream and closed into sessions."""
    source, sink, log = (scratch_path(v.spark, f"sessions-{n}") for n in ("in", "out", "log"))
    rows = v.harbour.select("imo", "mmsi", TS, "Name", "sog")
    rows.write.parquet(source)
    stream = v.spark.readStream.schema(rows.schema).parquet(source)
    found = sessions.anchorage_sessions(stream)

    def run() -> None:
        running = (
            found.writeStream.outputMode("append").option("checkpointLocation", log)
            .trigger(availableNow=True).format("parquet").start(sink)
        )
        running.awaitTermination()

    run()
    sessions.closing_row(rows).write.mode("append").parquet(source)
    run()
    return v.spark.read.schema(found.schema).parquet(sink)


@query
def stream_port_sessions(v: View) -> DataFrame:
    """Positions written as files in order of time, read back as a stream, its stays and spells closed by a processor per ship."""
    port_sessions.use_rocks_db(v.spark)
    source, sink, log = (scratch_path(v.spark, f"stays-{n}") for n in ("in", "out", "log"))
    rows = v.harbour.select("imo", "mmsi", TS, "Name", "sog")
    rows.write.parquet(source)
    rows = v.spark.read.schema(rows.schema).parquet(source)
    found = port_sessions.stream_stays(v.spark.readStream.schema(rows.schema).parquet(source))

    def run() -> None:
        writer = found.writeStream.outputMode("append").option("checkpointLocation", log).trigger(availableNow=True)
        writer.format("parquet").start(sink).awaitTermination()

    run()
    port_sessions.closing_rows(rows).write.mode("append").parquet(source)
    run()
    return v.spark.read.schema(found.schema).parquet(sink).drop("imo_key")


@query
def stream_repaired_sessions(v: View) -> DataFrame:
    """Stays and spells of a feed in which a part of every ship's rows comes after all others, so that most of it is late and repaired."""
    port_sessions.use_rocks_db(v.spark)
    source, feed, sink, log, store = (scratch_path(v.spark, f"repair-{n}") for n in ("in", "feed", "out", "log", "store"))
    rows = checkpoint(v.harbour.select("imo", "mmsi", TS, "Name", "sog"))
    behind = F.hour(TS) == 5
    for part in (~behind, behind):
        rows.filter(part).write.mode("append").parquet(source)
        stream = v.spark.readStream.schema(rows.schema).parquet(source)
        repair.split_feed(stream, feed).option("checkpointLocation", f"{log}-feed").trigger(availableNow=True).start().awaitTermination()
    found = port_sessions.stream_stays(repair.rows_in_time(v.spark, feed, rows.schema), min_stay=0)

    def run() -> None:
        writer = found.writeStream.outputMode("append").option("checkpointLocation", f"{log}-stays").trigger(availableNow=True)
        writer.format("parquet").start(sink).awaitTermination()

    run()
    port_sessions.closing_rows(rows).write.parquet(f"{feed}/batch=999999999/late=false")
    run()
    events = v.spark.read.schema(found.schema).parquet(sink)
    repair.repair_stays(v.spark, feed, rows.schema, events, store)
    return repair.repaired_stays(v.spark, events, store).filter("mmsi <> -1").drop("imo_key")
