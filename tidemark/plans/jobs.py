"""The four analyses, composed from the operators.

Zones are given as a table of (Name, cell id of the feed), or as a :class:`Cover` of polygons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.functions import constants as K
from tidemark.operators import emissions as em
from tidemark.operators import ports, specs, tracks, transits, zones
from tidemark.operators.cover import Cover, zone_tag_polygons
from tidemark.operators.lookup import lookup_join
from tidemark.operators.phase import op_phase, with_load
from tidemark.sources.durable import checkpoint


@dataclass(frozen=True)
class Registry:
    """Registry inputs: validity intervals and adapted specifications per (mmsi, version)."""

    versions: DataFrame
    specs: DataFrame


def seen_registry(positions: DataFrame, registry: DataFrame, versions: DataFrame, type_bins: DataFrame) -> Registry:
    """The part of a raw registry that the ships of ``positions`` need, matched by ship and version and adapted.

    Types and size bins come from what the ships send and from their tonnage. Reads the positions' ship columns once and
    stores a row per ship and version, which all jobs over the same positions share.
    """
    ships = specs.distinct_ships(specs.version_join(_columns(positions, "dt_pos_utc", *specs.SHIP_COLUMNS[:-1]), versions))
    matched = specs.match_specs(ships, specs.read_registry(registry))
    return Registry(versions, checkpoint(specs.adapt_specs(matched, type_bins)))


def _columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns a job needs, so that nothing else is read or shuffled."""
    specs.require_columns(df, names)
    return df.select(*dict.fromkeys(names))


def _tagged(positions: DataFrame, zone_cells: DataFrame | Cover, how: str = "inner") -> DataFrame:
    """Positions with the zone they are in; the least name where there are several."""
    if isinstance(zone_cells, Cover):
        return zone_tag_polygons(positions, zone_cells.cells, how, zone_cells.finest)
    return zones.zone_tag(positions, zone_cells, how)


def canal_positions(positions: DataFrame, zone_cells: DataFrame | Cover, tie: tuple[str, ...] = ()) -> DataFrame:
    """Positions in named zones, without tugs; rows of the same second are ordered by ``tie``, then by the other columns."""
    tagged = zones.canon_zones(_tagged(zones.exclude_tugs(positions), zone_cells))
    return _columns(tracks.with_ship(tagged), "ship", "dt_pos_utc", *tie, "imo", "mmsi", "Name", "sog", "draught")


def canal_visits(
    positions: DataFrame, zone_cells: DataFrame | Cover, tie: tuple[str, ...] = (), strict_locks: bool = False
) -> DataFrame:
    """Zone visits of all transits, from which the tables of transits and of stops are made."""
    return transits.transit_visits(transits.segments(canal_positions(positions, zone_cells, tie)), strict_locks)


def transits_job(
    positions: DataFrame, zone_cells: DataFrame | Cover, registry: Registry, tie: tuple[str, ...] = (),
    strict_locks: bool = False, one_row: bool = False,
) -> DataFrame:
    """Transit table with specifications."""
    visits = canal_visits(positions, zone_cells, tie, strict_locks)
    return transits.transits(visits, specs.result_specs(registry.specs, registry.versions), one_row)


def transit_stops_job(
    positions: DataFrame, zone_cells: DataFrame | Cover, tie: tuple[str, ...] = (), strict_locks: bool = False
) -> DataFrame:
    """Stops made during transits."""
    return transits.transit_stops(canal_visits(positions, zone_cells, tie, strict_locks)).drop("ship")


def transit_tables_job(
    positions: DataFrame, zone_cells: DataFrame | Cover, registry: Registry, tie: tuple[str, ...] = (),
    strict_locks: bool = False, one_row: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The results of :func:`transits_job` and :func:`transit_stops_job` from one pass over the positions.

    The visits, some rows for each transit, are stored between.
    """
    visits = checkpoint(canal_visits(positions, zone_cells, tie, strict_locks))
    table = transits.transits(visits, specs.result_specs(registry.specs, registry.versions), one_row)
    return table, transits.transit_stops(visits).drop("ship")


def port_positions(positions: DataFrame, port_cells: DataFrame | Cover, tie: tuple[str, ...] = ()) -> DataFrame:
    """Positions with the port they are in, or null."""
    tagged = tracks.with_identity(_tagged(positions, port_cells, "left"))
    return _columns(tagged, "imo_key", "mmsi", "dt_pos_utc", *tie, "imo", "Name", "sog")


def port_calls_job(
    positions: DataFrame, port_cells: DataFrame | Cover, registry: Registry, tie: tuple[str, ...] = ()
) -> DataFrame:
    """Port-call table with the anchorage wait before each call and specifications."""
    return ports.port_calls(port_positions(positions, port_cells, tie), specs.result_specs(registry.specs, registry.versions))


def specified_positions(
    positions: DataFrame, registry: Registry, factors: em.FactorTables, cell: str = "H3_int_index_6",
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Positions with elapsed hours, version, specifications and emission factors.

    Elapsed time counts between positions of known ships only, so those are
    picked first by key. The wide specification columns are joined last and do
    not travel through the shuffle by ship.
    """
    narrow = _columns(
        tracks.with_ship(positions), "ship", "dt_pos_utc", *tie, "mmsi", "sog", "draught", "H3_int_4", "H3_int_8", cell,
    )
    rows = specs.version_join(narrow, registry.versions)
    known = registry.specs.select("mmsi", "version").distinct()
    rows = lookup_join(rows, known, ["mmsi", "version"], "left_semi")
    return specs.enrich_specs(tracks.track_freq(rows), em.with_factors(registry.specs, factors))


def emissions_job(
    positions: DataFrame, registry: Registry, factors: em.FactorTables,
    layers: tuple[DataFrame, DataFrame, DataFrame], tie: tuple[str, ...] = (),
) -> DataFrame:
    """Monthly emissions per gas, ship type and cell."""
    return em.local_emissions(em.emissions(specified_positions(positions, registry, factors, tie=tie), layers))


def port_stop_rows(
    positions: DataFrame, zone_cells: DataFrame | Cover, registry: Registry,
    layers: tuple[DataFrame, DataFrame, DataFrame], tie: tuple[str, ...] = (), merge_islands: bool = False,
) -> DataFrame:
    """Rows of port-stop visits with phase and merged segments.

    Written out once: the records are aggregated from these rows in four ways.
    """
    tagged = _tagged(positions, zone_cells)
    stops = ports.port_stops_cutoff(_columns(tagged, "mmsi", "dt_pos_utc", *tie, "Name", "sog", "H3_int_4", "H3_int_8"))
    stops = specs.enrich_specs(specs.version_join(stops, registry.versions), registry.specs)
    phased = op_phase(zones.near_coast_port(with_load(stops), *layers))
    phased = phased.select("mmsi", "dt_pos_utc", "Name", "flag", "segr", "op_phase", *tie)
    merge = ports.merge_stop_islands if merge_islands else ports.merge_stop_segments
    merged = merge(phased, K.ANCHORAGE, K.BERTH)
    return checkpoint(merge(merged, K.BERTH, K.ANCHORAGE))


def port_stop_records_job(
    positions: DataFrame, zone_cells: DataFrame | Cover, registry: Registry,
    layers: tuple[DataFrame, DataFrame, DataFrame], tie: tuple[str, ...] = (), nearest: bool = True,
) -> DataFrame:
    """Berth spans with the anchorage span of the visit that ends last before each; all of them without ``nearest``."""
    rows = port_stop_rows(positions, zone_cells, registry, layers, tie)
    return ports.berth_anchorage_nearest(rows) if nearest else ports.berth_anchorage(rows)
