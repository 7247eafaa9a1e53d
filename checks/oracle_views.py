"""The fixture view of ``checks/fixture_view.py`` as DuckDB common table expressions.

Times are kept as epoch seconds (``t_s``).
"""

from __future__ import annotations

from checks import fixture_view as fx
from tidemark.functions import constants as K


def lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, float):
        return f"CAST({value!r} AS DOUBLE)"
    return str(value)


def names(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def rows(name: str, columns: str, data) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in data)
    return f"{name}({columns}) AS (VALUES {body})"


def choose(expr: str, values) -> str:
    n = len(values)
    cases = " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values))
    return f"CASE ({expr}) % {n} {cases} END"


_POSITIONS = f"""
ev AS (
  SELECT event_id, user_id, epoch_us(ts) // 1000000 - {fx.EPOCH} AS off_s,
         CAST(round(value * 100) AS BIGINT) AS v100,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn0
  FROM events),
voyage AS (
  SELECT *, rn0 // {fx.ROWS_PER_VOYAGE} AS cyc, rn0 % {fx.ROWS_PER_VOYAGE} AS slot0,
         CASE WHEN (rn0 // {fx.ROWS_PER_VOYAGE}) % 2 = 0 THEN rn0 % {fx.ROWS_PER_VOYAGE}
              ELSE {fx.ROWS_PER_VOYAGE - 1} - rn0 % {fx.ROWS_PER_VOYAGE} END AS slot
  FROM ev),
scripted AS (
  SELECT *, {fx.EPOCH} + cyc * {fx.VOYAGE}
         + CASE user_id % 3 WHEN 0 THEN off_s // 8 WHEN 1 THEN off_s ELSE off_s * 2 END AS t_s,
    CASE WHEN user_id % 7 = 3 THEN
      CASE WHEN slot0 IN (0, 1) THEN 'Atlantic Anchorage' WHEN slot0 IN (2, 3, 4) THEN 'MIT'
           WHEN slot0 = 5 THEN 'CCT' WHEN slot0 IN (6, 7) THEN NULL
           WHEN slot0 = 8 AND cyc % 2 = 0 THEN 'Atlantic Anchorage'
           WHEN slot0 = 8 THEN 'Pacific Anchorage' ELSE 'Pacific - PSA' END
    ELSE
      CASE WHEN slot IN (0, 1) THEN 'Pacific Anchorage'
           WHEN slot IN (2, 10) AND user_id % 13 = 6 THEN 'Gamboa Mooring station'
           WHEN slot = 2 THEN 'Pacific Access' WHEN slot = 10 THEN 'Atlantic Access'
           WHEN slot IN (3, 4) AND user_id % 2 = 0 THEN 'Miraflores Locks Original'
           WHEN slot = 5 AND user_id % 2 = 0 THEN 'Pedro Miguel Locks Original'
           WHEN slot IN (3, 4, 5) THEN 'Cocoli Locks'
           WHEN slot = 6 AND user_id % 5 = 1 THEN 'MIT' WHEN slot = 6 THEN 'Gamboa Mooring station'
           WHEN slot = 7 OR (slot IN (8, 9) AND user_id % 11 = 5) THEN 'Gatun Anchorage'
           WHEN slot IN (8, 9) AND user_id % 2 = 0 THEN 'Gatun Locks Original'
           WHEN slot IN (8, 9) THEN 'Gatun Locks Expanded'
           WHEN user_id % 4 = 1 THEN {lit(fx.WEST_BREAKWATER)} ELSE 'Atlantic Anchorage' END
    END AS zone
  FROM voyage),
{rows("zone_numbers", "zname, znum", fx.ZONE_NUMBER.items())},
located AS (
  SELECT s.*, coalesce(znum, 0) AS z,
    CASE WHEN zone IN {names(fx.WAIT_ZONES)} THEN 350 WHEN zone IN {names(fx.PORT_ZONES)} THEN 130
         WHEN zone IN {names(fx.LOCK_ZONES)} THEN 600 ELSE 1800 END AS top
  FROM scripted s LEFT JOIN zone_numbers ON zone = zname),
positions AS (
  SELECT event_id, user_id, t_s, 200000000 + user_id AS mmsi,
    CASE WHEN user_id % 5 <> 0 THEN 9000000 + user_id END AS imo,
    CAST(v100 % top AS DOUBLE) / 100 AS sog,
    CASE WHEN user_id % 19 = 4 THEN 'CERRO AZUL' WHEN user_id % 19 = 5 THEN NULL
         ELSE 'SHIP ' || CAST(user_id AS VARCHAR) END AS vessel_name,
    CASE WHEN event_id % 23 <> 0 THEN CAST(5 + (event_id + user_id) % 3 AS DOUBLE) END AS draught,
    CAST(8.90 AS DOUBLE) + CAST(0.05 AS DOUBLE) * z + ((event_id * 7919) % 21 - 10) * CAST(0.0003 AS DOUBLE) AS latitude,
    CAST(-79.60 AS DOUBLE) - CAST(0.03 AS DOUBLE) * z + ((event_id * 104729) % 21 - 10) * CAST(0.0003 AS DOUBLE) AS longitude,
    1000 * z + event_id % 7 AS H3_int_index_10, 100 * z + event_id % 3 AS H3_int_8,
    z AS H3_int_4, z AS H3_int_index_6, z AS H3_int_index_5,
    {choose("user_id", fx.TYPES)} AS vessel_type_main,
    CAST(100 + user_id % 200 AS DOUBLE) AS length, CAST(20 + user_id % 30 AS DOUBLE) AS width
  FROM located)"""

_LOOKUPS = ",\n".join([
    rows("zone_cells", "cname, ccell", fx.ZONE_CELL_ROWS),
    rows("version_rows", "version, v_from, v_to", fx.VERSION_ROWS),
    rows("coast_5", "H3_int_4, id_coast_5", fx.COAST_5_ROWS),
    rows("port_1", "H3_int_8, id_port_1", fx.PORT_1_ROWS),
    rows("port_5", "H3_int_8, id_port_5", fx.PORT_5_ROWS),
    rows("table_17", "StandardVesselType, imobin, " + ", ".join(fx.T17_NAMES), fx.TABLE_17_ROWS),
    rows("table_44", "StandardVesselType, imobin, weather, fouling", fx.TABLE_44_ROWS),
    rows("table_19_1", 'meType, fuel, y83, y84, y01, pilot_mdo', fx.TABLE_19_1_ROWS),
    rows("table_19_2", "fuel, meType, y83, y84, y01", fx.TABLE_19_2_ROWS),
    rows("table_21", "fuel, ef_co2", fx.TABLE_21_ROWS),
    rows("table_55_56", "meType, fuel, ef_ch4", fx.TABLE_55_56_ROWS),
    rows("table_59_60", "meType, fuel, ef_n2o", fx.TABLE_59_60_ROWS),
    rows("type_bins", "vessel_type, StandardVesselType, lo, hi, imobin", fx.TYPE_BIN_ROWS),
])

_SPECS = f"""
specs AS (
  SELECT 200000000 + user_id AS mmsi, version,
    CASE WHEN user_id % 17 = 0 THEN CAST(0 AS DOUBLE)
         ELSE CAST(10 + user_id % 13 + (version = '2024B')::INT AS DOUBLE) END AS Speed,
    {choose("user_id", [100.0, 150.5, 300.0, 20000.0])} AS Powerkwmax,
    {choose("user_id", fx.TYPES)} AS StandardVesselType, CAST(user_id % 10 AS INTEGER) AS imobin,
    {choose("user_id", fx.ENGINES)} AS meType, {choose("user_id", fx.FUELS)} AS fuel,
    CASE WHEN user_id % 29 <> 0 THEN CAST(1975 + user_id % 50 AS INTEGER) END AS build_year,
    CAST(8 + user_id % 6 AS DOUBLE) AS SummerDraught,
    CAST(100 + user_id % 200 AS DOUBLE) AS ais_loa, CAST(20 + user_id % 30 AS DOUBLE) AS ais_beam,
    CAST(1000 * (1 + user_id % 60) AS DOUBLE) AS GrossTonnage
  FROM (SELECT DISTINCT user_id FROM events), (VALUES ('2024A'), ('2024B')) v(version)),
result_specs AS (
  SELECT mmsi, ais_loa AS length, ais_beam AS beam, StandardVesselType, GrossTonnage
  FROM specs WHERE version = '2024B'),
registry AS (
  SELECT mmsi, version, mmsi - 200000000 + 9000000 AS imo, Speed, GrossTonnage FROM specs
  UNION ALL
  SELECT mmsi, version, mmsi - 200000000 + 9000000, Speed, GrossTonnage + 500 FROM specs
  WHERE (mmsi - 200000000 + 9000000) % 9 = 0)"""

_LEDGERS = """
object_names AS (
  SELECT CASE o_orderkey % 5
      WHEN 0 THEN 'dash/transits_pc/transits_pc_in_' || d || '&' || d2 || '.parquet'
      WHEN 1 THEN 'dash/stops_in_transits_pc/stops_in_transits_pc_in_' || d || '&' || d2 || '.parquet'
      WHEN 2 THEN 'dash/port_stops/port_stops_in_' || d || '&' || d2 || '.parquet'
      WHEN 3 THEN 'dash/transits_pc/transits_pc_in_' || d || '.parquet'
      ELSE 'dash/emissions/log_' || CAST(o_orderkey AS VARCHAR) || '.parquet' END AS path
  FROM (SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS d,
               strftime(CAST(o_orderdate AS DATE) + 14, '%Y-%m-%d') AS d2 FROM orders)),
transit_ranges AS (
  SELECT DISTINCT CAST(regexp_extract(path, 'transits_pc_in_(.{10})&(.{10})[.]parquet', 1) AS DATE) AS from_date,
                  CAST(regexp_extract(path, 'transits_pc_in_(.{10})&(.{10})[.]parquet', 2) AS DATE) AS to_date
  FROM object_names WHERE path LIKE 'dash/transits_pc/%&%'),
port_ranges AS (
  SELECT DISTINCT CAST(regexp_extract(path, 'port_stops_in_(.{10})&(.{10})[.]parquet', 1) AS DATE) AS from_date,
                  CAST(regexp_extract(path, 'port_stops_in_(.{10})&(.{10})[.]parquet', 2) AS DATE) AS to_date
  FROM object_names WHERE path LIKE 'dash/port_stops/%'),
done_days AS (
  SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date_done FROM orders WHERE o_custkey % 7 = 0)"""

# Zone-tagged rows: with every zone (canal), and with port zones only (harbour).
_TAGGED = f"""
cell_names AS (SELECT ccell, min(cname) AS Name FROM zone_cells GROUP BY ccell),
port_cell_names AS (
  SELECT ccell, min(cname) AS Name FROM zone_cells
  WHERE cname IN {names(fx.PORT_ZONES + [fx.SPECIAL_CELL[1]])} GROUP BY ccell),
tagged AS (SELECT p.*, Name FROM positions p JOIN cell_names ON H3_int_index_10 = ccell),
canal AS (
  SELECT t.* REPLACE (CASE WHEN Name IN {names(K.ATLANTIC_ANCHORAGE_PARTS)} THEN 'Atlantic Anchorage' ELSE Name END AS Name),
         coalesce(imo, -mmsi) AS ship
  FROM tagged t WHERE vessel_name NOT IN {names(K.TUGS)}),
harbour AS (SELECT p.*, Name FROM positions p LEFT JOIN port_cell_names ON H3_int_index_10 = ccell)"""

PREFIX = "WITH RECURSIVE " + ",\n".join(
    part.strip("\n") for part in (_POSITIONS, _LOOKUPS, _SPECS, _LEDGERS, _TAGGED)
)


def query(body: str, ctes: str = "") -> str:
    """A full statement: shared views, the query's own ``ctes``, then ``body``."""
    extra = ",\n" + ctes.strip().rstrip(",") if ctes else ""
    return f"{PREFIX}{extra}\n{body.strip()}"
