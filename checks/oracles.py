"""DuckDB SQL for the registered queries, written from the rules row by row.

The transit and visit rules are stated here on position rows with running sums,
the long way round, so that they check the segment-based Spark operators.
"""

from __future__ import annotations

from checks import fixture_view as fx
from checks.oracle_views import lit, names, query
from checks.queries import GRID
from tidemark.functions import constants as K

ORACLES: dict[str, str] = {}

ANCH, PORTS, LOCKS = names(K.ANCHORAGES), names(K.PORTS), names(K.LOCKS)


def add(name: str, body: str, ctes: str = "") -> None:
    ORACLES[name] = query(body, ctes)


# ---- Zones and projections --------------------------------------------------

add("zone_tag", "SELECT event_id, mmsi, t_s AS dt_pos_utc, Name FROM tagged")
add("zone_tag_left", """
SELECT event_id, mmsi, t_s AS dt_pos_utc, Name FROM positions LEFT JOIN port_cell_names ON H3_int_index_10 = ccell""")
add("exclude_tugs", f"SELECT event_id, mmsi, vessel_name FROM positions WHERE vessel_name NOT IN {names(K.TUGS)}")
CANON = f"CASE WHEN Name IN {names(K.ATLANTIC_ANCHORAGE_PARTS)} THEN 'Atlantic Anchorage' ELSE Name END"
add("canon_zones", f"SELECT event_id, {CANON} AS Name FROM tagged")
ALL_TAGGED = f"""
wide AS (SELECT p.*, Name FROM positions p LEFT JOIN cell_names ON H3_int_index_10 = ccell)"""
add("zone_class", f"""
SELECT event_id, nm AS Name, CASE WHEN nm IS NULL THEN NULL WHEN nm IN {PORTS} THEN 'port' WHEN nm IN {ANCH} THEN 'anchorage'
  WHEN nm IN {LOCKS} THEN 'lock' WHEN nm IN {names(K.STOPS)} THEN 'stop' ELSE 'other' END AS zone_class
FROM (SELECT event_id, {CANON} AS nm FROM wide)""", ALL_TAGGED)
add("speed_class", f"""
SELECT event_id, coalesce(Name IN {ANCH} AND sog < 3, false)::INT AS at_anchor,
  coalesce((Name = 'Gatun Anchorage' AND sog < 3) OR (Name IN {PORTS} AND sog < 1), false)::INT AS at_stop,
  (Name IS NOT NULL AND sog <= 1)::INT AS in_port, (Name IS NULL AND sog > 1 AND sog <= 3)::INT AS off_zone
FROM wide""", ALL_TAGGED)
add("identity_split", """
SELECT imo AS ship_id, count(*) AS n_positions, 'imo' AS kind FROM positions WHERE imo IS NOT NULL GROUP BY imo
UNION ALL
SELECT mmsi, count(*), 'mmsi' FROM positions WHERE imo IS NULL GROUP BY mmsi""")

# ---- Tracks -----------------------------------------------------------------

SHIP_ROWS = """
ship_rows AS (
  SELECT *, coalesce(imo, -mmsi) AS ship FROM positions
  QUALIFY row_number() OVER (PARTITION BY coalesce(imo, -mmsi), t_s ORDER BY event_id) = 1)"""
add("dedup_positions", """
SELECT ship, dt_pos_utc, event_id, round(sog, 6) AS sog FROM (
  SELECT coalesce(imo, -mmsi) AS ship, t_s AS dt_pos_utc, event_id, sog FROM positions
  UNION ALL
  SELECT coalesce(imo, -mmsi), t_s, event_id + 100000000, sog + 1 FROM positions WHERE event_id % 3 = 0)
QUALIFY row_number() OVER (PARTITION BY ship, dt_pos_utc ORDER BY event_id) = 1""")
add("time_extent", "SELECT min(t_s) AS from_time, max(t_s) AS to_time FROM positions")
add("track_rownum", "SELECT ship, event_id, row_number() OVER (PARTITION BY ship ORDER BY t_s, event_id) AS row FROM canal")
add("track_lag", """
SELECT ship, event_id, lag(Name) OVER w AS Name_lag, lag(t_s) OVER w AS dt_lag
FROM canal WINDOW w AS (PARTITION BY ship ORDER BY t_s, event_id)""")
add("gap_islands", """
SELECT ship, event_id, CAST(sum(CASE WHEN gap > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY ship ORDER BY t_s, event_id) AS BIGINT) AS island
FROM (SELECT *, t_s - lag(t_s) OVER (PARTITION BY ship ORDER BY t_s, event_id) AS gap FROM canal)""")
FREQ = "(t_s - lag(t_s) OVER (PARTITION BY ship ORDER BY t_s, event_id)) / 3600"
add("track_freq", f"""
SELECT ship, event_id, round(freq, 6) AS freq FROM (SELECT ship, event_id, {FREQ} AS freq FROM canal) WHERE freq <= 1""")
add("interpolate_track", """
SELECT ship, t_s AS dt_pos_utc, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, 0 AS interpolated FROM ship_rows
UNION ALL
SELECT ship, t_s + k * 600, round(latitude + (lat2 - latitude) * (k * 600.0::DOUBLE / gap), 6),
  round(longitude + (lon2 - longitude) * (k * 600.0::DOUBLE / gap), 6), 1
FROM (SELECT *, lead(t_s) OVER w - t_s AS gap, lead(latitude) OVER w AS lat2, lead(longitude) OVER w AS lon2
      FROM ship_rows WINDOW w AS (PARTITION BY ship ORDER BY t_s, event_id)), range(1, 13) r(k)
WHERE gap <= 7200 AND k * 600 < gap""", SHIP_ROWS)

# ---- Ports ------------------------------------------------------------------

HARBOUR = """
stopped AS (
  SELECT *, CASE WHEN lag(t_s) OVER w IS NULL OR Name <> lag(Name) OVER w OR t_s - lag(t_s) OVER w > 86400 THEN 1 ELSE 0 END AS fresh
  FROM harbour WHERE Name IS NOT NULL AND sog <= 1 WINDOW w AS (PARTITION BY imo, mmsi ORDER BY t_s, event_id)),
grouped AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY imo, mmsi ORDER BY t_s, event_id) AS BIGINT) AS group_id FROM stopped),
port_ev AS (
  SELECT imo, mmsi, group_id AS port_group_id, min(Name) AS port_name, min(t_s) AS port_start, max(t_s) AS port_end
  FROM grouped GROUP BY imo, mmsi, group_id HAVING max(t_s) - min(t_s) >= 3600),
drifting AS (
  SELECT *, CASE WHEN lag(t_s) OVER w IS NULL OR t_s - lag(t_s) OVER w > 3600 THEN 1 ELSE 0 END AS fresh
  FROM harbour WHERE Name IS NULL AND sog > 1 AND sog <= 3 WINDOW w AS (PARTITION BY imo, mmsi ORDER BY t_s, event_id)),
anch_ev AS (
  SELECT imo, mmsi, gid AS anchorage_group_id, min(t_s) AS anch_start, max(t_s) AS anch_end
  FROM (SELECT *, CAST(sum(fresh) OVER (PARTITION BY imo, mmsi ORDER BY t_s, event_id) AS BIGINT) AS gid FROM drifting)
  GROUP BY imo, mmsi, gid),
both_ev AS (
  SELECT imo, mmsi, port_group_id AS group_id, port_name, port_start AS event_start, port_end AS event_end, 2 AS anch1_port2 FROM port_ev
  UNION ALL
  SELECT imo, mmsi, anchorage_group_id, 'anch', anch_start, anch_end, 1 FROM anch_ev),
sequence AS (
  SELECT *, lead(anch1_port2) OVER w AS next_type, lead(group_id) OVER w AS next_group_id,
    lead(event_start) OVER w AS next_start, lead(port_name) OVER w AS next_port_name,
    lead(event_start) OVER w - event_end AS time_to_next
  FROM both_ev WINDOW w AS (PARTITION BY imo, mmsi ORDER BY event_start)),
links AS (
  SELECT imo, mmsi, group_id AS anchorage_group_id, event_start AS anch_start, event_end AS anch_end, next_group_id AS port_group_id
  FROM sequence WHERE anch1_port2 = 1 AND next_type = 2 AND time_to_next <= 3600)"""
add("port_groups", "SELECT imo, mmsi, event_id, group_id FROM grouped", HARBOUR)
add("port_events", "SELECT * FROM port_ev", HARBOUR)
add("anchorage_events", "SELECT * FROM anch_ev", HARBOUR)
add("event_sequence", "SELECT * FROM sequence", HARBOUR)
add("anch_port_links", "SELECT * FROM links", HARBOUR)
add("port_calls", """
SELECT p.*, anchorage_group_id, anch_start, anch_end, length, beam, StandardVesselType, GrossTonnage
FROM port_ev p
LEFT JOIN links l ON p.imo IS NOT DISTINCT FROM l.imo AND p.mmsi = l.mmsi AND p.port_group_id = l.port_group_id
LEFT JOIN result_specs s ON s.mmsi = p.mmsi""", HARBOUR)

# ---- Specifications ---------------------------------------------------------

VERSIONED = """
versioned AS (SELECT p.*, version FROM positions p LEFT JOIN version_rows ON t_s >= v_from AND t_s <= v_to),
ships AS (SELECT DISTINCT imo, mmsi, vessel_type_main, length, width, version FROM versioned),
matched AS (
  SELECT r.mmsi, r.version, r.imo, Speed, GrossTonnage, vessel_type_main, length, width
  FROM registry r JOIN ships s ON r.mmsi = s.mmsi AND r.version = s.version
  QUALIFY row_number() OVER (PARTITION BY r.mmsi, r.version ORDER BY GrossTonnage) = 1)"""
add("version_join", "SELECT event_id, t_s AS dt_pos_utc, version FROM versioned", VERSIONED)
add("distinct_ships", "SELECT * FROM ships", VERSIONED)
add("match_specs", "SELECT * FROM matched", VERSIONED)
add("adapt_specs", """
SELECT mmsi, version, GrossTonnage, StandardVesselType, CAST(imobin AS INTEGER) AS imobin FROM matched
LEFT JOIN type_bins ON vessel_type_main = vessel_type AND GrossTonnage >= lo AND GrossTonnage < hi""", VERSIONED)
add("enrich_specs", """
SELECT event_id, v.version, Speed, StandardVesselType FROM versioned v JOIN specs s ON v.mmsi = s.mmsi AND v.version = s.version""",
    VERSIONED)

# ---- Phase and emissions ----------------------------------------------------

NEAR = """
nearby AS (
  SELECT *, (H3_int_4 IN (SELECT H3_int_4 FROM coast_5)) AS coast5, (H3_int_8 IN (SELECT H3_int_8 FROM port_1)) AS port1,
    (H3_int_8 IN (SELECT H3_int_8 FROM port_5)) AS port5 FROM positions)"""
add("near_coast_port", "SELECT event_id, coast5::INT AS coast5, port1::INT AS port1, port5::INT AS port5 FROM nearby", NEAR)

FACTORS = """
factor_rows AS (
  SELECT s.*, build_year AS YearOfBuild, a.* EXCLUDE (StandardVesselType, imobin), weather, fouling,
    CASE WHEN build_year <= 1983 THEN m.y83 WHEN build_year <= 2000 THEN m.y84 WHEN build_year >= 2001 THEN m.y01 END AS sfc_base,
    CASE WHEN build_year IS NULL THEN 0 WHEN build_year <= 1983 THEN e.y83 WHEN build_year <= 2000 THEN e.y84 ELSE e.y01 END AS sfc_ae,
    CASE WHEN build_year IS NULL THEN 0 WHEN build_year <= 1983 THEN b.y83 WHEN build_year <= 2000 THEN b.y84 ELSE b.y01 END AS sfc_ab,
    pilot_mdo, ef_co2, c.ef_ch4, ca.ef_ch4 AS ef_ch4_ae, cb.ef_ch4 AS ef_ch4_ab,
    n.ef_n2o, na.ef_n2o AS ef_n2o_ae, nb.ef_n2o AS ef_n2o_ab
  FROM specs s
  LEFT JOIN table_17 a ON a.StandardVesselType = s.StandardVesselType AND a.imobin = s.imobin
  LEFT JOIN table_44 w ON w.StandardVesselType = s.StandardVesselType AND w.imobin = s.imobin
  LEFT JOIN table_19_1 m ON m.meType = s.meType AND m.fuel = s.fuel
  LEFT JOIN table_19_2 e ON e.meType = 'AE' AND e.fuel = s.fuel
  LEFT JOIN table_19_2 b ON b.meType = 'AB' AND b.fuel = s.fuel
  LEFT JOIN table_21 t ON t.fuel = s.fuel
  LEFT JOIN table_55_56 c ON c.meType = s.meType AND c.fuel = s.fuel
  LEFT JOIN table_55_56 ca ON ca.meType = 'AE' AND ca.fuel = s.fuel
  LEFT JOIN table_55_56 cb ON cb.meType = 'AB' AND cb.fuel = s.fuel
  LEFT JOIN table_59_60 n ON n.meType = s.meType AND n.fuel = s.fuel
  LEFT JOIN table_59_60 na ON na.meType = 'AE' AND na.fuel = s.fuel
  LEFT JOIN table_59_60 nb ON nb.meType = 'AB' AND nb.fuel = s.fuel)"""
_factor_cols = [
    "ae_sea", "ab_berth", "weather", "fouling", "sfc_base", "sfc_ae", "sfc_ab", "pilot_mdo", "ef_co2",
    "ef_ch4", "ef_ch4_ae", "ef_ch4_ab", "ef_n2o", "ef_n2o_ae", "ef_n2o_ab",
]
add("emission_factors", "SELECT mmsi, version, YearOfBuild, " + ", ".join(f"round({c}, 6) AS {c}" for c in _factor_cols)
    + " FROM factor_rows", FACTORS)

ENERGY = NEAR + "," + FACTORS + "," + SHIP_ROWS + f""",
timed AS (
  SELECT r.*, f.* EXCLUDE (mmsi), sog / nullif(Speed, 0) AS load,
    (t_s - lag(t_s) OVER (PARTITION BY ship ORDER BY t_s, event_id)) / 3600 AS freq
  FROM (SELECT *, coalesce(imo, -mmsi) AS ship FROM positions) r JOIN version_rows v ON t_s BETWEEN v_from AND v_to
  JOIN factor_rows f ON f.mmsi = r.mmsi AND f.version = v.version),
phased AS (
  SELECT t.*, CASE
    WHEN t.sog <= 1 THEN CASE WHEN port5 THEN 'Berth' ELSE 'Anchorage' END
    WHEN t.sog <= 3 THEN 'Anchorage'
    WHEN t.sog <= 5 THEN CASE WHEN NOT coast5 AND NOT port5 THEN CASE WHEN load <= 0.65 THEN 'Slow transit' ELSE 'Normal cruising' END
                         ELSE 'Manoeuvring' END
    WHEN t.sog > 5 THEN CASE
      WHEN port5 AND StandardVesselType IN {names(K.TANKER_TYPES)} THEN CASE WHEN load <= 0.65 THEN 'Slow transit' ELSE 'Normal cruising' END
      WHEN port1 THEN 'Manoeuvring' WHEN load <= 0.65 THEN 'Slow transit' ELSE 'Normal cruising' END
    END AS op_phase
  FROM timed t JOIN nearby USING (event_id) WHERE freq <= 1),
energy AS (
  SELECT *,
    CASE WHEN Powerkwmax <= 150 THEN 0 WHEN Powerkwmax BETWEEN 151 AND 500 THEN 0.05::DOUBLE * Powerkwmax * freq
      ELSE freq * CASE op_phase WHEN 'Berth' THEN ae_berth WHEN 'Manoeuvring' THEN ae_man WHEN 'Anchorage' THEN ae_anch ELSE ae_sea END
      END AS ae_ene,
    CASE WHEN Powerkwmax <= 150 THEN 0
      ELSE freq * CASE op_phase WHEN 'Berth' THEN ab_berth WHEN 'Manoeuvring' THEN ab_man WHEN 'Anchorage' THEN ab_anch ELSE ab_sea END
      END AS ab_ene,
    CASE WHEN op_phase IN ('Berth', 'Anchorage') THEN 0
      ELSE CASE WHEN StandardVesselType = 'Cruise' THEN 0.70::DOUBLE WHEN StandardVesselType = 'Container' AND imobin IN (8, 9) THEN 0.75::DOUBLE
           ELSE 1 END * Powerkwmax * pow(draught / nullif(SummerDraught, 0), 0.66::DOUBLE) * pow(load, 3) / (weather * fouling) END AS me_pow
  FROM phased),
used AS (
  SELECT *, me_pow * freq AS me_ene,
    sfc_base * CASE WHEN meType IN ('SSD', 'MSD', 'HSD')
      THEN 0.455::DOUBLE * load * load - 0.710::DOUBLE * load + 1.280::DOUBLE ELSE 1 END AS sfc_me
  FROM energy),
burnt AS (
  SELECT *, me_ene * sfc_me AS me_con, ae_ene * sfc_ae AS ae_con, ab_ene * sfc_ab AS ab_con,
    coalesce(me_ene * pilot_mdo, 0) AS pilot_con,
    CASE WHEN load < 0.02::DOUBLE THEN 21.18::DOUBLE WHEN load BETWEEN 0.02::DOUBLE AND 0.1::DOUBLE THEN 2.18::DOUBLE
         WHEN load BETWEEN 0.1001::DOUBLE AND 0.2::DOUBLE THEN 1.0::DOUBLE ELSE ef_ch4 END AS low_ch4,
    CASE WHEN load < 0.02::DOUBLE THEN 4.63::DOUBLE WHEN load BETWEEN 0.02::DOUBLE AND 0.1::DOUBLE THEN 1.22::DOUBLE
         WHEN load BETWEEN 0.1001::DOUBLE AND 0.2::DOUBLE THEN 1.0::DOUBLE ELSE ef_n2o END AS low_n2o
  FROM used),
emitted AS (
  SELECT *, (me_con + ae_con + ab_con) * ef_co2 + pilot_con * 3.206::DOUBLE AS co2_g,
    me_ene * low_ch4 + ae_ene * ef_ch4_ae + ab_ene * ef_ch4_ab AS ch4_g,
    me_ene * low_n2o + ae_ene * ef_n2o_ae + ab_ene * ef_n2o_ab AS n2o_g
  FROM burnt),
tonnes AS (
  SELECT *, co2_g * 1e-6 AS co2_t, ch4_g * 1e-6 AS ch4_t, n2o_g * 1e-6 AS n2o_t FROM emitted),
long_form AS (
  SELECT event_id, t_s, StandardVesselType, H3_int_index_6, gas AS emission_type,
    CASE gas WHEN 'co2_t' THEN co2_t WHEN 'ch4_t' THEN ch4_t ELSE n2o_t END AS emission_value
  FROM tonnes, (VALUES ('co2_t'), ('ch4_t'), ('n2o_t')) g(gas)),
monthly AS (
  SELECT CAST(year(to_timestamp(t_s) AT TIME ZONE 'UTC') AS INTEGER) AS year,
    CAST(month(to_timestamp(t_s) AT TIME ZONE 'UTC') AS INTEGER) AS month, emission_type,
    StandardVesselType, 6 AS h3resolution, H3_int_index_6 AS resolution_id, sum(coalesce(emission_value, 0)) AS emission_value
  FROM long_form GROUP BY ALL)"""


def _rounded(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


add("op_phase", f"SELECT event_id, {_rounded('sog', 'load')}, op_phase FROM phased", ENERGY)
add("aux_energy", f"SELECT event_id, {_rounded('ae_ene', 'ab_ene')} FROM energy", ENERGY)
add("main_energy", f"SELECT event_id, {_rounded('me_pow', 'me_ene')} FROM used", ENERGY)
add("fuel_use", f"SELECT event_id, {_rounded('sfc_me', 'sfc_ae', 'sfc_ab', 'me_con', 'ae_con', 'ab_con', 'pilot_con')} FROM burnt",
    ENERGY)
add("co2", f"SELECT event_id, {_rounded('co2_g')} FROM emitted", ENERGY)
add("ch4_n2o", f"SELECT event_id, {_rounded('ch4_g', 'n2o_g')} FROM emitted", ENERGY)
add("emissions", """
SELECT event_id, op_phase, round(freq, 6) AS freq, round(co2_t * 1e6, 6) AS co2_g, round(ch4_t * 1e6, 6) AS ch4_g,
  round(n2o_t * 1e6, 6) AS n2o_g FROM tonnes""", ENERGY)
add("unpivot_emissions", "SELECT event_id, emission_type, round(emission_value * 1e6, 6) AS emission_value FROM long_form", ENERGY)
add("local_emissions", f"SELECT * REPLACE (round(emission_value, 6) AS emission_value) FROM monthly", ENERGY)
add("null_emissions", """
SELECT count(*) FILTER (co2_t IS NULL) AS co2_t_null, count(*) FILTER (ch4_t IS NULL) AS ch4_t_null,
  count(*) FILTER (n2o_t IS NULL) AS n2o_t_null FROM tonnes""", ENERGY)
add("merge_emissions", """
SELECT year, month, emission_type, StandardVesselType, h3resolution, resolution_id, round(sum(emission_value), 6) AS emission_value
FROM (SELECT * FROM monthly UNION ALL
      SELECT * REPLACE (nullif(StandardVesselType, 'Cruise') AS StandardVesselType, emission_value * 2 AS emission_value)
      FROM monthly)
GROUP BY ALL""", ENERGY)

# ---- Transits ---------------------------------------------------------------

TRANSIT = f"""
lagged AS (
  SELECT *, lag(Name) OVER w AS name_lag, lag(t_s) OVER w AS t_lag FROM canal WINDOW w AS (PARTITION BY ship ORDER BY t_s, event_id)),
seg AS (
  SELECT *, CAST(sum(CASE WHEN t_s - t_lag >= 259200 OR Name <> name_lag THEN 1 ELSE 0 END)
                 OVER (PARTITION BY ship ORDER BY t_s, event_id) AS BIGINT) AS segr FROM lagged),
heads AS (
  SELECT *, Name IN {ANCH} AND row_number() OVER (PARTITION BY ship, segr ORDER BY t_s, event_id) = 1 AS is_anchor FROM seg),
compared AS (
  SELECT *, CASE WHEN is_anchor THEN lag(Name) OVER (PARTITION BY ship, is_anchor ORDER BY t_s, event_id) END AS before_name FROM heads),
changes AS (
  SELECT *, coalesce(Name = before_name, false) AS repeats, coalesce(Name <> before_name, false) AS differs FROM compared),
settled AS (
  SELECT *, sum(CASE WHEN differs OR after_repeat THEN 1 ELSE 0 END) OVER (PARTITION BY ship ORDER BY t_s, event_id) AS settler
  FROM (SELECT *, coalesce(lag(repeats) OVER (PARTITION BY ship ORDER BY t_s, event_id), false) AS after_repeat FROM changes)),
ported AS (
  SELECT *, max(repeats) OVER (PARTITION BY ship, settler ORDER BY t_s, event_id DESC)
            AND max(Name IN {PORTS}) OVER (PARTITION BY ship, settler ORDER BY t_s, event_id) AS port_seen FROM settled),
judged AS (SELECT *, coalesce(lead(port_seen) OVER (PARTITION BY ship, is_anchor ORDER BY t_s, event_id), false) AS next_port_seen FROM ported),
left_over AS (SELECT * FROM judged WHERE is_anchor AND NOT next_port_seen),
runs AS (
  SELECT *, CAST(sum(CASE WHEN Name = prior THEN 1 ELSE 0 END) OVER (PARTITION BY ship ORDER BY t_s, event_id) AS BIGINT) AS run
  FROM (SELECT *, lag(Name) OVER (PARTITION BY ship ORDER BY t_s, event_id) AS prior FROM left_over)),
sized AS (
  SELECT *, count(*) OVER (PARTITION BY ship, run) AS size,
    lead(t_s) OVER (PARTITION BY ship, run ORDER BY t_s, event_id) - t_s AS wait FROM runs),
trimmed AS (
  SELECT *, count(*) OVER (PARTITION BY ship, run) AS remaining FROM sized
  WHERE size = 2 OR (size > 2 AND (wait IS NULL OR wait <= 345600))),
accepted AS (
  SELECT *, row_number() OVER (PARTITION BY ship, run ORDER BY t_s, event_id) AS run_row FROM trimmed WHERE remaining = 2),
pairs AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY ship ORDER BY t_s, event_id) AS BIGINT) AS flag, lead(segr) OVER w AS close_segr, lead(t_s) OVER w AS close_t
  FROM accepted WINDOW w AS (PARTITION BY ship, run ORDER BY t_s, event_id)),
opened AS (SELECT ship, flag, segr AS open_segr, close_segr, Name AS open_zone, t_s AS open_t, close_t FROM pairs WHERE run_row = 1),
member AS (
  SELECT s.*, flag, open_zone, s.segr = close_segr AS is_close
  FROM seg s JOIN opened o ON s.ship = o.ship AND s.t_s BETWEEN open_t AND close_t),
accessed AS (
  SELECT * FROM member
  QUALIFY max(Name IN ('Atlantic Access', 'Pacific Access')) OVER (PARTITION BY ship, flag)),
lock_moves AS (
  SELECT *,
    CASE WHEN Name IN {names(K.ORIGINAL_LOCK_PAIR)} THEN Name <> lag(Name) OVER (PARTITION BY ship, flag, Name IN {names(K.ORIGINAL_LOCK_PAIR)} ORDER BY t_s, event_id) END AS orig_move,
    CASE WHEN Name IN {names(K.NEO_LOCK_PAIR)} THEN Name <> lag(Name) OVER (PARTITION BY ship, flag, Name IN {names(K.NEO_LOCK_PAIR)} ORDER BY t_s, event_id) END AS neo_move
  FROM accessed),
lock_tests AS (
  SELECT *, max(Name IN {names(K.ORIGINAL_LOCK_PAIR)}) OVER g AS orig_any, max(Name IN {names(K.NEO_LOCK_PAIR)}) OVER g AS neo_any,
    coalesce(max(orig_move) OVER g, false) AS orig_moved, coalesce(max(neo_move) OVER g, false) AS neo_moved
  FROM lock_moves WINDOW g AS (PARTITION BY ship, flag)),
locked AS (SELECT *, neo_any::INT AS neo_transit FROM lock_tests WHERE orig_any OR neo_any),
candidates AS (
  SELECT *, CASE WHEN Name IN {ANCH} AND anch_changes = 0 THEN 1 END AS anchoring_group,
    CASE WHEN Name IN {names(K.PORTS + K.STOPS)} THEN 1 END AS port_group,
    CASE WHEN open_zone = 'Atlantic Anchorage' THEN 'South' ELSE 'North' END AS dir,
    CAST(sum(CASE WHEN Name <> name_lag THEN 1 ELSE 0 END) OVER (PARTITION BY ship, flag ORDER BY t_s, event_id) AS BIGINT) AS new_segr
  FROM (SELECT *, sum(CASE WHEN anch_move THEN 1 ELSE 0 END) OVER (PARTITION BY ship, flag, Name IN {ANCH} ORDER BY t_s, event_id) AS anch_changes
        FROM (SELECT *, Name <> lag(Name) OVER (PARTITION BY ship, flag, Name IN {ANCH} ORDER BY t_s, event_id) AS anch_move FROM locked))),
stays AS (
  SELECT imo, mmsi, flag, min(t_s) AS anchoring_in, max(t_s) AS anchoring_out, min(Name) AS anch_area
  FROM candidates WHERE Name IN {ANCH} AND sog < 3 GROUP BY imo, mmsi, flag, new_segr),
stop_rows AS (
  SELECT imo, mmsi, flag, min(t_s) AS stop_time_in, max(t_s) AS stop_time_out, min(Name) AS stop_area
  FROM candidates WHERE (Name = 'Gatun Anchorage' AND sog < 3) OR (Name IN {PORTS} AND sog < 1)
  GROUP BY imo, mmsi, flag, new_segr),
in_locks AS (SELECT * FROM candidates WHERE Name IN {LOCKS}),
lock_rows AS (
  SELECT imo, mmsi, flag, max(neo_transit) AS neo_transit, min(t_s) AS lock_in, max(t_s) AS lock_out,
    arg_min(Name, t_s) AS first_lock_name, arg_max(Name, t_s) AS last_lock_name,
    CASE WHEN arg_min(Name, t_s) IN ('Miraflores Locks Original', 'Cocoli Locks') THEN 'North' ELSE 'South' END AS direction
  FROM in_locks GROUP BY imo, mmsi, flag),
draughts AS (
  SELECT imo, mmsi, flag, draught FROM (SELECT imo, mmsi, flag, draught, count(*) AS n FROM in_locks GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY imo, mmsi, flag ORDER BY draught IS NULL, n DESC, draught) = 1),
directs AS (
  SELECT imo, mmsi, flag, CASE WHEN EXISTS (
      SELECT 1 FROM stop_rows s WHERE s.imo IS NOT DISTINCT FROM l.imo AND s.mmsi = l.mmsi AND s.flag = l.flag)
    THEN 0 ELSE 1 END AS direct_transit
  FROM lock_rows l),
transit_rows AS (
  SELECT l.imo, l.mmsi, l.flag, lock_in, lock_out, anchoring_in, anchoring_out, direct_transit, direction, neo_transit, draught
  FROM lock_rows l
  JOIN directs d ON d.imo IS NOT DISTINCT FROM l.imo AND d.mmsi = l.mmsi AND d.flag = l.flag
  JOIN draughts r ON r.imo IS NOT DISTINCT FROM l.imo AND r.mmsi = l.mmsi AND r.flag = l.flag
  LEFT JOIN stays s ON s.imo IS NOT DISTINCT FROM l.imo AND s.mmsi = l.mmsi AND s.flag = l.flag)"""

add("transit_segments", "SELECT ship, event_id, segr FROM seg", TRANSIT)
add("stay_spans", "SELECT ship, segr, min(Name) AS Name, min(t_s) AS seg_start, max(t_s) AS seg_end FROM seg GROUP BY ship, segr", TRANSIT)
add("transit_anchors", "SELECT ship, segr, Name, t_s AS seg_start FROM heads WHERE is_anchor", TRANSIT)
add("transit_port_filter", "SELECT ship, segr, Name, t_s AS seg_start FROM left_over", TRANSIT)
add("transit_pairs", "SELECT ship, segr, run, CAST(run_row AS INTEGER) AS run_row FROM accepted", TRANSIT)
add("transit_flags", "SELECT ship, flag, open_segr, close_segr, open_zone FROM opened", TRANSIT)
add("transit_access", "SELECT DISTINCT ship, flag, segr, is_close::INT AS is_close FROM accessed", TRANSIT)
add("transit_locks", "SELECT DISTINCT ship, flag, segr, neo_transit FROM locked", TRANSIT)
add("transit_locks_strict", """
SELECT DISTINCT ship, flag, segr, neo_moved::INT AS neo_transit FROM lock_tests WHERE orig_moved OR neo_moved""", TRANSIT)
add("transit_candidates", """
SELECT imo, mmsi, event_id, t_s AS dt_pos_utc, Name, flag, new_segr AS segr, neo_transit, anchoring_group, port_group, dir
FROM candidates""", TRANSIT)
add("anchorage_stays", "SELECT * FROM stays", TRANSIT)
add("transit_stops", "SELECT * FROM stop_rows", TRANSIT)
add("lock_summary", "SELECT * FROM lock_rows", TRANSIT)
add("draught_mode", "SELECT * FROM draughts", TRANSIT)
add("direct_transit", "SELECT * FROM directs", TRANSIT)
add("transits", "SELECT t.*, length, beam, StandardVesselType, GrossTonnage FROM transit_rows t LEFT JOIN result_specs s ON s.mmsi = t.mmsi", TRANSIT)
add("transits_from_registry", """
SELECT t.*, length, beam, StandardVesselType, GrossTonnage FROM transit_rows t LEFT JOIN newest s ON s.mmsi = t.mmsi""", f"""{VERSIONED},
newest AS (
  SELECT m.mmsi, s.ais_loa AS length, s.ais_beam AS beam, b.StandardVesselType, m.GrossTonnage
  FROM matched m JOIN specs s ON s.mmsi = m.mmsi AND s.version = m.version
  LEFT JOIN type_bins b ON m.vessel_type_main = b.vessel_type AND m.GrossTonnage >= lo AND m.GrossTonnage < hi
  QUALIFY row_number() OVER (PARTITION BY m.mmsi ORDER BY m.version DESC) = 1),{TRANSIT}""")
add("transit_tables", """
SELECT 'transit' AS kind, imo, mmsi, flag, lock_in AS from_time, lock_out AS to_time, direction AS what FROM transit_rows
UNION ALL SELECT 'stop', imo, mmsi, flag, stop_time_in, stop_time_out, stop_area FROM stop_rows""", TRANSIT)
add("transits_one_row", """
SELECT t.*, length, beam, StandardVesselType, GrossTonnage FROM transit_rows t LEFT JOIN result_specs s ON s.mmsi = t.mmsi
QUALIFY row_number() OVER (PARTITION BY imo, t.mmsi, flag ORDER BY anchoring_in) = 1""", TRANSIT)
add("merge_overlaps", """
SELECT imo, mmsi, min(lock_in) AS lock_in, max(late) AS late, min(direct_transit) AS direct_transit, min(anchoring_in) AS anchoring_in
FROM (SELECT *, sum(CASE WHEN lock_in <= seen THEN 0 ELSE 1 END) OVER (PARTITION BY imo, mmsi ORDER BY lock_in, late, rid) AS grp
      FROM (SELECT *, max(late) OVER (PARTITION BY imo, mmsi ORDER BY lock_in, late, rid
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
            FROM (SELECT *, lock_out + 432000 AS late, row_number() OVER () AS rid FROM transit_rows)))
GROUP BY imo, mmsi, grp""", TRANSIT)

# ---- Port stops -------------------------------------------------------------

STOPS = f"""
stop_base AS (SELECT * FROM tagged),
calls AS (
  SELECT *, lag(t_s) OVER w AS t_lag, lag(Name) OVER w AS name_lag FROM stop_base WHERE Name IN {PORTS} OR Name IN {ANCH}
  WINDOW w AS (PARTITION BY mmsi ORDER BY t_s, event_id)),
visits AS (
  SELECT *, CAST(sum(CASE WHEN t_s - t_lag >= 259200 OR (Name IN {ANCH} AND name_lag IN {PORTS}) THEN 1 ELSE 0 END)
      OVER (PARTITION BY mmsi ORDER BY t_s, event_id) AS BIGINT) AS flag,
    CAST(sum(CASE WHEN Name <> name_lag THEN 1 ELSE 0 END) OVER (PARTITION BY mmsi ORDER BY t_s, event_id) AS BIGINT) AS segr
  FROM calls),
tested AS (
  SELECT *, max(Name IN {PORTS}) OVER v AS has_port, max(Name IN {ANCH}) OVER v AS has_anchorage
  FROM visits WINDOW v AS (PARTITION BY mmsi, flag)),
cut AS (
  SELECT *, CASE WHEN sog <= 1 AND Name IN {PORTS} THEN 'Berth' WHEN sog <= 3 THEN 'Anchorage' ELSE 'Manoeuvring' END AS op_phase
  FROM tested WHERE has_port AND has_anchorage)"""


def merged(source: str, target: str, reference: str, limit: int) -> str:
    """CTE that gives reference-phase rows the previous row's original segment."""
    return f"""
{target} AS (
  SELECT * EXCLUDE (p_phase, p_segr, p_t)
    REPLACE (CASE WHEN op_phase = '{reference}' AND p_phase = '{reference}' AND t_s - p_t <= {limit} THEN p_segr ELSE segr END AS segr)
  FROM (SELECT *, lag(op_phase) OVER w AS p_phase, lag(segr) OVER w AS p_segr, lag(t_s) OVER w AS p_t
        FROM {source} WINDOW w AS (PARTITION BY mmsi, flag ORDER BY t_s, event_id)))"""


def records(source: str, prefix: str = "") -> str:
    return f"""
{prefix}berths AS (
  SELECT flag, mmsi, segr, min(t_s) AS berth_min_dt_pos_utc, max(t_s) AS berth_max_dt_pos_utc
  FROM {source} WHERE op_phase = 'Berth' GROUP BY flag, mmsi, segr),
{prefix}waits AS (
  SELECT flag, mmsi, segr, min(t_s) AS anchorage_min_dt_pos_utc, max(t_s) AS anchorage_max_dt_pos_utc
  FROM (SELECT *, lead(t_s) OVER (PARTITION BY flag, mmsi ORDER BY t_s, event_id) AS nxt FROM {source} WHERE op_phase = 'Anchorage')
  WHERE t_s < nxt GROUP BY flag, mmsi, segr),
{prefix}full_waits AS (
  SELECT flag, mmsi, segr, min(t_s) AS anchorage_min_dt_pos_utc, max(t_s) AS anchorage_max_dt_pos_utc
  FROM {source} WHERE op_phase = 'Anchorage' GROUP BY flag, mmsi, segr),
{prefix}visit_names AS (SELECT mmsi, flag, arg_min(Name, t_s) AS mode_name FROM {source} WHERE op_phase = 'Berth' GROUP BY mmsi, flag)"""


_RECORDS = """
SELECT b.flag, b.mmsi, mode_name, berth_min_dt_pos_utc, berth_max_dt_pos_utc, anchorage_min_dt_pos_utc, anchorage_max_dt_pos_utc
FROM berths b LEFT JOIN waits a ON a.flag = b.flag AND a.mmsi = b.mmsi LEFT JOIN visit_names n ON n.flag = b.flag AND n.mmsi = b.mmsi"""

add("port_stops_cutoff", "SELECT mmsi, event_id, Name, flag, segr FROM cut", STOPS)
add("visit_tests", """
SELECT DISTINCT mmsi, flag, has_port::INT AS has_port, has_anchorage::INT AS has_anchorage FROM tested""", STOPS)
add("merge_stop_segments", "SELECT mmsi, event_id, flag, segr FROM m1", STOPS + "," + merged("cut", "m1", "Anchorage", 21600))
add("merge_stop_islands", """
SELECT mmsi, event_id, flag, first_value(segr) OVER (PARTITION BY mmsi, flag, isle ORDER BY t_s, event_id) AS segr
FROM (SELECT *, sum(CASE WHEN op_phase = 'Anchorage' AND p_phase = 'Anchorage' AND t_s - p_t <= 21600 THEN 0 ELSE 1 END)
             OVER (PARTITION BY mmsi, flag ORDER BY t_s, event_id) AS isle
      FROM (SELECT *, lag(op_phase) OVER w AS p_phase, lag(t_s) OVER w AS p_t FROM cut
            WINDOW w AS (PARTITION BY mmsi, flag ORDER BY t_s, event_id)))""", STOPS)
add("berth_spans", "SELECT * FROM berths", STOPS + "," + records("cut"))
add("visit_name", "SELECT * FROM visit_names", STOPS + "," + records("cut"))
add("visit_name_mode", """
SELECT mmsi, flag, Name AS mode_name FROM (SELECT mmsi, flag, Name, count(*) AS n FROM cut WHERE op_phase = 'Berth' GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY mmsi, flag ORDER BY n DESC, Name) = 1""", STOPS)
add("berth_anchorage", _RECORDS, STOPS + "," + records("cut"))
add("berth_anchorage_nearest", """
SELECT b.flag, b.mmsi, mode_name, berth_min_dt_pos_utc, berth_max_dt_pos_utc, anchorage_min_dt_pos_utc, anchorage_max_dt_pos_utc
FROM berths b ASOF LEFT JOIN full_waits a ON a.flag = b.flag AND a.mmsi = b.mmsi AND b.berth_min_dt_pos_utc > a.anchorage_max_dt_pos_utc
LEFT JOIN visit_names n ON n.flag = b.flag AND n.mmsi = b.mmsi""", STOPS + "," + records("cut"))
add("port_ships", "SELECT DISTINCT mmsi FROM cut", STOPS)
add("port_stop_records", _RECORDS, STOPS + "," + NEAR + f""",
spec_stops AS (
  SELECT c.* EXCLUDE (op_phase), CASE
    WHEN sog <= 1 THEN CASE WHEN port5 THEN 'Berth' ELSE 'Anchorage' END WHEN sog <= 3 THEN 'Anchorage' ELSE 'moving' END AS op_phase
  FROM cut c JOIN version_rows v ON t_s BETWEEN v_from AND v_to JOIN specs s ON s.mmsi = c.mmsi AND s.version = v.version
  JOIN (SELECT event_id, port5 FROM nearby) n USING (event_id)),""" + merged("spec_stops", "m1", "Anchorage", 3600) + ","
    + merged("m1", "m2", "Berth", 3600) + "," + records("m2"))

# ---- Incremental runs -------------------------------------------------------

add("scan_positions", f"""
SELECT event_id, t_s AS dt_pos_utc, H3_int_index_5 FROM positions
WHERE t_s BETWEEN {fx.EPOCH + 4 * 86400} AND {fx.EPOCH + 40 * 86400 + 43200}
  AND H3_int_index_5 IN (SELECT H3_int_index_5 FROM positions WHERE sog > 17)""")
ORACLES["scan_with_index"] = ORACLES["scan_positions"]
add("processed_ranges", """
SELECT strftime(from_date, '%Y-%m-%d') AS from_date, strftime(to_date, '%Y-%m-%d') AS to_date FROM transit_ranges""")
add("next_range", """
SELECT strftime(a, '%Y-%m-%d') AS from_date, '2001-08-31' AS to_date, (a < DATE '2001-08-31')::INT AS valid
FROM (SELECT greatest(max(from_date), max(to_date) - 15) AS a FROM transit_ranges)""")
add("freshness", f"SELECT max(t_s) AS newest, (max(t_s) >= {fx.EPOCH + 31 * 86400})::INT AS fresh FROM positions")
add("days_to_do", """
SELECT strftime(d, '%Y-%m-%d') AS day
FROM (SELECT unnest(generate_series(min(from_date)::TIMESTAMP, max(to_date)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM transit_ranges)
WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT strftime(from_date, '%Y-%m-%d') FROM port_ranges)""")
add("ranges_to_do", """
SELECT strftime(from_date, '%Y-%m-%d') AS from_date, strftime(to_date, '%Y-%m-%d') AS to_date
FROM (SELECT * FROM transit_ranges EXCEPT SELECT * FROM port_ranges)""")
add("first_pending_range", """
SELECT strftime(from_date, '%Y-%m-%d') AS from_date, strftime(to_date, '%Y-%m-%d') AS to_date
FROM (SELECT * FROM transit_ranges EXCEPT SELECT * FROM port_ranges) ORDER BY 1, 2 LIMIT 1""")
ORACLES["emissions_increment"] = ORACLES["emissions_from_csv"] = ORACLES["local_emissions"]
ORACLES["stream_anchorage_sessions"] = query("""
SELECT imo, mmsi, min(t_s) AS anch_start, max(t_s) AS anch_end, count(*) AS n_positions
FROM (SELECT *, sum(fresh) OVER (PARTITION BY imo, mmsi ORDER BY t_s, event_id) AS gid FROM drifting) GROUP BY imo, mmsi, gid""", HARBOUR)
add("stream_port_sessions", "SELECT * FROM both_ev", HARBOUR)
add("stream_repaired_sessions", "SELECT * FROM both_ev", HARBOUR)
ORACLES["port_call_runs"] = ORACLES["port_calls"]
for _at, (_low, _high, _only) in {"a": ("2024-01-01", "2024-01-15", "true"), "b": ("2024-01-16", "2024-01-30", "imo IS NULL")}.items():
    ORACLES[f"_{_at}"] = f"SELECT *, '{_low}' AS from_date, '{_high}' AS to_date FROM ({ORACLES['port_calls']}) WHERE {_only}"
ORACLES["write_results"] = f"SELECT * FROM ({ORACLES.pop('_a')}) UNION ALL SELECT * FROM ({ORACLES.pop('_b')})"
add("new_days_only", """
SELECT event_id, t_s AS dt_pos_utc FROM positions WHERE t_s // 86400 IN (SELECT t_s // 86400 FROM positions WHERE sog < 0.02)""")

# ---- Geometry and clustering ------------------------------------------------

POLYGONS = """
shape AS (
  SELECT c_custkey AS key, 79000 + (c_custkey * 37) % 1500 AS x0, 8900 + (c_custkey * 53) % 900 AS y0,
    21 + (c_custkey * 7) % 60 AS w, 23 + (c_custkey * 11) % 50 AS h FROM customer),
poly AS (
  SELECT 'zone ' || CAST(key AS VARCHAR) AS Name, CASE WHEN key % 3 = 0 THEN 'Panama' ELSE 'Other' END AS territory,
    key % 2 = 0 AS is_rect, -(x0 * 100 + 5) / 100000::DOUBLE AS xa, -((x0 + w) * 100 + 5) / 100000::DOUBLE AS xb,
    -((x0 + 10) * 100 + 5) / 100000::DOUBLE AS xm, (y0 * 100 + 5) / 100000::DOUBLE AS ya,
    ((y0 + h) * 100 + 5) / 100000::DOUBLE AS yb, ((y0 + 11) * 100 + 5) / 100000::DOUBLE AS ym FROM shape)"""
INSIDE = """(is_rect AND x > xb AND x < xa AND y > ya AND y < yb
  OR NOT is_rect AND ((x > xb AND x < xa AND y > ya AND y < ym) OR (x > xm AND x < xa AND y >= ym AND y < yb)))"""
add("parse_wkt", """
SELECT Name, CASE WHEN is_rect THEN 4 ELSE 6 END AS n_edges, round(xb, 6) AS x0, round(xa, 6) AS x1, round(ya, 6) AS y0, round(yb, 6) AS y1,
  round(-2 * CASE WHEN is_rect THEN (xa - xb) * (yb - ya) ELSE (xa - xb) * (ym - ya) + (xa - xm) * (yb - ym) END, 6) AS twice_area
FROM poly""", POLYGONS)
_COLS = round(360 / GRID)
add("polyfill", f"""
SELECT Name, CAST(r * {_COLS} + c AS BIGINT) AS cell
FROM (SELECT *, (r + 0.5::DOUBLE) * {GRID}::DOUBLE - 90 AS y, (c + 0.5::DOUBLE) * {GRID}::DOUBLE - 180 AS x
      FROM (SELECT *, unnest(range(CAST(floor((xb + 180) / {GRID}::DOUBLE) AS BIGINT), CAST(floor((xa + 180) / {GRID}::DOUBLE) AS BIGINT) + 1)) AS c
            FROM (SELECT *, unnest(range(CAST(floor((ya + 90) / {GRID}::DOUBLE) AS BIGINT), CAST(floor((yb + 90) / {GRID}::DOUBLE) AS BIGINT) + 1)) AS r
                  FROM poly WHERE territory = 'Panama')))
WHERE {INSIDE}""", POLYGONS)
add("points_in_zone", f"""
SELECT event_id, Name FROM (SELECT event_id, longitude AS x, latitude AS y FROM positions), poly
WHERE territory = 'Panama' AND {INSIDE}""", POLYGONS)
add("zone_tag_from_polygons", f"""
SELECT p.event_id, min(Name) AS Name FROM (SELECT event_id, longitude AS x, latitude AS y FROM positions) p LEFT JOIN poly ON {INSIDE}
GROUP BY p.event_id""", POLYGONS)
_BITS = " + ".join(f"(((r >> {k}) & 1) << {2 * k + 1}) + (((c >> {k}) & 1) << {2 * k})" for k in range(17))
add("quad_cells", f"""
SELECT event_id, cell, cell >> 10 AS parent, 17 AS level, r, c, 8 AS n_around FROM (SELECT *, {1 << 34} + {_BITS} AS cell FROM (
  SELECT event_id, CAST(floor((latitude + 180) / (360 / {2 ** 17}::DOUBLE)) AS BIGINT) AS r,
    CAST(floor((longitude + 180) / (360 / {2 ** 17}::DOUBLE)) AS BIGINT) AS c FROM positions))""")
add("cell_of", f"""
SELECT event_id, CAST(floor((latitude + 90) / {GRID}::DOUBLE) * {_COLS} + floor((longitude + 180) / {GRID}::DOUBLE) AS BIGINT) AS cell FROM positions""")
_DIGITS = " + ".join(f"((event_id // {7 ** i}) % 7) * {8 ** (9 - i)}" for i in range(10))
add("cell_parent", f"""
SELECT event_id, cell, (cell & ~(15::BIGINT << 52)) | (8::BIGINT << 52) | {(1 << 21) - 1} AS parent_8,
  (cell & ~(15::BIGINT << 52)) | (4::BIGINT << 52) | {(1 << 33) - 1} AS parent_4, lower(to_hex(cell)) AS cell_text, 1 AS round_trip
FROM (SELECT event_id, {(1 << 59) | (10 << 52) | ((1 << 15) - 1)} + H3_int_index_6 * {1 << 45} + ({_DIGITS}) * 32768 AS cell FROM positions)""")
add("dbscan_stops", """
SELECT ship, event_id, CAST(coalesce(dense_rank() OVER (PARTITION BY ship, label IS NULL ORDER BY label) - 1
  + CASE WHEN label IS NULL THEN NULL ELSE 0 END, -1) AS INTEGER) AS cluster
FROM labelled""", SHIP_ROWS + """,
pts AS (SELECT ship, event_id, t_s, longitude AS x, latitude AS y, CASE WHEN ship % 2 = 0 THEN 0.0028::DOUBLE ELSE 0.0014::DOUBLE END AS eps FROM ship_rows),
close_pairs AS (
  SELECT a.ship, a.t_s AS a, b.t_s AS b FROM pts a JOIN pts b ON a.ship = b.ship
  AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= a.eps * a.eps),
core AS (SELECT ship, a FROM close_pairs GROUP BY ship, a HAVING count(*) >= 3),
core_pairs AS (
  SELECT p.ship, p.a, p.b FROM close_pairs p JOIN core c ON c.ship = p.ship AND c.a = p.a JOIN core d ON d.ship = p.ship AND d.a = p.b),
reach(ship, a, b) AS (
  SELECT ship, a, b FROM core_pairs
  UNION
  SELECT r.ship, r.a, p.b FROM reach r JOIN core_pairs p ON p.ship = r.ship AND p.a = r.b),
core_label AS (SELECT ship, a, min(b) AS label FROM reach GROUP BY ship, a),
labelled AS (
  SELECT pts.ship, event_id, coalesce(any_value(own.label), min(l.label)) AS label
  FROM pts LEFT JOIN core_label own ON own.ship = pts.ship AND own.a = pts.t_s
  LEFT JOIN close_pairs p ON p.ship = pts.ship AND p.a = pts.t_s
  LEFT JOIN core_label l ON l.ship = p.ship AND l.a = p.b
  GROUP BY pts.ship, pts.event_id)""")
