"""Ship data derived from the given tables, for the registered queries and tests.

``events`` becomes positions (one row per event), its users become ships, and
the registry, ledgers and polygons are derived from the given tables too. Factor
values are synthetic. ``checks/oracle_views.py`` states the same in DuckDB SQL.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.emissions import FactorTables
from tidemark.operators.zones import zone_lookup
from tidemark.plans.jobs import Registry

EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
VOYAGE = 360000
ROWS_PER_VOYAGE = 12
TIE = ("event_id",)

WEST_BREAKWATER = "Panama Canal - Atlantic - West Breakwater Inner Anchorage"
PORT_ZONES = ["MIT", "CCT", "Pacific - PSA"]
WAIT_ZONES = ["Atlantic Anchorage", "Pacific Anchorage", "Gatun Anchorage", WEST_BREAKWATER]
LOCK_ZONES = [
    "Miraflores Locks Original", "Cocoli Locks", "Pedro Miguel Locks Original",
    "Gatun Locks Original", "Gatun Locks Expanded",
]
ZONES = sorted(PORT_ZONES + WAIT_ZONES + LOCK_ZONES + ["Pacific Access", "Atlantic Access", "Gamboa Mooring station"])
ZONE_NUMBER = {name: i + 1 for i, name in enumerate(ZONES)}
SPECIAL_CELL = (1000 * ZONE_NUMBER["MIT"], "Telfer")  # a cell inside two zones

TYPES = ["Container", "Cruise", "Oil tanker", "Chemical tanker", "Bulk carrier"]
FUELS = ["HFO", "MDO", "LNG"]
ENGINES = ["SSD", "MSD", "HSD", "LNG"]


def speed_modulus(zone: str | None) -> int:
    if zone in WAIT_ZONES:
        return 350
    if zone in PORT_ZONES:
        return 130
    return 600 if zone in LOCK_ZONES else 1800


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_rank(events: DataFrame) -> DataFrame:
    """0-based rank of each event of a user, counted per (user, minute) and added up over the minutes.

    No task sees more than a minute of one user, or one row per minute of a user.
    """
    events = events.withColumn("_m", F.expr("unix_timestamp(ts) div 60"))
    inside = Window.partitionBy("user_id", "_m").orderBy("ts", "event_id")
    earlier = Window.partitionBy("user_id").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    minutes = events.groupBy("user_id", "_m").agg(F.count(F.lit(1)).alias("_n"))
    minutes = minutes.select("user_id", "_m", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ranked = events.join(minutes, ["user_id", "_m"])
    return ranked.withColumn("rn0", F.row_number().over(inside) - 1 + F.col("_before"))


def _sql(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value + "'" if isinstance(value, str) else repr(value)


def _array(values) -> str:
    return "array(" + ", ".join(_sql(v) for v in values) + ")"


ZONE_SCRIPT = f"""
CASE WHEN user_id % 7 = 3 THEN
  element_at({_array(
      ["Atlantic Anchorage"] * 2 + ["MIT"] * 3 + ["CCT", None, None, "", "Pacific - PSA", "Pacific - PSA", "Pacific - PSA"]
  )}, slot0 + 1)
WHEN user_id % 13 = 6 AND slot IN (2, 10) THEN 'Gamboa Mooring station'
WHEN user_id % 11 = 5 AND slot IN (8, 9) THEN 'Gatun Anchorage'
WHEN slot = 6 AND user_id % 5 = 1 THEN 'MIT'
WHEN slot = 11 AND user_id % 4 = 1 THEN '{WEST_BREAKWATER}'
WHEN user_id % 2 = 0 THEN element_at({_array([
    "Pacific Anchorage", "Pacific Anchorage", "Pacific Access", "Miraflores Locks Original",
    "Miraflores Locks Original", "Pedro Miguel Locks Original", "Gamboa Mooring station", "Gatun Anchorage",
    "Gatun Locks Original", "Gatun Locks Original", "Atlantic Access", "Atlantic Anchorage",
])}, slot + 1)
ELSE element_at({_array([
    "Pacific Anchorage", "Pacific Anchorage", "Pacific Access", "Cocoli Locks", "Cocoli Locks", "Cocoli Locks",
    "Gamboa Mooring station", "Gatun Anchorage", "Gatun Locks Expanded", "Gatun Locks Expanded",
    "Atlantic Access", "Atlantic Anchorage",
])}, slot + 1) END"""

ZONE_MAP = "map(" + ", ".join(f"'{n}', {z}" for n, z in ZONE_NUMBER.items()) + ")"
TOP = _array([speed_modulus(n) for n in [None, *ZONES]])


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    voyages = _event_rank(events).selectExpr(
        "event_id", "user_id", f"unix_timestamp(ts) - {EPOCH} AS off_s",
        "cast(round(value * 100) AS bigint) AS v100",
        f"rn0 div {ROWS_PER_VOYAGE} AS cyc", f"cast(rn0 % {ROWS_PER_VOYAGE} AS int) AS slot0",
    )
    slots = voyages.selectExpr(
        "*", f"CASE WHEN cyc % 2 = 0 THEN slot0 ELSE {ROWS_PER_VOYAGE - 1} - slot0 END AS slot",
        f"{EPOCH} + cyc * {VOYAGE} + CASE user_id % 3 WHEN 0 THEN off_s div 8 WHEN 1 THEN off_s ELSE off_s * 2 END AS t_s",
    )
    placed = slots.selectExpr("event_id", "user_id", "v100", "t_s", "cyc", f"{ZONE_SCRIPT} AS zone")
    placed = placed.selectExpr(
        "event_id", "user_id", "v100", "t_s",
        "CASE WHEN zone <> '' THEN zone WHEN zone = '' AND cyc % 2 = 0 THEN 'Atlantic Anchorage' "
        "WHEN zone = '' THEN 'Pacific Anchorage' END AS zone",
    )
    numbered = placed.selectExpr("*", f"cast(coalesce({ZONE_MAP}[zone], 0) AS bigint) AS z")
    return numbered.selectExpr(
        "event_id", "user_id", "timestamp_seconds(t_s) AS dt_pos_utc", "200000000 + user_id AS mmsi",
        "CASE WHEN user_id % 5 <> 0 THEN 9000000 + user_id END AS imo",
        f"(v100 % element_at({TOP}, cast(z + 1 AS int))) / 100D AS sog",
        "CASE WHEN user_id % 19 = 4 THEN 'CERRO AZUL' WHEN user_id % 19 <> 5 THEN concat('SHIP ', user_id) END AS vessel_name",
        "CASE WHEN event_id % 23 <> 0 THEN cast(5 + (event_id + user_id) % 3 AS double) END AS draught",
        "8.90D + 0.05D * z + ((event_id * 7919) % 21 - 10) * 0.0003D AS latitude",
        "-79.60D - 0.03D * z + ((event_id * 104729) % 21 - 10) * 0.0003D AS longitude",
        "1000 * z + event_id % 7 AS H3_int_index_10", "100 * z + event_id % 3 AS H3_int_8",
        "z AS H3_int_4", "z AS H3_int_index_6", "z AS H3_int_index_5",
        f"element_at({_array(TYPES)}, cast(user_id % 5 + 1 AS int)) AS vessel_type_main",
        "cast(100 + user_id % 200 AS double) AS length", "cast(20 + user_id % 30 AS double) AS width",
    )


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small lookup table whose size the optimizer knows."""
    struct = T._parse_datatype_string(schema)
    columns = zip(*rows)
    return spark.createDataFrame(pa.table({f.name: pa.array(c) for f, c in zip(struct.fields, columns)}), struct)


# ---- Lookup tables (shared with the oracle as plain rows) -------------------

ZONE_CELL_ROWS = [(name, 1000 * z + k) for name, z in ZONE_NUMBER.items() for k in range(7)] + [
    (SPECIAL_CELL[1], SPECIAL_CELL[0])
]
VERSION_ROWS = [("2024A", EPOCH, EPOCH + 31 * 86400 - 1), ("2024B", EPOCH + 31 * 86400, EPOCH + 366 * 86400 - 1)]
COAST_5_ROWS = [(z, 500 + z) for z in range(1, len(ZONES) + 1, 2)]
PORT_1_ROWS = [(100 * ZONE_NUMBER[n], 10 + ZONE_NUMBER[n]) for n in PORT_ZONES]
PORT_5_ROWS = [(100 * ZONE_NUMBER[n] + k, 50 + k) for n in PORT_ZONES for k in range(3)] + [
    (100 * ZONE_NUMBER[n] + 1, 90) for n in ("Atlantic Anchorage", "Pacific Anchorage")
] + [(100 * ZONE_NUMBER["MIT"], 99)]  # a cell with two ids
TABLE_17_ROWS = [
    (t, b, *[float(100 * (i + 1) + 10 * b + 7 * k) for k in range(8)])
    for i, t in enumerate(TYPES) for b in range(10) if b != 7
]
TABLE_44_ROWS = [(t, b, 0.9 + 0.01 * i, 0.95 - 0.005 * b) for i, t in enumerate(TYPES) for b in range(10) if b != 7]
TABLE_19_1_ROWS = [
    (e, f, 200.0 + 5 * i + j, 190.0 + 5 * i + j, 180.0 + 5 * i + j, 6.5 if e == "LNG" else None)
    for i, e in enumerate(ENGINES) for j, f in enumerate(FUELS)
]
TABLE_19_2_ROWS = [
    (f, e, 230.0 + 20 * k + j, 220.0 + 20 * k + j, 210.0 + 20 * k + j)
    for k, e in enumerate(("AE", "AB")) for j, f in enumerate(FUELS)
]
TABLE_21_ROWS = [("HFO", 3.1), ("MDO", 3.2), ("LNG", 2.7)]
TABLE_55_56_ROWS = [
    (e, f, 0.0100371 + 0.0020113 * i + 0.1009729 * j) for i, e in enumerate([*ENGINES, "AE", "AB"]) for j, f in enumerate(FUELS)
]
TABLE_59_60_ROWS = [
    (e, f, 0.0300517 + 0.0010259 * i + 0.0200873 * j) for i, e in enumerate([*ENGINES, "AE", "AB"]) for j, f in enumerate(FUELS)
]
TYPE_BIN_ROWS = [
    (t, t if t != "Oil tanker" else "Liquified gas tanker", 5000.0 * b, 5000.0 * (b + 1) if b < 9 else 1e9, b)
    for t in TYPES for b in range(10)
]


def zone_cells(spark: SparkSession) -> DataFrame:
    return zone_lookup(spark, ZONE_CELL_ROWS)


def port_cells(spark: SparkSession) -> DataFrame:
    rows = [r for r in ZONE_CELL_ROWS if r[0] in PORT_ZONES or r[0] == SPECIAL_CELL[1]]
    return zone_lookup(spark, rows)


def versions(spark: SparkSession) -> DataFrame:
    rows = inline(spark, VERSION_ROWS, "version string, a long, b long")
    return rows.select(F.timestamp_seconds("a").alias("from_date"), F.timestamp_seconds("b").alias("to_date"), "version")


def layers(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        inline(spark, COAST_5_ROWS, "H3_int_4 long, id_coast_5 long"),
        inline(spark, PORT_1_ROWS, "H3_int_8 long, id_port_1 long"),
        inline(spark, PORT_5_ROWS, "H3_int_8 long, id_port_5 long"),
    )


T17_NAMES = [f"{p}_{s}" for p in ("ae", "ab") for s in ("sea", "berth", "man", "anch")]


def factors(spark: SparkSession) -> FactorTables:
    kind = "StandardVesselType string, imobin int"
    return FactorTables(
        table_17=inline(spark, TABLE_17_ROWS, kind + "".join(f", {n} double" for n in T17_NAMES)),
        table_44=inline(spark, TABLE_44_ROWS, kind + ", weather double, fouling double"),
        table_19_1=inline(
            spark, TABLE_19_1_ROWS,
            "meType string, fuel string, _83 double, `84_2000` double, `2001_` double, pilot_mdo double",
        ),
        table_19_2=inline(
            spark, TABLE_19_2_ROWS,
            "fuel string, meType string, ae_ab_83 double, ae_ab_84_2000 double, ae_ab_2001_ double",
        ),
        table_21=inline(spark, TABLE_21_ROWS, "fuel string, ef_co2 double"),
        table_55_56=inline(spark, TABLE_55_56_ROWS, "meType string, fuel string, ef_ch4 double"),
        table_59_60=inline(spark, TABLE_59_60_ROWS, "meType string, fuel string, ef_n2o double"),
    )


def type_bins(spark: SparkSession) -> DataFrame:
    return inline(
        spark, TYPE_BIN_ROWS, "vessel_type string, StandardVesselType string, lo double, hi double, imobin int"
    )


def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapted specifications: two versions of every user seen in ``events``."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    both = users.selectExpr("user_id", "explode(array('2024A', '2024B')) AS version")

    def pick(values) -> str:
        return f"element_at({_array(values)}, cast(user_id % {len(values)} + 1 AS int))"

    return both.selectExpr(
        "200000000 + user_id AS mmsi", "version",
        "CASE WHEN user_id % 17 = 0 THEN 0D "
        "ELSE cast(10 + user_id % 13 + CASE WHEN version = '2024B' THEN 1 ELSE 0 END AS double) END AS Speed",
        f"cast({pick([100.0, 150.5, 300.0, 20000.0])} AS double) AS Powerkwmax",
        f"{pick(TYPES)} AS StandardVesselType", "cast(user_id % 10 AS int) AS imobin",
        f"{pick(ENGINES)} AS meType", f"{pick(FUELS)} AS fuel",
        "CASE WHEN user_id % 29 <> 0 THEN concat(1975 + user_id % 50, '-06-01') END AS DateOfBuild",
        "cast(8 + user_id % 6 AS double) AS SummerDraught",
        "cast(100 + user_id % 200 AS double) AS ais_loa", "cast(20 + user_id % 30 AS double) AS ais_beam",
        "cast(1000 * (1 + user_id % 60) AS double) AS GrossTonnage",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw registry rows; every ninth ship has a second, larger candidate."""
    base = specs(spark, sf_dir).select(
        "mmsi", "version", (F.col("mmsi") - 200000000 + 9000000).alias("imo"), "Speed", "GrossTonnage"
    )
    extra = base.filter(F.col("imo") % 9 == 0).withColumn("GrossTonnage", F.col("GrossTonnage") + 500.0)
    return base.unionByName(extra)


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as it is delivered: its own column names, dimensions, no adapted types."""
    return specs(spark, sf_dir).select(
        F.col("mmsi").alias("MaritimeMobileServiceIdentityMMSINumber"), (F.col("mmsi") - 200000000 + 9000000).alias("LRIMOShipNo"),
        "version", "ais_loa", "ais_beam", "Speed", "GrossTonnage",
    )


def registry_of(spark: SparkSession, sf_dir: str) -> Registry:
    return Registry(versions=versions(spark), specs=specs(spark, sf_dir))


# ---- Ledgers and polygons from the given tables -----------------------------


def object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored-object name per order, some of them not result names."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    start = F.date_format("d", "yyyy-MM-dd")
    span = F.concat(start, F.lit("&"), F.date_format(F.date_add("d", 14), "yyyy-MM-dd"), F.lit(".parquet"))
    kind = F.col("o_orderkey") % 5
    return orders.select(
        F.when(kind == 0, F.concat(F.lit("dash/transits_pc/transits_pc_in_"), span))
        .when(kind == 1, F.concat(F.lit("dash/stops_in_transits_pc/stops_in_transits_pc_in_"), span))
        .when(kind == 2, F.concat(F.lit("dash/port_stops/port_stops_in_"), span))
        .when(kind == 3, F.concat(F.lit("dash/transits_pc/transits_pc_in_"), start, F.lit(".parquet")))
        .otherwise(F.concat(F.lit("dash/emissions/log_"), F.col("o_orderkey").cast("string"), F.lit(".parquet")))
        .alias("path")
    )


def _decimal(value: Column) -> Column:
    """Text of value/1000 + 0.00005 for a non-negative long: no ship position or cell centre lies on it."""
    whole, part = F.floor(value / 1000).cast("string"), F.lpad((value % 1000).cast("string"), 3, "0")
    return F.concat(whole, F.lit("."), part, F.lit("05"))


def polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rectangle or an L-shape per customer, as WKT text around the ship area."""
    key = F.col("c_custkey")
    x0, y0 = 79000 + (key * 37) % 1500, 8900 + (key * 53) % 900
    w, h = 21 + (key * 7) % 60, 23 + (key * 11) % 50

    def point(x: Column, y: Column) -> Column:
        return F.concat(F.lit("-"), _decimal(x), F.lit(" "), _decimal(y))

    def text(*points: tuple[Column, Column]) -> Column:
        return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[point(x, y) for x, y in points]), F.lit("))"))

    rectangle = text((x0, y0), (x0 + w, y0), (x0 + w, y0 + h), (x0, y0 + h), (x0, y0))
    mid_x, mid_y = x0 + 10, y0 + 11
    concave = text(
        (x0, y0), (x0 + w, y0), (x0 + w, mid_y), (mid_x, mid_y), (mid_x, y0 + h), (x0, y0 + h), (x0, y0)
    )
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("zone "), key.cast("string")).alias("Name"),
        F.when(key % 3 == 0, "Panama").otherwise("Other").alias("TERRITORY1"),
        F.when(key % 2 == 0, rectangle).otherwise(concave).alias("WKT_geom"),
    )
