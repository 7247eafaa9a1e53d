"""CO2, CH4 and N2O per position, following the IMO GHG4 bottom-up method.

All factor tables are inputs. They are a few hundred rows, fixed by the method
and independent of the positions; :func:`lookup_join` still checks their size.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import constants as K
from tidemark.operators.lookup import lookup_join
from tidemark.operators.phase import op_phase, with_load
from tidemark.operators.zones import near_coast_port

GASES = ("co2_t", "ch4_t", "n2o_t")

# ---- Fixed values of the method. ----
PILOT_CO2 = 3.206
LOW_LOAD_CH4 = (21.18, 2.18, 1.0)
LOW_LOAD_N2O = (4.63, 1.22, 1.0)
LOAD_CURVE = (0.455, -0.710, 1.280)
LOAD_CURVE_ENGINES = ["SSD", "MSD", "HSD"]
DRAUGHT_POWER = 0.66
CRUISE_SHARE = 0.70
LARGE_CONTAINER_SHARE = 0.75
LARGE_CONTAINER_BINS = [8, 9]


@dataclass(frozen=True)
class FactorTables:
    table_17: DataFrame
    table_44: DataFrame
    table_19_1: DataFrame
    table_19_2: DataFrame
    table_21: DataFrame
    table_55_56: DataFrame
    table_59_60: DataFrame


def _left(df: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    return lookup_join(df, table, on, "left")


def _by_engine(table: DataFrame, kind: str, cols: dict[str, str]) -> DataFrame:
    return table.filter(F.col("meType") == kind).select("fuel", *[F.col(c).alias(n) for c, n in cols.items()])


def build_year(col: str = "DateOfBuild") -> Column:
    return F.substring(F.col(col).cast("string"), 1, 4).try_cast("int")


def _by_year(old: str, mid: str, new: str) -> Column:
    """Value of the build-year band; null without a year."""
    year = F.col("YearOfBuild")
    return F.when(year <= 1983, F.col(old)).when(year <= 2000, F.col(mid)).when(year >= 2001, F.col(new))


def with_factors(specs: DataFrame, tables: FactorTables) -> DataFrame:
    """Add every factor a ship's type, size bin, engine, fuel and build year select.

    None of them depends on a position, so the factors are looked up once per
    ship version here and reach the positions with the one specification join.
    """
    out = specs.withColumn("YearOfBuild", build_year())
    out = _left(out, tables.table_17, ["StandardVesselType", "imobin"])
    out = _left(out, tables.table_44, ["StandardVesselType", "imobin"])
    out = _left(out, tables.table_19_1, ["meType", "fuel"])
    out = out.withColumn("sfc_base", _by_year("_83", "84_2000", "2001_")).drop("_83", "84_2000", "2001_")
    bands = ("ae_ab_83", "ae_ab_84_2000", "ae_ab_2001_")
    for kind in ("AE", "AB"):
        out = _left(out, _by_engine(tables.table_19_2, kind, {b: b for b in bands}), ["fuel"])
        value = F.when(F.col("YearOfBuild").isNull(), F.lit(0.0)).otherwise(_by_year(*bands))
        out = out.withColumn(f"sfc_{kind.lower()}", value).drop(*bands)
    out = _left(out, tables.table_21, ["fuel"])
    for ef, table in (("ef_ch4", tables.table_55_56), ("ef_n2o", tables.table_59_60)):
        out = _left(out, table.select("meType", "fuel", ef), ["meType", "fuel"])
        for kind in ("AE", "AB"):
            out = _left(out, _by_engine(table, kind, {ef: f"{ef}_{kind.lower()}"}), ["fuel"])
    return out


def _phase_value(prefix: str) -> Column:
    phase = F.col("op_phase")
    return (
        F.when(phase == K.BERTH, F.col(f"{prefix}_berth"))
        .when(phase == K.MANOEUVRING, F.col(f"{prefix}_man"))
        .when(phase == K.ANCHORAGE, F.col(f"{prefix}_anch"))
        .otherwise(F.col(f"{prefix}_sea"))
    )


def aux_energy(df: DataFrame) -> DataFrame:
    """Auxiliary engine and boiler energy, ``ae_ene`` and ``ab_ene``."""
    power, hours = F.col("Powerkwmax"), F.col("freq")
    return df.withColumn(
        "ae_ene",
        F.when(power <= 150, F.lit(0.0))
        .when(power.between(151, 500), F.lit(0.05) * power * hours)
        .otherwise(_phase_value("ae") * hours),
    ).withColumn("ab_ene", F.when(power <= 150, F.lit(0.0)).otherwise(_phase_value("ab") * hours))


def main_energy(df: DataFrame) -> DataFrame:
    """Main engine power and energy, ``me_pow`` and ``me_ene``."""
    kind = F.col("StandardVesselType")
    share = (
        F.when(kind == "Cruise", F.lit(CRUISE_SHARE))
        .when((kind == "Container") & F.col("imobin").isin(LARGE_CONTAINER_BINS), F.lit(LARGE_CONTAINER_SHARE))
        .otherwise(F.lit(1.0))
    )
    draught = F.pow(F.try_divide(F.col("draught"), F.col("SummerDraught")), F.lit(DRAUGHT_POWER))
    power = F.try_divide(
        share * F.col("Powerkwmax") * draught * F.pow(F.col("load"), F.lit(3.0)), F.col("weather") * F.col("fouling")
    )
    still = F.col("op_phase").isin([K.BERTH, K.ANCHORAGE])
    out = df.withColumn("me_pow", F.when(still, F.lit(0.0)).otherwise(power))
    return out.withColumn("me_ene", F.col("me_pow") * F.col("freq"))


def fuel_use(df: DataFrame) -> DataFrame:
    """Specific fuel use of the main engine and the consumption of all consumers and the pilot fuel."""
    load = F.col("load")
    a, b, c = LOAD_CURVE
    curve = F.when(
        F.col("meType").isin(LOAD_CURVE_ENGINES), F.lit(a) * load * load + F.lit(b) * load + F.lit(c)
    ).otherwise(F.lit(1.0))
    out = df.withColumn("sfc_me", F.col("sfc_base") * curve)
    for part in ("me", "ae", "ab"):
        out = out.withColumn(f"{part}_con", F.col(f"{part}_ene") * F.col(f"sfc_{part}"))
    return out.withColumn("pilot_con", F.coalesce(F.col("me_ene") * F.col("pilot_mdo"), F.lit(0.0)))


def co2(df: DataFrame) -> DataFrame:
    burnt = F.col("me_con") + F.col("ae_con") + F.col("ab_con")
    return df.withColumn("co2_g", burnt * F.col("ef_co2") + F.col("pilot_con") * F.lit(PILOT_CO2))


def _low_load(factor: Column, values: tuple[float, float, float], multiply: bool) -> Column:
    load = F.col("load")
    very_low, low, reduced = [F.lit(v) * factor if multiply else F.lit(v) for v in values]
    return (
        F.when(load < 0.02, very_low)
        .when(load.between(0.02, 0.1), low)
        .when(load.between(0.1001, 0.2), reduced)
        .otherwise(factor)
    )


def ch4_n2o(df: DataFrame, multiply: bool = False) -> DataFrame:
    """CH4 and N2O in grams. At low load fixed numbers replace the main engine factor (``multiply`` scales it)."""
    out = df
    for gas, values in (("ch4", LOW_LOAD_CH4), ("n2o", LOW_LOAD_N2O)):
        ef = f"ef_{gas}"
        total = (
            F.col("me_ene") * _low_load(F.col(ef), values, multiply)
            + F.col("ae_ene") * F.col(f"{ef}_ae")
            + F.col("ab_ene") * F.col(f"{ef}_ab")
        )
        out = out.withColumn(f"{gas}_g", total)
    return out


def active_positions(timed: DataFrame, layers: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """Add load and phase to positions that carry ``freq``, specs and factors."""
    return op_phase(near_coast_port(with_load(timed), *layers))


def emissions(
    timed: DataFrame, layers: tuple[DataFrame, DataFrame, DataFrame], multiply: bool = False
) -> DataFrame:
    """Tonnes of CO2, CH4 and N2O per position.

    The input has the elapsed hours (:func:`tidemark.operators.tracks.track_freq`)
    and the columns of :func:`with_factors`.
    """
    out = fuel_use(main_energy(aux_energy(active_positions(timed, layers))))
    out = ch4_n2o(co2(out), multiply)
    return out.select("*", *[(F.col(f"{g[:3]}_g") * F.lit(1e-6)).alias(g) for g in GASES])


def unpivot_emissions(df: DataFrame, ids: list[str]) -> DataFrame:
    return df.unpivot(ids, list(GASES), "emission_type", "emission_value")


def local_emissions(
    emitted: DataFrame, cell: str = "H3_int_index_6", resolution: int = 6, by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Monthly sums per gas, ship type and cell, and per expression in ``by``; an unknown amount counts as 0.

    Summed before the unpivot, so the shuffle carries one partial row per
    (month, type, cell) instead of three rows per position.
    """
    by = dict(by or {})
    ids = [*by, "year", "month", "StandardVesselType", "h3resolution", "resolution_id"]
    sums = (
        emitted.groupBy(
            *[e.alias(n) for n, e in by.items()],
            F.year("dt_pos_utc").alias("year"),
            F.month("dt_pos_utc").alias("month"),
            "StandardVesselType",
            F.lit(resolution).alias("h3resolution"),
            F.col(cell).alias("resolution_id"),
        )
        .agg(*[F.sum(F.coalesce(F.col(g), F.lit(0.0))).alias(g) for g in GASES])
    )
    return unpivot_emissions(sums, ids)


def null_emissions(emitted: DataFrame) -> DataFrame:
    """How many positions have no value, per gas: what :func:`local_emissions` counts as 0."""
    return emitted.agg(*[F.count_if(F.col(g).isNull()).alias(f"{g}_null") for g in GASES])
