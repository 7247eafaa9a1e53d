"""Ship registry: versions by date, matching, and adapted specifications."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join

SHIP_COLUMNS = ("imo", "mmsi", "vessel_type_main", "length", "width", "version")


class MissingColumns(ValueError):
    """The input lacks required columns."""


def require_columns(df: DataFrame, needed: Iterable[str]) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise MissingColumns("missing required columns: " + ", ".join(missing))


def version_rows(versions: DataFrame) -> DataFrame:
    """One row per version and year it touches."""
    years = F.sequence(F.year("from_date"), F.year("to_date"))
    return versions.select("from_date", "to_date", "version", F.explode(years).alias("_year"))


def version_join(positions: DataFrame, versions: DataFrame, ts: str = "dt_pos_utc") -> DataFrame:
    """Left join each position with the registry version valid at its time.

    The validity interval is laid out as one row per version and year, so the
    range condition becomes an equi-join on the year plus an exact check. A version
    that is open to the year 9999 makes some 8,000 rows.
    """
    dated = positions.withColumn("_year", F.year(ts))
    valid = (F.col(ts) >= F.col("from_date")) & (F.col(ts) <= F.col("to_date"))
    joined = lookup_join(dated, version_rows(versions), ["_year"], "left", condition=valid)
    return joined.drop("_year", "from_date", "to_date")


def distinct_ships(positions: DataFrame) -> DataFrame:
    require_columns(positions, SHIP_COLUMNS)
    return positions.select(*SHIP_COLUMNS).distinct()


def read_registry(registry: DataFrame) -> DataFrame:
    """Bring raw registry columns to the library's names, version as text."""
    out = registry.drop("from_date", "to_date")
    for old, new in (("MaritimeMobileServiceIdentityMMSINumber", "mmsi"), ("LRIMOShipNo", "imo")):
        if old in out.columns:
            out = out.withColumnRenamed(old, new)
    return out.withColumn("version", F.col("version").cast("string"))


def match_specs(ships: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows of the listed ships, one per (mmsi, version).

    Among several candidates the least row wins (all columns compared in
    order), so the survivor does not depend on row order.
    """
    require_columns(ships, SHIP_COLUMNS)
    require_columns(registry, ("mmsi", "imo", "version"))
    seen = ships.select("mmsi", "version", "vessel_type_main", "length", "width").groupBy("mmsi", "version").agg(
        F.min(F.struct("vessel_type_main", "length", "width")).alias("_seen")
    )
    rest = [c for c in registry.columns if c not in ("mmsi", "version")]
    one = registry.groupBy("mmsi", "version").agg(F.min(F.struct(*rest)).alias("_spec"))
    return one.join(seen, ["mmsi", "version"]).select("mmsi", "version", "_spec.*", "_seen.*")


def adapt_specs(matched: DataFrame, type_bins: DataFrame, size: str = "GrossTonnage") -> DataFrame:
    """Map the AIS vessel type and size to the emission model's type and size bin.

    ``type_bins`` holds (vessel_type, StandardVesselType, lo, hi, imobin) with
    lo <= size < hi.
    """
    bins = type_bins.withColumnRenamed("vessel_type", "vessel_type_main")
    fits = (F.col(size) >= F.col("lo")) & (F.col(size) < F.col("hi"))
    return lookup_join(matched, bins, ["vessel_type_main"], "left", condition=fits).drop("lo", "hi")


def enrich_specs(positions: DataFrame, specs: DataFrame, how: str = "inner", ts: str = "dt_pos_utc") -> DataFrame:
    """Join positions with the specifications of their own registry version."""
    clash = [c for c in specs.columns if c in positions.columns and c not in ("mmsi", "version")]
    return lookup_join(positions, specs.drop(*clash), ["mmsi", "version"], how)


def latest_specs(specs: DataFrame, cols: Sequence[str], versions: DataFrame) -> DataFrame:
    """One row per mmsi, from the ship's version that begins last; versions without dates come before all others."""
    begins = versions.groupBy("version").agg(F.max("from_date").alias("_begins"))
    dated = lookup_join(specs, begins, ["version"], "left")
    newest = F.max_by(F.struct(*cols), F.struct("_begins", "version")).alias("_spec")
    return dated.groupBy("mmsi").agg(newest).select("mmsi", "_spec.*")


def result_specs(specs: DataFrame, versions: DataFrame) -> DataFrame:
    """The four specification columns carried by the result tables."""
    return latest_specs(
        specs.select(
            "mmsi", "version", F.col("ais_loa").alias("length"), F.col("ais_beam").alias("beam"),
            "StandardVesselType", "GrossTonnage",
        ),
        ("length", "beam", "StandardVesselType", "GrossTonnage"), versions,
    )


