"""Zone tagging by cell id, and zone classes."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import constants as K
from tidemark.operators.lookup import lookup_join

ZONE_SCHEMA = T.StructType([
    T.StructField("Name", T.StringType(), True),
    T.StructField("H3_int_index_10", T.LongType(), True),
])


def zone_lookup(spark: SparkSession, rows: Sequence[tuple[str, int]]) -> DataFrame:
    """Lookup of (zone name, cell id) pairs with the fixed schema.

    Built from an Arrow table, whose size the optimizer knows.
    """
    names, cells = zip(*rows) if rows else ((), ())
    table = pa.table({"Name": pa.array(names, pa.string()), "H3_int_index_10": pa.array(cells, pa.int64())})
    return spark.createDataFrame(table, ZONE_SCHEMA)


def one_name_per_cell(zones: DataFrame, cell: str = "H3_int_index_10") -> DataFrame:
    """A cell inside several zones takes the least name."""
    return zones.groupBy(cell).agg(F.min("Name").alias("Name"))


def zone_tag(
    positions: DataFrame, zones: DataFrame, how: str = "inner",
    cell: str = "H3_int_index_10", ts: str = "dt_pos_utc",
) -> DataFrame:
    """Add ``Name``; ``how='left'`` keeps positions outside every zone."""
    return lookup_join(positions, one_name_per_cell(zones, cell), [cell], how)


def exclude_tugs(positions: DataFrame, tugs: Sequence[str] = K.TUGS) -> DataFrame:
    """Drop tugs. A null vessel name is dropped too, as ``NOT IN`` is null for it."""
    return positions.filter(~F.col("vessel_name").isin(list(tugs)))


def canon_zones(df: DataFrame, parts: Sequence[str] = K.ATLANTIC_ANCHORAGE_PARTS, name: str = "Name") -> DataFrame:
    """Rename the breakwater areas to the anchorage they belong to."""
    return df.withColumn(
        name, F.when(F.col(name).isin(list(parts)), F.lit(K.ATLANTIC_ANCHORAGE)).otherwise(F.col(name))
    )


def zone_class(name: Column | str = "Name") -> Column:
    """port, anchorage, lock, stop or other; null for no zone."""
    c = F.col(name) if isinstance(name, str) else name
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(c.isin(K.PORTS), "port")
        .when(c.isin(K.ANCHORAGES), "anchorage")
        .when(c.isin(K.LOCKS), "lock")
        .when(c.isin(K.STOPS), "stop")
        .otherwise("other")
    )


def at_anchor(name: str = "Name", sog: str = "sog") -> Column:
    """Slow row in an anchorage, counted in an anchorage stay."""
    return F.col(name).isin(K.ANCHORAGES) & (F.col(sog) < 3)


def at_stop(name: str = "Name", sog: str = "sog") -> Column:
    """Slow row in a port or Gatun Anchorage, counted as a stop during a transit."""
    gatun = (F.col(name) == K.GATUN_ANCHORAGE) & (F.col(sog) < 3)
    return gatun | (F.col(name).isin(K.PORTS) & (F.col(sog) < 1))


def in_port(name: str = "Name", sog: str = "sog") -> Column:
    return F.col(name).isNotNull() & (F.col(sog) <= 1)


def anchoring_off_zone(name: str = "Name", sog: str = "sog") -> Column:
    return F.col(name).isNull() & (F.col(sog) > 1) & (F.col(sog) <= 3)


def identity_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with an IMO number, and rows without."""
    return df.filter(F.col("imo").isNotNull()), df.filter(F.col("imo").isNull())


def near_coast_port(positions: DataFrame, coast_5: DataFrame, port_1: DataFrame, port_5: DataFrame) -> DataFrame:
    """Add the buffer flags ``coast5``, ``port1`` and ``port5``."""
    out = positions
    for layer, cell, ident, flag in (
        (coast_5, "H3_int_4", "id_coast_5", "coast5"),
        (port_1, "H3_int_8", "id_port_1", "port1"),
        (port_5, "H3_int_8", "id_port_5", "port5"),
    ):
        cells = layer.filter(F.col(ident).isNotNull()).select(cell).distinct().withColumn(flag, F.lit(True))
        out = lookup_join(out, cells, [cell], "left")
        out = out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return out
