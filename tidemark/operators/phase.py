"""Operational phase of a position from its speed, surroundings and load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import constants as K


def with_load(df: DataFrame) -> DataFrame:
    """Speed as a share of the service speed; null for an unknown or zero service speed."""
    return df.withColumn("load", F.try_divide(F.col("sog"), F.col("Speed")))


def op_phase(df: DataFrame) -> DataFrame:
    """Add ``op_phase``. Needs sog, load, StandardVesselType, coast5, port1 and port5."""
    sog, port1, port5, coast5 = F.col("sog"), F.col("port1"), F.col("port5"), F.col("coast5")
    cruise: Column = F.when(F.col("load") <= K.SLOW_LOAD, K.SLOW_TRANSIT).otherwise(K.NORMAL_CRUISING)
    tanker_in_port_area = F.col("StandardVesselType").isin(K.TANKER_TYPES) & port5
    phase = (
        F.when((sog <= K.BERTH_SPEED) & port5, K.BERTH)
        .when(sog <= K.ANCHORAGE_SPEED, K.ANCHORAGE)
        .when((sog <= K.MANOEUVRING_SPEED) & (coast5 | port5), K.MANOEUVRING)
        .when((sog > K.MANOEUVRING_SPEED) & port1 & ~F.coalesce(tanker_in_port_area, F.lit(False)), K.MANOEUVRING)
        .when(sog > K.ANCHORAGE_SPEED, cruise)
    )
    return df.withColumn("op_phase", phase)
