"""Reference tables from CSV: factor tables and cell layers, checked before anything is joined to them.

A file is read by a declared schema. Its header must name the columns in their order, each line must
fit, and the key must be present and unique, as a second row for a key would double the positions joined to it. The
checked rows are stored, so that their size is known when Spark chooses how to join them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.emissions import FactorTables
from tidemark.sources.durable import checkpoint

CORRUPT = "_corrupt_line"
SHOWN = 3


class TableError(ValueError):
    """A reference table that does not say what it should."""


@dataclass(frozen=True)
class Declared:
    """Columns of a table as a schema string, and those that tell its rows apart."""

    schema: str
    key: tuple[str, ...]


_SHIP_LOADS = ", ".join(f"{engine}_{phase} double" for engine in ("ae", "ab") for phase in ("sea", "berth", "man", "anch"))

FACTORS = {
    "table_17": Declared(f"StandardVesselType string, imobin int, {_SHIP_LOADS}", ("StandardVesselType", "imobin")),
    "table_44": Declared("StandardVesselType string, imobin int, weather double, fouling double", ("StandardVesselType", "imobin")),
    "table_19_1": Declared("meType string, fuel string, _83 double, `84_2000` double, `2001_` double, pilot_mdo double", ("meType", "fuel")),
    "table_19_2": Declared("fuel string, meType string, ae_ab_83 double, ae_ab_84_2000 double, ae_ab_2001_ double", ("fuel", "meType")),
    "table_21": Declared("fuel string, ef_co2 double", ("fuel",)),
    "table_55_56": Declared("meType string, fuel string, ef_ch4 double", ("meType", "fuel")),
    "table_59_60": Declared("meType string, fuel string, ef_n2o double", ("meType", "fuel")),
}
# A cell may be near several ports: the join takes each cell once.
LAYERS = {
    "coast_5": Declared("H3_int_4 bigint, id_coast_5 bigint", ("H3_int_4", "id_coast_5")),
    "port_1": Declared("H3_int_8 bigint, id_port_1 bigint", ("H3_int_8", "id_port_1")),
    "port_5": Declared("H3_int_8 bigint, id_port_5 bigint", ("H3_int_8", "id_port_5")),
}


def _examples(rows: DataFrame, columns: Sequence[str]) -> str:
    return "; ".join(", ".join(map(str, r)) for r in rows.select(*columns).limit(SHOWN).collect())


def read_csv_table(spark: SparkSession, path: str, declared: Declared, separator: str = ",") -> DataFrame:
    """The rows of the CSV file or folder at ``path``; raises :class:`TableError` if they are not as declared."""
    schema = T.StructType([*T._parse_datatype_string(declared.schema).fields, T.StructField(CORRUPT, T.StringType())])
    names = [f.name for f in schema.fields[:-1]]
    found = spark.read.options(header=True, sep=separator).csv(path).columns
    if found != names:
        raise TableError(f"{path}: the header names {', '.join(found)}, not {', '.join(names)}")
    # The headers of further files of a folder are held against the schema by the scan.
    rows = checkpoint(spark.read.schema(schema).options(header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, sep=separator).csv(path))
    corrupt = rows.filter(F.col(CORRUPT).isNotNull())
    if not corrupt.isEmpty():
        raise TableError(f"{path}: lines that do not fit: {_examples(corrupt, [CORRUPT])}")
    missing = F.lit(False)
    for c in declared.key:
        missing = missing | F.col(f"`{c}`").isNull()
    absent = rows.filter(missing)
    if not absent.isEmpty():
        raise TableError(f"{path}: rows without {' or '.join(declared.key)}: {_examples(absent, [f'`{c}`' for c in names])}")
    repeated = rows.groupBy(*declared.key).count().filter("count > 1")
    if not repeated.isEmpty():
        raise TableError(f"{path}: more than one row for {_examples(repeated.orderBy(*declared.key), declared.key)}")
    return rows.drop(CORRUPT)


def read_factors(spark: SparkSession, folder: str, separator: str = ",") -> FactorTables:
    """The factor tables ``<name>.csv`` of a folder, see :data:`FACTORS`."""
    return FactorTables(**{name: read_csv_table(spark, f"{folder.rstrip('/')}/{name}.csv", d, separator) for name, d in FACTORS.items()})


def read_layers(spark: SparkSession, folder: str, separator: str = ",") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The coast and port layers ``<name>.csv`` of a folder, see :data:`LAYERS`."""
    coast, near, far = (read_csv_table(spark, f"{folder.rstrip('/')}/{name}.csv", d, separator) for name, d in LAYERS.items())
    return coast, near, far
