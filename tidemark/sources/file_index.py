"""An index of the files of a position table: which files can hold rows of a time range, of given cells or ships.

Parquet footers are read only after a file is planned, and their least and greatest values say little about ids that are
spread over all files. The index is two tables:

* ``files``: one row per file with its rows and its time span;
* ``filters``: a blocked Bloom filter per file and column. A value falls into one block of 32,768 bits and sets BITS of
  them, so one row tells whether a file can hold it. A file has as many blocks (a power of two) as its distinct values need.

Both are made by Spark jobs over the named columns alone and grow by new files only. A scan asks the index first and
plans the files that are left; what it plans is a list of names, as every scan of files has. Files that
the index does not know are read, files that are gone are not asked for, so a stale index costs time and no rows.
Files are taken not to change under one name, as is so for all that Spark writes.

Nulls: a null value is in no list, so it is not indexed; files without any time are read by scans without a range only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_join
from tidemark.sources.positions import scan_range

BLOCK_BITS = 32768  # fixed: the size of a bitmap of bitmap_construct_agg
BITS = 4
BITS_A_VALUE = 12
COLUMNS = ("H3_int_index_5", "mmsi")

_FILES = "file string, rows bigint, from_time timestamp, to_time timestamp"
_FILTERS = "file string, column string, blocks bigint, block bigint, bitmap binary"


def _file() -> Column:
    """The name of a row's file as ``inputFiles`` spells it."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")


def _hashes(value: Column, blocks: Column) -> tuple[Column, Column]:
    """Block of a value and the places of its bits in there."""
    text = value.cast("string")
    second = F.xxhash64(text, F.lit(1))
    places = [F.pmod(F.shiftrightunsigned(second, 15 * k), F.lit(BLOCK_BITS)) for k in range(BITS)]
    return F.pmod(F.xxhash64(text), blocks), F.array(*places)


def _filters(rows: DataFrame, column: str) -> DataFrame:
    values = rows.select("file", F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
    many = F.count(F.lit(1)).over(Window.partitionBy("file"))
    need = F.ceil(F.log2(many * F.lit(BITS_A_VALUE / BLOCK_BITS)))
    sized = values.withColumn("blocks", F.pow(F.lit(2), F.greatest(need, F.lit(0))).cast("bigint"))
    block, places = _hashes(F.col("value"), F.col("blocks"))
    bits = sized.select("file", "blocks", block.alias("block"), F.explode(F.array_distinct(places)).alias("place"))
    maps = bits.groupBy("file", "blocks", "block").agg(F.bitmap_construct_agg("place").alias("bitmap"))
    return maps.select("file", F.lit(column).alias("column"), "blocks", "block", "bitmap")


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def index_files(spark: SparkSession, path: str, index: str, columns: Sequence[str] = COLUMNS, ts: str = "dt_pos_utc") -> int:
    """Index the files of the table at ``path`` that the index does not know; returns how many these were.

    Filters are written before the files are listed as known: after a break in between they are written again, and
    equal rows do not harm.
    """
    table = spark.read.parquet(path)
    known = {r.file for r in _stored(spark, f"{index}/files", _FILES).select("file").collect()}
    new = [f for f in table.inputFiles() if f not in known]
    if new:
        rows = spark.read.schema(table.schema).option("basePath", path).parquet(*new).withColumn("file", _file())
        reduce(DataFrame.union, [_filters(rows, c) for c in columns]).write.mode("append").parquet(f"{index}/filters")
        spans = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("from_time"), F.max(ts).alias("to_time"))
        # A file without rows has no row in the table either.
        empty = spark.createDataFrame([(f,) for f in new], "file string").join(spans, "file", "left_anti")
        none = empty.select("file", F.lit(0).cast("bigint").alias("rows"), *[F.lit(None).cast("timestamp").alias(c) for c in ("from_time", "to_time")])
        spans.unionByName(none).write.mode("append").parquet(f"{index}/files")
    return len(new)


def _holding(filters: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Names of the files whose filter has one of the values, the only column of ``values``."""
    own = filters.filter(F.col("column") == column)
    wanted = values.toDF("value").filter("value IS NOT NULL").distinct()
    # Files differ in their numbers of blocks, powers of two: a value is asked once for each that exists.
    sizes = own.select("blocks").distinct().agg(F.collect_list("blocks").alias("sizes"))
    counts = sizes.first()["sizes"]
    asked = wanted.withColumn("blocks", F.explode(F.lit(counts).cast("array<bigint>")))
    block, places = _hashes(F.col("value"), F.col("blocks"))
    asked = asked.select("blocks", block.alias("block"), places.alias("places")).distinct()

    def is_set(place: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bitmap", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.floor(byte / F.pow(F.lit(2), place % 8)).cast("int") % 2 == 1

    met = lookup_join(own, asked, ["blocks", "block"], "inner").filter(F.forall("places", is_set))
    return met.select("file").distinct()


def files_for(
    spark: SparkSession, path: str, index: str, start: str | datetime | None = None, end: str | datetime | None = None,
    wanted: Mapping[str, DataFrame] | None = None,
) -> list[str]:
    """Files of the table at ``path`` that can hold rows in [start, end] with, for each column of ``wanted``, one of its values.

    Columns that were not indexed leave out no file.
    """
    files, filters = _stored(spark, f"{index}/files", _FILES), _stored(spark, f"{index}/filters", _FILTERS)
    left = files
    if start is not None:
        left = left.filter(F.col("to_time") >= F.lit(str(start)).cast("timestamp"))
    if end is not None:
        left = left.filter(F.col("from_time") <= F.lit(str(end)).cast("timestamp"))
    indexed = {r.column for r in filters.select("column").distinct().collect()}
    for column, values in (wanted or {}).items():
        if column in indexed:
            left = left.join(_holding(filters, column, values), "file", "left_semi")
    known = {r.file for r in files.select("file").collect()}
    kept = {r.file for r in left.select("file").collect()}
    return sorted(f for f in spark.read.parquet(path).inputFiles() if f in kept or f not in known)


def scan_indexed(
    spark: SparkSession, path: str, index: str, start: str | datetime, end: str | datetime,
    cells: DataFrame | None = None, cell: str = "H3_int_index_5", ships: DataFrame | None = None, ship: str = "mmsi",
    ts: str = "dt_pos_utc",
) -> DataFrame:
    """Positions in [start, end] in the listed cells and of the listed ships, read from the files that can hold them."""
    table = spark.read.parquet(path)
    wanted = {column: values.select(column) for column, values in ((cell, cells), (ship, ships)) if values is not None}
    kept = files_for(spark, path, index, start, end, wanted)
    if not kept:
        return table.filter(F.lit(False))
    rows = scan_range(spark.read.schema(table.schema).option("basePath", path).parquet(*kept), start, end, cells, cell, ts)
    if ships is not None:
        rows = lookup_join(rows, ships.select(ship).distinct(), [ship], "left_semi")
    return rows.select(table.columns)
