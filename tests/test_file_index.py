import random

import pytest
from conftest import BASE, rows_of
from pyspark.sql import functions as F

from tidemark.sources import file_index
from tidemark.sources.positions import scan_range

SCHEMA = "event_id long, mmsi long, dt_pos_utc timestamp, H3_int_index_5 long"
DAY = 86400


@pytest.fixture
def table(frame, tmp_path):
    """40 files, ten cells in each; a ship sails through four files; ids are spread, so that spans tell nothing."""
    rng = random.Random(3)
    rows = [(40 * k + f, (7919 * (f // 4)) % 1009, f * DAY // 2 + k * 60, (104729 * (10 * f + k % 10)) % 1000003) for f in range(40) for k in range(40)]
    rows += [(9000, None, None, None), (9001, 5, None, 17), (9002, None, 3 * DAY, None)]
    rng.shuffle(rows)
    path = str(tmp_path / "positions")
    part = F.coalesce(F.floor((F.unix_timestamp("dt_pos_utc") - BASE) / (DAY // 2)), F.lit(40)).cast("int")
    frame(SCHEMA, rows).withColumn("part", part).repartitionByRange(41, "part").sortWithinPartitions("part").drop("part").write.parquet(path)
    return path, str(tmp_path / "index"), rows


def wanted(spark, column, values):
    return spark.createDataFrame([(v,) for v in values], f"{column} long")


def test_a_cell_list_skips_files(spark, table):
    path, index, rows = table
    n_files = len(spark.read.parquet(path).inputFiles())
    assert file_index.index_files(spark, path, index) == n_files >= 35
    cells = sorted({r[3] for r in rows if r[3]})
    some = wanted(spark, "H3_int_index_5", [cells[5], cells[100], None])
    kept = file_index.files_for(spark, path, index, wanted={"H3_int_index_5": some})
    holders = {r.f for r in spark.read.parquet(path).select("*", file_index._file().alias("f")).filter(
        F.col("H3_int_index_5").isin(cells[5], cells[100])).select("f").collect()}
    assert holders <= set(kept) and len(kept) <= len(holders) + 1
    found = file_index.scan_indexed(spark, path, index, "2024-01-01", "2024-03-01", some)
    assert sorted(found.inputFiles()) == kept
    plain = scan_range(spark.read.parquet(path), "2024-01-01", "2024-03-01", some)
    assert rows_of(found, "event_id", "mmsi") == rows_of(plain, "event_id", "mmsi") != []


def test_ships_and_times_skip_files(spark, table):
    path, index, rows = table
    file_index.index_files(spark, path, index)
    ships = wanted(spark, "mmsi", [rows_ship := 7919 % 1009])
    found = file_index.scan_indexed(spark, path, index, "2024-01-01", "2024-03-01", ships=ships)
    assert {r[0] for r in rows_of(found, "mmsi")} == {rows_ship} and found.count() == 160
    assert len(found.inputFiles()) <= 6
    both = file_index.scan_indexed(spark, path, index, "2024-01-03 00:00:00", "2024-01-03 11:00:00", ships=ships)
    assert both.count() == 40 and len(both.inputFiles()) <= 3
    nothing = file_index.scan_indexed(spark, path, index, "2030-01-01", "2030-02-01", ships=ships)
    assert nothing.count() == 0 and nothing.columns == found.columns


def test_files_that_the_index_does_not_know_are_read(spark, frame, table):
    path, index, _ = table
    file_index.index_files(spark, path, index)
    frame(SCHEMA, [(7777, 42, DAY, 1234567)]).write.mode("append").parquet(path)
    cells = wanted(spark, "H3_int_index_5", [1234567])
    assert rows_of(file_index.scan_indexed(spark, path, index, "2024-01-01", "2024-03-01", cells), "event_id") == [(7777,)]
    assert file_index.index_files(spark, path, index) == 1
    assert file_index.index_files(spark, path, index) == 0
    found = file_index.scan_indexed(spark, path, index, "2024-01-01", "2024-03-01", cells)
    assert rows_of(found, "event_id") == [(7777,)] and len(found.inputFiles()) <= 2
    no_index = file_index.scan_indexed(spark, path, f"{index}-none", "2024-01-01", "2024-03-01", cells)
    assert rows_of(no_index, "event_id") == [(7777,)]


def test_filters_grow_with_the_values_of_a_file(spark, tmp_path):
    path, index = str(tmp_path / "wide"), str(tmp_path / "index")
    rows = spark.range(20000).select(
        F.col("id").alias("event_id"), (F.col("id") % 3).alias("mmsi"), F.timestamp_seconds(F.lit(BASE) + F.col("id")).alias("dt_pos_utc"),
        (F.col("id") * 7919).alias("H3_int_index_5"))
    rows.coalesce(1).write.parquet(path)
    file_index.index_files(spark, path, index)
    blocks = {(r.column, r.blocks) for r in spark.read.parquet(f"{index}/filters").select("column", "blocks").distinct().collect()}
    assert blocks == {("H3_int_index_5", 8), ("mmsi", 1)}
    there = [wanted(spark, "H3_int_index_5", [7919 * k]) for k in (0, 19999)]
    assert all(len(file_index.files_for(spark, path, index, wanted={"H3_int_index_5": w})) == 1 for w in there)
    # Of values that no file has few pass.
    filters = spark.read.parquet(f"{index}/filters")
    own, asked = filters.filter("column = 'H3_int_index_5'"), spark.range(1, 2001).select((F.col("id") * 7919 + 5).alias("v"))
    block, places = file_index._hashes(F.col("v"), F.lit(8))
    many = own.select("block", "bitmap").join(asked.select(block.alias("block"), places.alias("places")), "block")
    bit = "forall(places, p -> shiftright(cast(conv(hex(substring(bitmap, cast(p div 8 as int) + 1, 1)), 16, 10) as int), cast(p % 8 as int)) % 2 = 1)"
    assert many.count() == 2000 and many.filter(bit).count() < 100
