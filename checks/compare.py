"""Run registered queries against their oracles: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

DEFAULT_DIR = "/root/testdata/sf0.01"


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples over name-sorted columns, numbers as floats."""
    cols = sorted(df.columns)

    def value(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return (0, "")
        if isinstance(v, str):
            return (2, v)
        return (1, float(v) + 0.0)

    return sorted(tuple(value(v) for v in row) for row in df[cols].astype(object).itertuples(index=False))


def check(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    start = time.time()
    got = QUERIES[name](spark, sf_dir).toPandas()
    took = time.time() - start
    if name not in ORACLES:
        return f"rows  {name}: {len(got)} rows, {took:.1f}s"
    want = con.execute(ORACLES[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"FAIL  {name}: columns {sorted(got.columns)} / {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return f"ok    {name}: {len(a)} rows, {took:.1f}s"
    only_a, only_b = set(a) - set(b), set(b) - set(a)
    return f"FAIL  {name}: {len(a)} / {len(b)} rows; e.g. {sorted(only_a)[:2]} / {sorted(only_b)[:2]}"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else DEFAULT_DIR
    spark, con = session(), connect(sf_dir)
    failed = 0
    for name in argv[1:] or list(QUERIES):
        try:
            line = check(spark, con, name, sf_dir)
        except Exception as exc:  # report and go on with the rest
            line = f"FAIL  {name}: {type(exc).__name__} {str(exc)[:600]}"
        failed += line.startswith("FAIL")
        print(line, flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
