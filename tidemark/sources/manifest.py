"""A write-ahead manifest: results that many runs store, of which readers see those that were committed.

A run covers units, say days or date ranges. It is *planned* (its units are noted), *stored* (its tables are complete)
and *committed*. Each step is one small file, renamed into place, so it is there or not. A unit belongs to the
run that committed it last; what other runs stored for it, finished or not, is never read. So a
run that broke off at any step and was repeated, for the same units or others, counts
once, and a committed unit is replaced by committing it again.

Layout below ``path``: ``manifest/<run>-<state>`` and ``<table>/run=<run>/unit=<unit>``. Units as many as ships would be too many folders
and files: :meth:`Manifest.store_many` writes the files of ``<table>-many/run=<run>`` with the unit as a column.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

STATES = ("planned", "stored", "committed")
ENTRY = "run string, state string, place bigint, unit string, gone boolean"


@dataclass(frozen=True)
class Run:
    """A planned run; ``place`` orders runs: of two that cover a unit, the higher one has it once both are committed."""

    name: str
    place: int


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(ENTRY).option("recursiveFileLookup", True).parquet(f"{self.path}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRY)

    def _note(self, run: Run, state: str, units: DataFrame) -> None:
        rows = units.select(F.lit(run.name).alias("run"), F.lit(state).alias("state"), F.lit(run.place).cast("bigint").alias("place"), "unit", "gone")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{run.name}-{state}")

    def plan(self, units: DataFrame, gone: bool = False) -> Run:
        """A run over ``units`` (column ``unit``, text)."""
        last = self.entries().agg(F.max("place")).first()[0] or 0
        run = Run(uuid.uuid4().hex, last + 1)
        named = units.select(F.col("unit").cast("string").alias("unit"), F.lit(gone).alias("gone")).distinct()
        self._note(run, "planned", named)
        return run

    def _planned(self, run: Run) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(f"{self.path}/manifest/{run.name}-planned")

    def store(self, run: Run, **tables: DataFrame) -> None:
        """Writes tables with a column ``unit``; a unit may have no rows. Storing again replaces what the run stored."""
        for name, rows in tables.items():
            rows.write.mode("overwrite").partitionBy("unit").parquet(f"{self.path}/{name}/run={run.name}")
        self._note(run, "stored", self._planned(run))

    def store_many(self, run: Run, **tables: DataFrame) -> None:
        """As :meth:`store`, for units without number: a run's files do not follow them."""
        for name, rows in tables.items():
            rows.withColumn("unit", F.col("unit").cast("string")).write.mode("overwrite").parquet(f"{self.path}/{name}-many/run={run.name}")
        self._note(run, "stored", self._planned(run))

    def commit(self, run: Run) -> None:
        """From now on the run's units are read from it."""
        self._note(run, "committed", self._planned(run))

    def retract(self, units: DataFrame) -> None:
        """``units`` count as never done, until a run commits them again. What they had stored is no longer read."""
        self.commit(self.plan(units, gone=True))

    def owners(self) -> DataFrame:
        """(unit, run) of all committed units."""
        order = Window.partitionBy("unit").orderBy(F.desc("place"), F.desc("run"))
        latest = self.entries().filter("state = 'committed'").withColumn("_n", F.row_number().over(order)).filter("_n = 1")
        return latest.filter("NOT gone").select("unit", "run")

    def pending(self, units: DataFrame) -> DataFrame:
        """Those of ``units`` that are not committed."""
        named = units.select(F.col("unit").cast("string").alias("unit")).distinct()
        return named.join(self.owners(), "unit", "left_anti")

    def unfinished(self) -> DataFrame:
        """(run, state) of runs that were never committed; ``stored`` ones are complete."""
        states = self.entries().groupBy("run").agg(F.collect_set("state").alias("_s"))
        left = states.filter(~F.array_contains("_s", "committed"))
        return left.select("run", F.when(F.array_contains("_s", "stored"), "stored").otherwise("planned").alias("state"))

    def read(self, table: str, schema: str) -> DataFrame:
        """The rows of all committed units, with their ``unit``; ``schema``: the other columns."""
        full = f"{schema}, unit string, run string"

        def below(folder: str) -> DataFrame:
            try:
                return self.spark.read.schema(full).parquet(f"{self.path}/{folder}")
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                return self.spark.createDataFrame([], full)

        rows = below(table).unionByName(below(f"{table}-many"))
        return rows.join(self.owners(), ["unit", "run"], "left_semi").drop("run")
