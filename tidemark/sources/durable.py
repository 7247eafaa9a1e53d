"""Shared storage for intermediate tables, so that a lost executor costs no recomputation chain."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    own = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage like ``DataFrame.checkpoint`` and, as the files have a
    known size, later broadcast decisions on the table are sound.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
