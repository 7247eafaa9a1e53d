"""Files that tasks write to the shared folder and read back, by any pyarrow filesystem.

A task writes under a name of its own and reports it in the rows it returns; the
table of these rows, once stored, is the commit. What a lost or repeated attempt
leaves behind is in no such table and is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.durable import CHECKPOINT_CONF


def task_each(table: DataFrame) -> DataFrame:
    """The rows of a stored table of files, one task each. Without a number adaptive execution would see a few
    short rows and put all files into one task."""
    return table.repartition(max(1, table.count()))


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


# Schemes that pyarrow knows, and the names that Hadoop has for some of them.
SCHEMES = ("file", "hdfs", "viewfs", "s3", "gs", "abfs", "abfss")
HADOOP_NAMES = {"s3a": "s3", "s3n": "s3"}


def folder_uri(path: str) -> str:
    """The path as a URI that tasks can open with pyarrow.

    A path without a scheme lies on the file system that Spark takes by default, not on each executor's own disk.
    """
    spark = SparkSession.active()
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()
    scheme, _, rest = whole.partition(":")
    scheme = HADOOP_NAMES.get(scheme, scheme)
    if scheme not in SCHEMES:
        raise ValueError(f"tasks cannot open files on {scheme}: set {CHECKPOINT_CONF} to a folder on one of {', '.join(SCHEMES)}")
    # Hadoop writes file:/x, pyarrow file:///x.
    return "file:///" + rest.lstrip("/") if scheme == "file" else f"{scheme}:{rest}"


def fresh_name(folder: str, kind: str) -> str:
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}.{kind}"


def make_folder(folder: str) -> None:
    system, path = _located(folder)
    system.create_dir(path, recursive=True)


def open_output(uri: str):
    system, path = _located(uri)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    system, path = _located(uri)
    return system.open_input_file(path)
