"""Values for Python workers, shipped by value."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def by_value(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A function that gives ``value`` in a task.

    A broadcast names classes by their module, which executors may not have; here the classes of this package go with it.
    """
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)
