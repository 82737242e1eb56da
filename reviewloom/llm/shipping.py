"""Bounds of what reaches a Python task: broadcast values and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import SparkSession


def ship(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A function that gives the value inside a task; its class travels with it. Callers see to a bounded size."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


#: Arrow batches of texts; Spark's own bounds are sixteen times as large, and a task holds several batches
BATCH_BYTES, BATCH_ROWS = "4m", "2000"


def small_batches(spark: SparkSession) -> None:
    """Has Spark send texts in small batches, unless the session has bounds of its own."""
    for name, own, usual in (
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES, "67108864b"),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS, "10000"),
    ):
        if spark.conf.get(name) == usual:
            spark.conf.set(name, own)
