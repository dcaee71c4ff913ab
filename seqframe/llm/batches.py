"""Sizes of the Arrow batches that tasks are given."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it lasts, actions hand over at most ``rows`` rows at a time: for rows of some kilobytes each."""
    before = spark.conf.get(ROWS)
    spark.conf.set(ROWS, rows)
    try:
        yield
    finally:
        spark.conf.set(ROWS, before)
