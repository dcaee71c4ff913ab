from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def records(spark):
    """(sample_id, sequence) rows, with their order in ``ord``."""

    def make(*rows: tuple[str, str]):
        return spark.createDataFrame(
            [(i, k, s) for i, (k, s) in enumerate(rows)], "ord BIGINT, sample_id STRING, sequence STRING"
        )

    return make
