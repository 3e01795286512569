from __future__ import annotations

import json
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture
def messages(spark):
    """Payloads (text, None, or a dict to encode) as an envelope frame; offsets count from 0."""

    def make(*payloads, topic="t"):
        rows = [
            (offset, json.dumps(payload) if isinstance(payload, (dict, list)) else payload)
            for offset, payload in enumerate(payloads)
        ]
        frame = spark.createDataFrame(rows, "offset bigint, text string")
        return frame.select(
            F.lit(None).cast("binary").alias("key"),
            F.col("text").cast("binary").alias("value"),
            F.lit(topic).alias("topic"),
            F.lit(0).alias("partition"),
            "offset",
            F.lit("2024-01-01").cast("timestamp").alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )

    return make


def tuples(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def optimized(frame) -> str:
    return frame._jdf.queryExecution().optimizedPlan().toString()


def executed(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
