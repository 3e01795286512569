"""The message envelope: the columns of Spark's Kafka source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
    "timestampType int"
)


def envelope_columns(
    rows: DataFrame, value: Column, *, topic: str, key: Column, offset: Column, at: Column
) -> DataFrame:
    """An envelope around ``value``, for messages that do not come from Kafka."""
    return rows.select(
        key.cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
        at.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
