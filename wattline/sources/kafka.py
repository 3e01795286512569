"""Kafka scans. The connector package and the endpoints are the caller's."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    *,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a one-topic scan.

    ``starting="latest"`` skips what the topic held before the first start. ``max_offsets_per_trigger`` bounds a
    micro-batch (without it the first one reads the whole topic); ``min_partitions`` splits few, large topic
    partitions over more tasks.
    """
    if not servers or not topic:
        raise ValueError("a Kafka scan needs servers and a topic")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return {**options, **(extra or {})}


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()
