"""One way to open a feed, whatever carries its messages."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from wattline.contracts import Feed, feed
from wattline.sources.kafka import kafka_options, kafka_stream


def resolve_topics(names: Iterable[str], topics: Mapping[str, str]) -> dict[str, str]:
    """Topic of every named feed; unknown feeds and feeds without a topic are errors before anything starts."""
    names = list(names)
    for name in names:
        feed(name)
    missing = [name for name in names if not topics.get(name)]
    if missing:
        raise ValueError(f"no topic configured for: {', '.join(missing)}")
    chosen = {name: topics[name] for name in names}
    if len(set(chosen.values())) < len(chosen):
        raise ValueError("two feeds are configured on one topic")
    return chosen


def read_feed(
    spark: SparkSession, which: Feed, source: DataFrame | str, *, topic: str | None = None, **kafka
) -> DataFrame:
    """The feed's messages from a frame with the envelope columns, or from Kafka servers given as text."""
    if isinstance(source, str):
        return kafka_stream(spark, kafka_options(source, topic or which.topic, **kafka))
    if "value" not in source.columns:
        raise ValueError(f"feed {which.name}: the source has no 'value' column")
    if topic is not None and "topic" in source.columns:
        return source.filter(source["topic"] == topic)
    return source
