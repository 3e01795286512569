from __future__ import annotations

import pytest

from wattline import contracts as C
from wattline import feeds
from wattline.__main__ import arguments, chosen_topics
from wattline.sources import kafka_options, read_feed, resolve_topics


@pytest.mark.parametrize("feed", C.FEEDS.values(), ids=lambda feed: feed.name)
def test_feed_fills_exactly_its_table(feed):
    produced = set(feed.projection) | ({feed.date[0]} if feed.date else set())
    assert produced == set(feed.table.columns)
    assert set(feed.table.key) <= produced


@pytest.mark.parametrize("feed", [*C.FEEDS.values(), feeds.MEASUREMENT_POINTS], ids=lambda feed: feed.table.name)
def test_state_and_history_keys_are_known_columns(feed):
    extra = {"_offset", "pointtime"}
    assert set(feed.history_key) | set(feed.state_key) | {feed.order} <= set(feed.table.columns) | extra


def test_projection_refuses_one_name_twice():
    with pytest.raises(ValueError, match="two paths"):
        C.TELEMETRY.using(columns=("device", "x.device")).projection


@pytest.mark.parametrize("name", C.EARLIER_TABLES)
def test_earlier_tables_hold_their_keys_and_columns_of_their_feed(name):
    table = C.earlier_table(name)
    newest = C.feed(C.EARLIER_TABLES[name][0]).table
    renamed = {C.earlier_names(name).get(column, column) for column in newest.columns}
    assert set(table.key) <= set(table.columns) <= renamed


@pytest.mark.parametrize("name", C.EARLIER_KEYS)
def test_earlier_keys_are_columns(name):
    which, key = C.EARLIER_KEYS[name]
    assert set(key) <= set(C.feed(which).table.columns)


def test_earlier_types_differ():
    assert C.earlier_table("dev_event").types["event"] == "int"
    assert C.EVENT.table.types["event"] == "string"


def test_topics_are_checked_before_start():
    assert resolve_topics(["device"], {"device": "a"}) == {"device": "a"}
    with pytest.raises(ValueError, match="no topic configured for: device-event"):
        resolve_topics(["device", "device-event"], {"device": "a"})
    with pytest.raises(ValueError, match="unknown feed"):
        resolve_topics(["device-event-v9"], {})
    with pytest.raises(ValueError, match="one topic"):
        resolve_topics(["device", "device-event"], {"device": "a", "device-event": "a"})


def test_kafka_options():
    options = kafka_options("h:1", "t", max_offsets_per_trigger=10, min_partitions=4, extra={"failOnDataLoss": "false"})
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "10",
        "minPartitions": "4",
        "failOnDataLoss": "false",
    }
    assert kafka_options("h:1", "t", starting="latest")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka_options("h:1", "")


def test_read_feed_from_a_frame(spark, messages):
    mixed = messages({"device": "a"}, topic="x").unionByName(messages({"device": "b"}, topic="y"))
    assert read_feed(spark, C.TELEMETRY, mixed, topic="y").count() == 1
    assert read_feed(spark, C.TELEMETRY, mixed).count() == 2
    with pytest.raises(ValueError, match="no 'value' column"):
        read_feed(spark, C.TELEMETRY, spark.range(1))


def test_command_line():
    args = arguments(["--servers", "h:1", "--checkpoints", "c", "--out", "o", "--feed", "device=d"])
    assert chosen_topics(args.feed) == {"device": "d"}
    assert len(chosen_topics([])) == 8
    with pytest.raises(SystemExit):
        arguments(["--servers", "h:1", "--checkpoints", "c"])
    with pytest.raises(ValueError, match="no topic"):
        chosen_topics(["device="])
