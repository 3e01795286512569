"""Where messages come from: Kafka topics, files with the same envelope, typed JSON files."""

from wattline.sources.envelope import ENVELOPE, envelope_columns
from wattline.sources.files import json_files, message_files
from wattline.sources.kafka import kafka_options, kafka_stream
from wattline.sources.reader import read_feed, resolve_topics

__all__ = [
    "ENVELOPE",
    "envelope_columns",
    "json_files",
    "kafka_options",
    "kafka_stream",
    "message_files",
    "read_feed",
    "resolve_topics",
]
