"""Structured Streaming: sinks, keyed upsert and the query runner."""
