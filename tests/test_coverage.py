"""What is not there: undeclared fields, missing intervals, sketched collisions, versions without a reading."""

from __future__ import annotations

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import executed, tuples
from wattline import contracts as C
from wattline.operators import audit, drift, gaps, joins
from wattline.streaming.runner import Job, run_available, stateful_session
from wattline.streaming.sinks import files_sink

DAY = datetime.datetime(2024, 1, 1)
INTERVALS = "device string, s timestamp, e timestamp, gap_start string"


def hour(n):
    return None if n is None else DAY + datetime.timedelta(hours=n)


# --- drift


def test_drift_of_odd_payloads(spark, messages):
    odd = messages(
        {"device": "a", "occurrenceCount": {"x": 1}, "context": {"k": [1, {"z": 2}]}, "new": {"a": [1, 2.5, []], "b": None}},
        {"event": [], "state": {}, "occurrenceCount": True}, [1, {"q": 2}], "3", "nope", "", None,
    )
    got = {tuple(row) for row in drift.schema_drift(C.EVENT, odd).collect()}
    absent = ("firstOccurrenceTime", "lastOccurrenceTime", "persistTime", "receiveTime")
    assert got == {
        (None, "UNREADABLE", 3, "unreadable"), ("", "BIGINT", 1, "mismatch"),
        ("[]", "BIGINT", 1, "undeclared"), ("[].q", "BIGINT", 1, "undeclared"),
        ("device", "STRING", 1, "declared"), ("context", "OBJECT", 2, "declared"), ("event", "ARRAY", 1, "declared"),
        ("state", "OBJECT", 1, "declared"), ("occurrenceCount", "OBJECT", 1, "mismatch"),
        ("occurrenceCount", "BOOLEAN", 1, "mismatch"), ("new.b", "VOID", 1, "undeclared"),
        *[("new.a[]", kind, 1, "undeclared") for kind in ("BIGINT", "DECIMAL", "ARRAY")],
        *[(path, None, 0, "absent") for path in absent],
    }


def test_observed_paths_are_those_of_a_plain_walk(spark, messages):
    rng = random.Random(3)

    def value(level):
        kind = rng.randrange(6 if level < 4 else 4)
        if kind == 4:
            return {rng.choice("abc"): value(level + 1) for _ in range(rng.randrange(3))}
        if kind == 5:
            return [value(level + 1) for _ in range(rng.randrange(3))]
        return [7, "x", None, True][kind]

    payloads = [{name: value(1) for name in "pq"} for _ in range(60)]

    def walk(x, path):
        if isinstance(x, dict) and x:
            for name, own in x.items():
                yield from walk(own, f"{path}.{name}" if path else name)
        elif isinstance(x, list) and x:
            for own in x:
                yield from walk(own, f"{path}[]")
        else:
            kinds = {dict: "OBJECT", list: "ARRAY", int: "BIGINT", str: "STRING", bool: "BOOLEAN", type(None): "VOID"}
            yield path, kinds[type(x)]

    want = {}
    for payload in payloads:
        for found in walk(payload, ""):
            want[found] = want.get(found, 0) + 1
    seen = drift.observed_paths(messages(*payloads))
    assert {(row.path, row.kind): row.n for row in seen.collect()} == want
    assert executed(seen).lower().count("try_parse_json") <= 1 and "Python" not in executed(seen)
    shallow = drift.observed_paths(messages({"a": {"b": {"c": 1}}}), depth=2)
    assert tuples(shallow) == [("a.b", "OBJECT", 1)]
    assert drift.observed_paths(messages(*payloads).limit(0)).count() == 0


def test_declared_paths_go_through_arrays_and_stop_at_maps():
    paths = drift.declared_paths("a struct<b: array<struct<c: int>>>, m map<string, struct<x: int>>, l array<string>")
    assert list(paths) == ["a.b[].c", "m", "l[]"]
    json.dumps([str(kind) for kind in paths.values()])


# --- missing intervals


def plain_gaps(rows, since, until, expected):
    out = []
    for key in {row[0] for row in rows if None not in row[1:3] and row[1] < row[2]} | set(expected):
        own = sorted((max(s, since), min(e, until)) for k, s, e in rows if k == key and None not in (s, e) and s < e)
        reached = since
        for s, e in own:
            if s >= e:
                continue
            if s > reached:
                out.append((key, reached, s))
            reached = max(reached, e)
        if reached < until:
            out.append((key, reached, until))
    return out


@pytest.mark.parametrize("bin_days", [1, 3, 400])
def test_missing_intervals_are_those_of_a_plain_walk(spark, bin_days):
    rng = random.Random(bin_days)
    keys = [None, "hot", *[f"d{i}" for i in range(6)]]
    rows = []
    for i in range(400):
        start = rng.choice([None, *range(0, 24 * 20, 5)]) if i % 9 == 0 else rng.randrange(24 * 20)
        length = rng.choice([0, -3, 1, 2, 5, 40])
        end = None if start is None or i % 31 == 0 else start + length
        rows.append(("hot" if i % 3 == 0 else rng.choice(keys), hour(start), hour(end)))
    rows += rows[:20]
    frame = spark.createDataFrame([(*row, "own") for row in rows], INTERVALS)
    expected = spark.createDataFrame([(k,) for k in (None, "d0", "silent")], "device string")
    since, until = hour(30), hour(24 * 18)
    got = gaps.missing_intervals(
        frame, ["device"], "s", "e", since=since, until=until, expected=expected, bin_days=bin_days
    )
    want = [row for row in plain_gaps(rows, since, until, [None, "d0", "silent"])]
    assert tuples(got) == sorted(want, key=repr)
    totals = {row.device: (row.gaps, row.longest_micros) for row in gaps.completeness(got, ["device"]).collect()}
    assert totals["silent"] == (1, (until - since) // datetime.timedelta(microseconds=1))


def test_missing_intervals_of_little(spark):
    one = spark.createDataFrame([("a", hour(1), hour(2), ""), ("a", hour(5), hour(6), ""), ("a", hour(2), hour(3), "")], INTERVALS)
    assert tuples(gaps.missing_intervals(one, ["device"], "s", "e")) == [("a", hour(3), hour(5))]
    assert gaps.missing_intervals(one.limit(0), ["device"], "s", "e").count() == 0
    with pytest.raises(ValueError, match="calendar"):
        gaps.missing_intervals(one, ["device"], "s", "e", expected=one)
    with pytest.raises(ValueError, match="ends before"):
        gaps.missing_intervals(one, ["device"], "s", "e", since=hour(2), until=hour(2))


# --- sketches


def test_merged_sketches_estimate_what_all_batches_hold(spark, scratch):
    keys = {"pair": ("a", "b"), "one": ("a",)}
    rows = spark.range(40_000).select(
        (F.col("id") % 9000).alias("a"), F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("b"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("part"), F.floor(F.col("id") / 10_000).alias("batch"),
    )
    write = files_sink(f"{scratch}/sketches")
    for batch in (0, 1, 2, 3, 3):  # the last one is replayed
        write(audit.key_sketches(rows.where(F.col("batch") == batch), keys, ["part"]), batch)
    stored = spark.read.parquet(f"{scratch}/sketches")
    for by in (["part"], []):
        got = {tuple(row[: len(by) + 1]): row for row in audit.sketched_collisions(stored, by).collect()}
        for name, key in keys.items():
            for row in rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(F.struct(*key)).alias("kept")).collect():
                own = got[(*row[: len(by)], name)]
                assert own.rows_in == row.n == own.rows_kept + own.rows_lost
                assert abs(own.rows_kept - row.kept) <= 0.05 * row.kept


# --- left outer join of streams


@pytest.mark.parametrize("salts", [1, 3])
def test_a_version_without_reading_comes_once(spark, scratch, salts):
    own = stateful_session(spark, 2, idle_batches=True)
    versions = [("a", 0, "a0"), ("a", 1, "a1"), ("b", 2, "b2"), ("c", 60, "c60"), ("end", 900, "v")]
    readings = [("a", 3, "r1"), ("a", 11, "r2"), ("c", 20, "r3"), (None, 5, "r4"), ("end", 900, "r5")]

    def stream(rows, time, name):
        for number, part in enumerate((rows[:2], rows[2:4], rows[4:])):
            frame = own.createDataFrame([(k, hour(t), x) for k, t, x in part], f"k string, {time} timestamp, {name} string")
            frame.coalesce(1).write.mode("append").parquet(f"{scratch}/{name}")
        return own.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/{name}")

    joined = joins.join_versions_within(
        stream(versions, "at", "v"), stream(readings, "seen", "r"), "k", version_time="at", reading_time="seen",
        within="10 hours", lateness="100 hours", salts=salts, how="left",
    )
    job = Job("left", joined, sink=files_sink(f"{scratch}/rows", gather=False))
    for _ in range(2):  # a second run finds nothing new
        run_available(own, [job], f"{scratch}/checkpoints")
    got = [(row.v, row.r) for row in spark.read.parquet(f"{scratch}/rows").where("k <> 'end'").collect()]
    assert sorted(got, key=repr) == sorted(
        [("a0", "r1"), ("a1", "r1"), ("a1", "r2"), ("b2", None), ("c60", None)], key=repr
    )
    with pytest.raises(ValueError, match="inner or left"):
        joins.join_versions_within(
            joined, joined, "k", version_time="at", reading_time="seen", within="1 hour", lateness="1 hour", how="full"
        )
