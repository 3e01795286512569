"""Layout by device, topology, intervals, and streams whose state follows event time."""

from __future__ import annotations

import datetime
import random
from collections import Counter, defaultdict, deque
from types import SimpleNamespace

import pytest
from pyarrow import parquet
from pyspark.sql import functions as F

from tests.conftest import executed, optimized, tuples
from wattline import feeds
from wattline.operators import closure, intervals, keyed, layout
from wattline.plans import stream_plans, wire
from wattline.plans.stream_plans import SLICE_DAYS, timed_topic
from wattline.streaming import audit_log, silence, windows
from wattline.streaming.runner import Job, run_available, start, stateful_session, stop
from wattline.streaming.sinks import files_sink
from wattline.streaming.storage import names, size

DAY = datetime.date(2024, 1, 15)
NOON = datetime.datetime(2024, 1, 15, 12)


def at(minutes):
    return NOON + datetime.timedelta(minutes=minutes)


# --- layout


@pytest.fixture
def store(spark, scratch):
    rows = spark.range(60_000).select(
        F.date_add(F.lit(DAY), (F.col("id") % 2).cast("int")).alias("date"),
        F.when(F.col("id") % 3 == 0, "D000").otherwise(F.format_string("D%03d", F.col("id") % 997)).alias("device"),
        F.timestamp_seconds(F.col("id") * 60).alias("time"),
        F.col("id").alias("value"),
    )
    layout.write_clustered(rows, f"{scratch}/store", ["date"], ["device"], ["time"], files=6, row_group_bytes=8192, distinct_keys=500)
    return rows, spark.read.parquet(f"{scratch}/store")


def rows_scanned(frame):
    frame.collect()
    scan = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numOutputRows").value()


def test_a_device_reads_few_row_groups_of_its_date(store):
    rows, stored = store
    one = keyed.slice_by(stored, date=DAY, device="D500").select("date", "device", "time", "value")
    assert tuples(one) == tuples(rows.where(F.col("date") == DAY).where("device = 'D500'"))
    assert "PushedFilters: [IsNotNull(device), EqualTo(device,D500)]" in executed(one)
    assert rows_scanned(one) < 30_000 / 20  # of the date's 30,000
    assert rows_scanned(keyed.slice_by(stored, date=DAY, device="D500x")) < 30_000 / 20  # within the range, but not there


def test_a_hot_device_spans_files_and_is_sorted_in_each(store):
    _, stored = store
    hot = stored.where("device = 'D000'").select(F.input_file_name().alias("file"), "time")
    assert hot.select("file").distinct().count() > 2
    for _, times in hot.groupBy("file").agg(F.collect_list("time")).collect():
        assert times == sorted(times, reverse=True)


# --- topology


def brute_descendants(links):
    below = defaultdict(set)
    for a, b in links:
        if a is not None and b is not None and a != b:
            below[a].add(b)
    out = set()
    for top in list(below):
        depth, todo = {top: 0}, deque([top])
        while todo:
            own = todo.popleft()
            for child in below.get(own, ()):
                if child not in depth:
                    depth[child] = depth[own] + 1
                    todo.append(child)
        out |= {(top, low, n) for low, n in depth.items() if low != top}
    return out


def test_descendants_of_chains_cycles_and_a_hub(spark):
    rng = random.Random(3)
    links = [(f"c{i}", f"c{i + 1}") for i in range(21)] + [(f"r{i}", f"r{(i + 1) % 9}") for i in range(9)]
    links += [("hub", f"x{i}") for i in range(40)] + [(f"y{i}", "hub") for i in range(20)] + [("r3", "c5"), ("x7", "r0")]
    links += [(f"g{rng.randrange(30)}", f"g{rng.randrange(30)}") for _ in range(45)]
    links += [("a", "a"), (None, "a"), ("a", None), ("c1", "c2"), ("c1", "c2")]
    frame = spark.createDataFrame(links, "device string, childdevice string").withColumn("depth", F.lit("x"))
    pairs = closure.descendants(frame)
    want = brute_descendants(links)
    assert {tuple(row) for row in pairs.collect()} == want and pairs.count() == len(want)
    above = {(a, b) for a, b, _ in want}
    rings = {(a, b) for a, b in links if a and b and (a == b or (b, a) in above)}
    assert {tuple(row) for row in closure.in_cycles(frame, pairs).collect()} == rings
    assert closure.descendants(frame.limit(0)).collect() == []
    maybe = closure.ring_candidates(frame)
    assert {tuple(row) for row in closure.in_cycles(frame, closure.descendants(maybe)).collect()} == rings
    assert closure.ring_candidates(frame.where("device like 'c%'")).count() < 21
    assert closure.ring_candidates(frame.limit(0)).collect() == []


def test_descendants_keep_no_shuffles_and_store_pairs_once(spark, monkeypatch):
    monkeypatch.setattr(closure, "SLICE_LINKS", 20)
    links = [(f"t{i // 2}", f"t{i}") for i in range(1, 64)] + [(f"r{i}", f"r{(i + 1) % 7}") for i in range(7)]
    frame = spark.createDataFrame(links, "device string, childdevice string").repartition(3)

    def shuffles():
        local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        found = [file.rsplit("/", 1)[-1].split("_") for file in local.getAllFiles().mkString(" ").split()]
        return {parts[1] for parts in found if parts[0] == "shuffle"}

    before = shuffles()
    pairs = closure.descendants(frame)
    assert len(shuffles() - before) < 12  # of counts, which carry no rows; the joins and groups make over sixty
    want = brute_descendants(links)
    assert {tuple(row) for row in pairs.collect()} == want and pairs.count() == len(want)
    (folder,) = {file.split("/pairs/")[0] for file in pairs.inputFiles()}
    assert names(spark, folder) == ["pairs"]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_descendants_of_layers_above_trees_are_not_stored(spark, monkeypatch):
    rng = random.Random(5)
    tree = [(f"p{i // 2}", f"p{i}") for i in range(127)]
    orders = [(f"o{i}", f"p{rng.randrange(127)}") for i in range(200) for _ in range(3)]
    near = [("h", f"o{i}") for i in range(200)] + [("o1", "z"), ("o2", "p1"), ("o2", "p0"), ("o3", "q")]
    far = [(f"u{i}", f"v{i}") for i in range(30)] + [(f"v{i}", f"p{rng.randrange(30)}") for i in range(30)]
    far += [(f"u{i}", f"p{rng.randrange(15)}") for i in range(30)]
    links = tree + orders + near + far
    meets = [("p3", "p9"), ("p20", "r0"), ("o1", "o2"), ("o4", "r1"), ("o4", "r3")]
    meets += [(f"r{i}", f"r{(i + 1) % 5}") for i in range(5)]

    def stored_share(links):
        frame = spark.createDataFrame(links, "device string, childdevice string").repartition(3)
        pairs = closure.descendants(frame)
        want = brute_descendants(links)
        assert {tuple(row) for row in pairs.collect()} == want and pairs.count() == len(want)
        folder = next(file.split("/entries/")[0] for file in pairs.inputFiles() if "/entries/" in file)
        kept = {"crowds", "entries", "grouped", "labels", "layer-0", "layer-1", "met", "pairs"}
        assert set(names(spark, folder)) <= kept
        stored = [spark.read.parquet(f"{folder}/{name}").count() for name in ("pairs", "grouped")]
        return sum(stored) / len(want)

    assert stored_share(links) < 0.6  # before, every pair was stored and grouped
    monkeypatch.setattr(closure, "MOST_ENTRIES", 3)
    monkeypatch.setattr(closure, "LARGE", 9)
    monkeypatch.setattr(closure, "TASK_PAIRS", 1000)
    monkeypatch.setattr(closure, "SLICE_PAIRS", 6000)
    stored_share(links + meets)


def test_fields_of_columns_that_are_not_read_are_skipped(spark, messages):
    child = {"childDevice": "c", "addTime": "2024-01-01T00:00:00Z", "dataSource": "x"}
    odd = messages(
        {"device": "d", "receiveTime": "soon", "children": [child, None, {"addTime": 7}, {"childDevice": 5}]},
        {"device": {"a": 1}, "children": [child]},
        {"device": "e", "children": []},
        {"device": "f", "children": "none"},
        {"device": "g"},
        '{"device": "h", "children": [{"childDevice": "c"',
        "no json",
        None,
    )
    every = feeds.topology(odd)
    some = feeds.topology(odd, only=("device", "childdevice"))
    assert some.columns == ["device", "childdevice"]
    assert tuples(some) == tuples(every.select("device", "childdevice")) and some.count() > 4
    assert "receiveTime" in optimized(every) and "receiveTime" not in optimized(some)
    stat = feeds.topology(odd, only=("addtime",), meta=True)
    assert tuples(stat) == tuples(feeds.topology(odd, meta=True).select(stat.columns))


# --- intervals

READINGS = "device string, time timestamp, id int"
HELD = "device string, point string, since timestamp, until timestamp"


@pytest.mark.parametrize("salts,wider", [(1, 16), (5, 2)])
def test_at_time_is_the_plain_comparison(spark, salts, wider):
    rng = random.Random(7)
    device = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    readings = [(device(), rng.choice([None, *[at(rng.randrange(50_000)) for _ in range(9)]]), i) for i in range(400)]
    readings += [("a", at(600), -1), ("a", at(660), -2), ("a", at(600), -1)]
    held = [("a", "edge", at(600), at(660)), ("a", "none", at(660), at(660)), ("a", "back", at(700), at(1)), ("b", "ever", None, None)]
    for i in range(80):
        since, length = rng.randrange(-90_000, 60_000), rng.choice([1, 59, 60, 61, 1_000, 20_000, 200_000])
        held.append((device(), f"p{i}", rng.choice([None, at(since)]), rng.choice([None, at(since + length)])))
    found = intervals.at_time(
        spark.createDataFrame(readings, READINGS), spark.createDataFrame(held, HELD), "device", "time", "since", "until",
        wider=wider, salts=salts,
    )
    want = Counter(
        (d, time, i, point, since, until)
        for d, time, i in readings
        for d2, point, since, until in held
        if d is not None and d == d2 and time is not None and (since is None or since <= time) and (until is None or time < until)
    )
    assert Counter(tuple(row) for row in found.select("device", "time", "id", "point", "since", "until").collect()) == want
    assert ("a", at(600), -1, "edge", at(600), at(660)) in want and len(want) > 500


def test_at_time_is_an_equi_join_with_few_bins(spark):
    readings = spark.createDataFrame([("a", at(i), i) for i in range(0, 500_000, 9_000)], READINGS)
    held = spark.createDataFrame([("a", "p", None, None), ("a", "q", at(5), at(400_000)), ("a", "r", at(7), at(9))], HELD)
    found = intervals.at_time(readings, held, "device", "time", "since", "until")
    assert "_bin" in optimized(found)
    assert "NestedLoop" not in executed(found) and "Cartesian" not in executed(found)
    with pytest.raises(ValueError, match="both sides have"):
        intervals.at_time(readings, held.withColumn("id", F.lit(1)), "device", "time", "since", "until")
    none = intervals.at_time(readings.limit(0), held, "device", "time", "since", "until")
    assert none.collect() == [] and none.columns == found.columns
    assert intervals.at_time(readings, held.limit(0), "device", "time", "since", "until").collect() == []


# --- event time

MESSAGES = "device string, kind string, time timestamp, n int"


def batches(own, path, parts):
    """A stream that takes each list of rows as one batch."""
    for rows in parts:
        own.createDataFrame(rows, MESSAGES).coalesce(1).write.mode("append").parquet(path)
    return own.readStream.schema(MESSAGES).option("maxFilesPerTrigger", 1).parquet(path)


def run_to_end(own, job, folder):
    running = start(own, [job], folder, trigger={"availableNow": True})
    try:
        running[0].awaitTermination()
        return windows.progress(running)
    finally:
        stop(running)


def test_windows_are_written_once_late_rows_are_counted_and_state_falls(spark, scratch):
    own = stateful_session(spark, 2, idle_batches=True)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "true")
    parts = [
        [("a", k, at(60 * h + m), m) for h in range(12) for m in (1, 30, 59) for k in "xy"] + [("a", "x", None, 0)],
        [("a", "x", at(60 * 12), 5), ("a", "x", at(60 * 11 + 2), 7)],  # within the lateness
        [("a", "y", at(60 * 40), 1)],
        [("a", "x", at(3), 1), ("a", "x", at(60 * 40), 2)],  # far too late: counted, not written
        [("a", "x", at(60 * 100), 1)],
    ]
    rows = batches(own, f"{scratch}/in", parts)
    counted = windows.window_counts(rows, "time", ["kind"], lateness="2 hours", sums=["n"])
    seen = run_to_end(own, Job("w", counted, sink=files_sink(f"{scratch}/out", gather=False)), f"{scratch}/ck")
    on_time = own.createDataFrame([row for part in parts for row in part if row[2] is not None and row != ("a", "x", at(3), 1) or row[3] == 0], MESSAGES)
    want = windows.window_counts(on_time.where(F.col("time") < at(60 * 98)), "time", ["kind"], sums=["n"])
    got = spark.read.parquet(f"{scratch}/out").select(*want.columns)
    assert tuples(got) == tuples(want)
    assert sum(row["dropped_late"] for row in seen) == 1
    held = [row["rows_in_state"] for row in seen]
    assert max(held) > 20 and held[-1] == 1


def test_redeliveries_over_batches(spark, scratch):
    own = stateful_session(spark, 2)
    rows = [("a" if i % 3 else None, "k", at(60 * i), i) for i in range(30)]
    parts = [rows[:10] + rows[:4], rows[5:20], rows[10:], rows[20:]]
    source = batches(own, f"{scratch}/in", parts)
    passed = windows.without_redeliveries(source, ["device", "kind", "n"], "time", within="1 day")
    run_to_end(own, Job("d", passed, sink=files_sink(f"{scratch}/out", gather=False)), f"{scratch}/ck")
    assert tuples(spark.read.parquet(f"{scratch}/out").select("device", "kind", "time", "n")) == sorted(rows, key=repr)


def test_silence_is_that_of_the_whole(spark, scratch):
    own = stateful_session(spark, 2, idle_batches=True)
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.choice(["x", "y", None]), at(rng.randrange(3_000)), 0) for _ in range(150)]
    rows += [("d", "x", at(0), 0), ("d", "x", at(60), 0), ("d", "y", at(121), 0), (None, "x", at(1), 0), ("e", "x", None, 0)]
    rows.sort(key=lambda r: (r[2] or NOON))
    parts = [rows[i : i + 30] for i in range(0, len(rows), 30)]
    for part in parts:  # out of order within the lateness
        rng.shuffle(part)
    for a, b in zip(parts, parts[1:]):
        a[0], b[0] = b[0], a[0]
    parts.append([("beat", "z", at(100_000), 0)])
    source = batches(own, f"{scratch}/in", parts)
    alarms = silence.silence_alarms(source, "device", "time", "kind", after_seconds=3600, lateness="2 days")
    run_to_end(own, Job("s", alarms, sink=files_sink(f"{scratch}/out", gather=False)), f"{scratch}/ck")
    want, own_times = [], defaultdict(dict)
    for device, kind, time, _ in rows:
        if device and time:
            known = own_times[device].get(time)
            own_times[device][time] = max(filter(None, (known, kind)), default=None)
    for device, times in own_times.items():
        order = sorted(times)
        for one, after in zip(order, [*order[1:], None]):
            if after is None or after > one + datetime.timedelta(hours=1):
                want.append((device, one, one + datetime.timedelta(hours=1), times[one]))
    assert ("d", at(0), at(60), "x") not in want and ("d", at(60), at(120), "x") in want
    got = spark.read.parquet(f"{scratch}/out").where("device <> 'beat'")
    assert tuples(got.select("device", "last_seen", "alarm_time", "last_value")) == sorted(want, key=repr)


def test_silence_calls_no_python_per_message(spark):
    rows = spark.createDataFrame([("a", at(0), "x"), ("a", at(60), None), ("a", at(121), "y")], "device string, time timestamp, kind string")
    alarms = silence.silence_alarms(rows, "device", "time", "kind", after_seconds=3600, lateness="1 day")
    assert "InPandas" not in alarms._jdf.queryExecution().analyzed().toString()
    assert tuples(alarms) == [("a", at(60), at(120), None), ("a", at(121), at(181), "y")]


def test_a_replayed_batch_is_audited_once(spark, scratch):
    log = audit_log.AuditLog(spark, f"{scratch}/audit", ["counts"])
    assert log.read(spark).count() == 0

    def progress(batch, rows, seen=5):
        counts = SimpleNamespace(asDict=lambda: {"rows": rows, "errors": 0, "good": rows})
        return SimpleNamespace(
            name="q", id="i", runId="r", batchId=batch, numInputRows=seen, observedMetrics={"counts": counts, "other": counts}
        )

    for batch, rows, seen in ((0, 5, 5), (1, 7, 5), (1, 7, 5), (2, 0, 0)):
        log.onQueryProgress(SimpleNamespace(progress=progress(batch, rows, seen)))
    assert tuples(log.read(spark).select("batch_id", "rows")) == [(0, 5), (1, 7)]


def test_a_timed_topic_leaves_nothing_out(spark, scratch, messages):
    days = [None, -9_000, -1, 0, 1, 7, 8, 40, 3_000]
    frame = messages(*[{"n": i} for i in range(len(days))])
    when = F.element_at(F.array(*[F.lit(d).cast("int") for d in days]), (F.col("offset") + 1).cast("int"))
    frame = frame.withColumn("timestamp", F.timestamp_seconds(when * 86_400 + 1_704_067_200))
    topic = timed_topic(spark, frame, f"{scratch}/topic")
    order = []

    def keep(batch, batch_id):
        order.append(sorted(row.offset for row in batch.collect()))

    run_available(spark, [Job("t", topic, sink=keep)], f"{scratch}/ck")
    assert sorted(n for part in order for n in part) == list(range(len(days)))
    assert SLICE_DAYS == 8


def test_a_large_slice_of_a_timed_topic_is_more_files(spark, scratch, messages, monkeypatch):
    monkeypatch.setattr(stream_plans, "FILE_BYTES", 4_000)
    monkeypatch.setattr(stream_plans, "ROW_GROUP_BYTES", 2_000)
    frame = messages(*[{"n": f"{random.Random(i).random()}" * 20} for i in range(2_000)])
    frame = frame.withColumn("timestamp", F.timestamp_seconds(F.lit(1_704_067_200)))
    timed_topic(spark, frame, f"{scratch}/topic")
    files = [f"{scratch}/topic/{name}" for name in names(spark, f"{scratch}/topic") if name.startswith("part-")]
    assert len(files) > 8 and max(size(spark, file) for file in files) < 20_000
    assert spark.read.parquet(*files).select("offset").distinct().count() == spark.read.parquet(*files).count() == 2_000


def test_tasks_share_a_file_of_a_timed_topic(spark, scratch, messages, monkeypatch):
    monkeypatch.setattr(stream_plans, "ROW_GROUP_BYTES", 20_000)
    frame = messages(*[{"n": f"{random.Random(i).random()}" * 20} for i in range(2_000)])
    timed_topic(spark, frame.withColumn("timestamp", F.timestamp_seconds(F.lit(1_704_067_200))), f"{scratch}/topic")
    files = [file for file in names(spark, f"{scratch}/topic") if file.startswith("part-")]
    assert len(files) == stream_plans.FILES_PER_BATCH
    assert all(parquet.ParquetFile(f"{scratch}/topic/{file}").num_row_groups > 2 for file in files)


def test_a_source_is_dealt_out_by_its_size(spark, scratch, monkeypatch):
    monkeypatch.setattr(wire, "SOURCE_BYTES", 200)
    spark.range(5_000).select(F.col("id").alias("event_id")).write.parquet(f"{scratch}/events.parquet")
    dealt = wire.source(spark, scratch, "events")
    assert dealt.rdd.getNumPartitions() > 20 and dealt.count() == 5_000
