from __future__ import annotations

import random
import tempfile
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF, executed, tuples
from wattline import contracts as C
from wattline import feeds
from wattline.__main__ import arguments, main, sink_maker
from wattline.operators import joins, keyed
from wattline.plans.stream_plans import bounded_join
from wattline.sources import message_files
from wattline.streaming import storage, upsert
from wattline.streaming.jobs import device_telemetry_job, feed_jobs, keyed_sink
from wattline.streaming.runner import Job, console, plan, run_available, run_until_stopped, start, stop
from wattline.streaming.sinks import external_sink, files_sink, guarded, outcome_sink, split_sink
from wattline.streaming.upsert import KeyedTable, LatestLog

# --- storage


def session_with(folder, master):
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": folder}.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_comes_from_the_session():
    cluster = session_with("hdfs://n/shared/", "yarn")
    assert storage.shared_dir(cluster) == "hdfs://n/shared"
    assert storage.run_dir(cluster, "x").startswith("hdfs://n/shared/wattline/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(session_with(None, "yarn"))
    assert storage.shared_dir(session_with(None, "local[2]")).startswith(f"{tempfile.gettempdir()}/wattline-")


# --- sinks


def ticks(spark, path, parts=4, rows=40):
    """A stream of ``parts`` micro-batches over numbered rows."""
    spark.range(0, rows, 1, parts).write.parquet(path)
    return lambda: spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(path)


def test_replayed_batches_are_written_once(spark, scratch):
    sink = files_sink(f"{scratch}/out", partition_by=["d"])
    batch = spark.range(10).withColumn("d", F.col("id") % 3)
    for _ in range(3):
        sink(batch, 0)
    sink(batch, 1)
    assert spark.read.parquet(f"{scratch}/out").count() == 20


def test_a_failing_sink_stops_the_query_and_the_restart_replays(spark, scratch):
    source = ticks(spark, f"{scratch}/in")
    write = files_sink(f"{scratch}/out")
    seen = []

    def flaky(batch, batch_id):
        write(batch, batch_id)
        seen.append(batch_id)
        if seen == [0, 1]:
            raise RuntimeError("down")

    with pytest.raises(Exception, match="down"):
        run_available(spark, [Job("flaky", source(), sink=guarded(flaky))], f"{scratch}/ck")
    run_available(spark, [Job("flaky", source(), sink=guarded(flaky))], f"{scratch}/ck")
    assert seen == [0, 1, 1, 2, 3]
    assert sorted(row.id for row in spark.read.parquet(f"{scratch}/out").collect()) == list(range(40))


def test_retries_and_kept_batches(spark, scratch):
    calls = []

    def broken(batch, batch_id):
        calls.append(batch_id)
        raise RuntimeError("down")

    with pytest.raises(RuntimeError):
        guarded(broken, attempts=3, pause_seconds=0)(spark.range(3), 0)
    assert calls == [0, 0, 0]
    source = ticks(spark, f"{scratch}/in")
    sink = guarded(broken, dead_letters=f"{scratch}/dead")
    run_available(spark, [Job("broken", source(), sink=sink)], f"{scratch}/ck")
    kept = spark.read.parquet(f"{scratch}/dead")
    assert sorted(row.id for row in kept.collect()) == list(range(40))
    assert kept.select("batch_id").distinct().count() == 4


def test_a_swallowed_failure_loses_the_batch(spark, scratch):
    """Why sinks here raise: a callback that returns normally commits its batch."""
    source = ticks(spark, f"{scratch}/in")
    write = files_sink(f"{scratch}/out")

    def swallowing(batch, batch_id):
        if batch_id != 1:
            write(batch, batch_id)

    for _ in range(2):
        run_available(spark, [Job("s", source(), sink=swallowing)], f"{scratch}/ck")
    assert spark.read.parquet(f"{scratch}/out").count() == 30


def test_external_sink_checks_the_contract_and_passes_options(spark, scratch):
    rows = spark.createDataFrame([("a", None, 1)], "device string, lastreceivetime timestamp, _offset int")
    sink = external_sink("parquet", C.TELEMETRY.table, options={"path": f"{scratch}/t", "table": "telemetry"})
    sink(rows, 0)
    sink(rows, 1)
    stored = spark.read.parquet(f"{scratch}/t")
    assert stored.columns == ["device", "lastreceivetime"] and stored.count() == 2
    with pytest.raises(ValueError, match="key columns missing"):
        sink(rows.withColumnRenamed("lastreceivetime", "lasttelemetry"), 2)


def test_command_line_sinks(spark, scratch):
    rows = spark.createDataFrame([("2024-01-01", "a")], "current_date string, device string")
    rows = rows.withColumn("current_date", F.col("current_date").cast("date")).withColumn("receivetime", F.now())
    base = ["--servers", "h:1", "--checkpoints", "c"]
    sink_maker(arguments([*base, "--out", scratch]))(C.EVENT)(rows, 0)
    assert storage.exists(spark, f"{scratch}/events/query_id=none/batch_id=0/current_date=2024-01-01")
    external = ["--format", "parquet", "--option", f"path={scratch}/x", "--null-option", "skipNulls"]
    sink_maker(arguments([*base, *external]))(C.EVENT)(rows, 0)
    assert spark.read.parquet(f"{scratch}/x").count() == 1


# --- runner


def test_plan_refuses_what_loses_rows(spark):
    rows = spark.range(1)
    sink = files_sink("x")
    with pytest.raises(ValueError, match="share a name"):
        plan([Job("a", rows, sink=sink, checkpoint="1"), Job("a", rows, sink=sink, checkpoint="2")], None)
    with pytest.raises(ValueError, match="share a checkpoint"):
        plan([Job("a", rows, sink=sink, checkpoint="1"), Job("b", rows, sink=sink, checkpoint="1/")], None)
    with pytest.raises(ValueError, match="needs a checkpoint"):
        plan([Job("a", rows, sink=sink)], None)
    with pytest.raises(ValueError, match="a sink or a format"):
        plan([Job("a", rows)], "ck")
    with pytest.raises(ValueError, match="share an output"):
        plan([Job("a", rows, sink=guarded(sink)), Job("b", rows, sink=outcome_sink("x/"))], "ck")
    planned = plan([Job("a", rows, sink=sink), console("b", rows), Job("c", rows, format="parquet")], "ck/")
    assert [folder for _, folder in planned] == ["ck/a", None, "ck/c"]


def test_all_or_nothing_start(spark, scratch):
    source = ticks(spark, f"{scratch}/in")
    good = Job("good", source(), sink=files_sink(f"{scratch}/out"))
    bad = Job("bad", spark.range(1), sink=files_sink(f"{scratch}/out2"))  # not a stream
    with pytest.raises(Exception):
        start(spark, [good, bad], f"{scratch}/ck")
    assert not spark.streams.active


def test_one_failed_query_ends_the_run_and_stops_the_others(spark, scratch):
    source = ticks(spark, f"{scratch}/in")

    def broken(batch, batch_id):
        raise RuntimeError("down")

    jobs = [Job("good", source(), sink=files_sink(f"{scratch}/out")), Job("bad", source(), sink=broken)]
    with pytest.raises(Exception, match="down"):
        run_until_stopped(spark, jobs, f"{scratch}/ck")
    assert not spark.streams.active


def test_other_queries_of_the_session_do_not_end_a_run(spark, scratch):
    import threading
    import time

    source = ticks(spark, f"{scratch}/in")
    other = start(spark, [Job("other", source(), format="noop")])[0]
    failures = []

    def run():
        try:
            run_until_stopped(spark, [Job("mine", source(), sink=files_sink(f"{scratch}/out"))], f"{scratch}/ck")
        except Exception as error:
            failures.append(error)

    running = threading.Thread(target=run)
    running.start()
    while not (mine := [query for query in spark.streams.active if query.name == "mine"]):
        time.sleep(0.1)
    other.stop()
    time.sleep(3)
    assert mine[0].isActive and running.is_alive()
    mine[0].stop()
    running.join(30)
    assert not running.is_alive() and not failures


def test_a_fresh_checkpoint_adds_to_the_log(spark, scratch):
    source = ticks(spark, f"{scratch}/in")
    for checkpoint in ("one", "one", "two"):
        run_available(spark, [Job("log", source(), sink=files_sink(f"{scratch}/out"))], f"{scratch}/{checkpoint}")
    stored = spark.read.parquet(f"{scratch}/out")
    assert stored.count() == 80 and stored.select("query_id").distinct().count() == 2


def test_memory_and_console_outputs(spark, scratch):
    source = ticks(spark, f"{scratch}/in")
    run_available(spark, [Job("seen", source(), format="memory"), console("shown", source().limit(1))])
    assert spark.table("seen").count() == 40


def test_trigger_and_stop(spark, scratch):
    source = ticks(spark, f"{scratch}/in")
    job = Job("t", source(), sink=files_sink(f"{scratch}/out"))
    running = start(spark, [job], f"{scratch}/ck", trigger={"processingTime": "1 second"})
    running[0].processAllAvailable()
    stop(running)
    assert not running[0].isActive and spark.read.parquet(f"{scratch}/out").count() == 40


# --- upsert

COLUMNS = ("d", "k", "v", "s", "at", "seq")
SCHEMA = "d date, k string, v int, s string, at int, seq int"


def change_rows(rng, n=120):
    import datetime as dt

    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(9)}"
        rows.append(
            (
                dt.date(2024, 1, 1 + rng.randrange(4)), key, rng.choice([None, rng.randrange(5)]),
                rng.choice([None, "x", "y"]), rng.randrange(20), i,
            )
        )
    return rows


def keyed_table(scratch, nulls, partition=None, key=("k",)):
    return KeyedTable(
        path=f"{scratch}/table", columns=COLUMNS, key=key, order=("at", "seq"), partition=partition, buckets=3,
        nulls=nulls,
    )


def expected(spark, rows, key, nulls):
    return keyed.latest(spark.createDataFrame(rows, SCHEMA), key, ["at", "seq"], nulls)


@pytest.mark.parametrize("nulls", [C.KEEP, C.OVERWRITE])
@pytest.mark.parametrize("partition, key", [("d", ("d", "k")), (None, ("k",))])
@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), cuts=st.lists(st.integers(0, 120), max_size=3))
def test_merging_any_split_equals_the_whole(spark, nulls, partition, key, seed, cuts):
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rng = random.Random(seed)
    rows = change_rows(rng)
    table = keyed_table(scratch, nulls, partition, key)
    edges = [0, *sorted(cuts), len(rows)]
    for batch_id, (low, high) in enumerate(zip(edges, edges[1:])):
        table.merge(spark.createDataFrame(rows[low:high], SCHEMA), batch_id)
    columns = ["k", "v", "s", "d"] if nulls == C.KEEP else list(COLUMNS)
    assert tuples(table.read(spark).select(columns)) == tuples(expected(spark, rows, key, nulls).select(columns))


@pytest.mark.parametrize("nulls", [C.KEEP, C.OVERWRITE])
def test_merging_a_batch_again_changes_nothing(spark, scratch, nulls):
    rows = change_rows(random.Random(1))
    table = keyed_table(scratch, nulls)
    first, second = spark.createDataFrame(rows[:60], SCHEMA), spark.createDataFrame(rows[60:], SCHEMA)
    table.merge(first, 0)
    table.merge(second, 1)
    once = tuples(table.read(spark))
    table.merge(second, 1)
    table.merge(first, 0)
    assert tuples(table.read(spark)) == once


def test_a_merge_cut_short_has_not_happened_or_is_finished(spark, scratch, monkeypatch):
    import shutil

    rows = change_rows(random.Random(2))
    table = keyed_table(scratch, C.OVERWRITE, "d", ("d", "k"))
    table.merge(spark.createDataFrame(rows[:60], SCHEMA), 0)
    before = tuples(table.read(spark))

    def cut(*_):
        raise RuntimeError("driver lost")

    second = spark.createDataFrame(rows[60:100], SCHEMA)
    with monkeypatch.context() as patched:
        patched.setattr(upsert, "gathered", cut)
        with pytest.raises(RuntimeError):
            table.merge(second, 1)
    assert tuples(table.read(spark)) == before
    finish = KeyedTable._finish
    calls = []
    with monkeypatch.context() as patched:  # staged, not yet overwritten
        patched.setattr(KeyedTable, "_finish", lambda *given: cut() if calls else calls.append(finish(*given)))
        with pytest.raises(RuntimeError):
            table.merge(second, 1)
    assert tuples(table.read(spark)) == before
    shutil.rmtree(f"{scratch}/table/d=2024-01-02")  # as if lost between the old files' end and the new ones' place
    table.merge(spark.createDataFrame(rows[100:], SCHEMA), 7)
    assert tuples(table.read(spark)) == tuples(expected(spark, rows, ["d", "k"], C.OVERWRITE))
    table.merge(second, 1)
    assert tuples(table.read(spark)) == tuples(expected(spark, rows, ["d", "k"], C.OVERWRITE))
    assert not storage.names(spark, table.staged)


def files_of(path):
    from pathlib import Path

    folders = {}
    for file in Path(path).glob("*=*/*.parquet"):
        folders.setdefault(file.parent.name, set()).add(file.name)
    return folders


def test_a_merge_writes_touched_partitions_only(spark, scratch):
    rows = change_rows(random.Random(3))
    table = keyed_table(scratch, C.OVERWRITE, "d", ("d", "k"))
    table.merge(spark.createDataFrame(rows, SCHEMA), 0)
    first = files_of(table.path)
    late = [(*row[:4], 99, row[5]) for row in rows if row[0].day in (1, 3)]
    table.merge(spark.createDataFrame(late, SCHEMA), 1)
    table.merge(spark.createDataFrame([], SCHEMA), 2)
    now = files_of(table.path)
    assert {name for name in now if now[name] == first[name]} == {"d=2024-01-02", "d=2024-01-04"}
    assert table.read(spark).count() == expected(spark, rows, ["d", "k"], C.OVERWRITE).count()


def test_reads_are_pruned_to_partitions(spark, scratch):
    import datetime as dt

    rows = change_rows(random.Random(4))
    table = keyed_table(scratch, C.OVERWRITE, "d", ("d", "k"))
    table.merge(spark.createDataFrame(rows, SCHEMA), 0)
    days = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    part = table.read(spark, only=days)
    assert {row.d for row in part.collect()} == set(days)
    assert "PartitionFilters: [isnotnull(d" in executed(part)
    filtered = table.read(spark).where(F.col("d") == F.lit(days[0]))
    assert "PartitionFilters: [isnotnull(d" in executed(filtered)


def test_text_partitions_keep_their_values(spark, scratch):
    table = keyed_table(scratch, C.OVERWRITE, "k", ("k",))
    for batch_id, value in enumerate((1, 2)):
        rows = [(None, key, value, "x", value, n) for n, key in enumerate(("007", "", None, "a/b"))]
        table.merge(spark.createDataFrame(rows, SCHEMA), batch_id)
    got = sorted((row.k or "", row.v) for row in table.read(spark).collect())
    assert got == [("", 2), ("007", 2), ("a/b", 2)]  # an empty text has no directory of its own


def test_a_history_batch_writes_its_own_days_only(spark, scratch):
    import datetime as dt

    sink = keyed_sink(C.PARAMETER, f"{scratch}/h", "history")
    columns = C.PARAMETER.table.types

    def batch(day, n):
        time, row = dt.datetime(2024, 1, day, 12), {}
        for name, kind in columns.items():
            row[name] = time if kind == "timestamp" else time.date() if kind == "date" else None
        row |= {"device": f"D{n}", "parameter": "p", "_partition": 0, "_offset": n}
        ddl = ", ".join(f"{name} {kind}" for name, kind in columns.items())
        return spark.createDataFrame([row], f"{ddl}, _partition int, _offset bigint")

    sink(batch(1, 1), 0)
    first = files_of(f"{scratch}/h")
    sink(batch(2, 2), 1)
    sink(batch(2, 3), 2)
    sink(batch(2, 3), 2)
    now = files_of(f"{scratch}/h")
    assert set(now) == {"_day=2024-01-01", "_day=2024-01-02"} and now["_day=2024-01-01"] == first["_day=2024-01-01"]
    assert spark.read.parquet(f"{scratch}/h").count() == 3


def test_null_dates_and_a_key_under_two_dates(spark, scratch):
    table = keyed_table(scratch, C.OVERWRITE, "d", ("d", "k"))
    rows = [(None, "a", 1, "x", 1, 1), (None, "a", 2, "x", 2, 2)]
    for batch_id, row in enumerate(rows):
        table.merge(spark.createDataFrame([row], SCHEMA), batch_id)
    assert [(row.d, row.v) for row in table.read(spark).collect()] == [(None, 2)]
    with pytest.raises(ValueError, match="several values of d"):
        keyed_table(scratch, C.OVERWRITE, "d", ("k",))
    with pytest.raises(ValueError, match="several days of at"):
        KeyedTable(f"{scratch}/t", COLUMNS, ("k",), ("seq",), day_of="at")
    with pytest.raises(ValueError, match="nothing is stored"):
        keyed_table(f"{scratch}/new", C.OVERWRITE).read(spark)


@pytest.mark.parametrize("nulls", [C.KEEP, C.OVERWRITE])
def test_a_compacted_log_reads_like_the_whole(spark, scratch, nulls):
    rows = change_rows(random.Random(6))
    log = LatestLog(f"{scratch}/log", keyed_table(scratch, nulls))
    columns = ["k", "v", "s", "d"] if nulls == C.KEEP else list(COLUMNS)
    for batch_id, low in enumerate(range(0, 120, 20)):
        log.append(spark.createDataFrame(rows[low : low + 20], SCHEMA), batch_id)
        if batch_id == 2:
            assert log.compact(spark) == 3 and log.compact(spark) == 0
        want = expected(spark, rows[: low + 20], ["k"], nulls)
        assert tuples(log.read(spark).select(columns)) == tuples(want.select(columns))
    assert log.compact(spark) == 3
    assert tuples(log.read(spark).select(columns)) == tuples(expected(spark, rows, ["k"], nulls).select(columns))


# --- joins and standing jobs


def test_stream_joins_equal_the_batch_join(spark, scratch, messages):
    time = "2024-01-0{}T00:00:00Z"
    devices = messages(*[{"persistTime": time.format(1), "current": {"device": d}} for d in "abc"], {"current": {}})
    readings = messages(*[{"device": d, "lastReceiveTime": time.format(n)} for d in "abx" for n in (1, 2, 5)], "{}")
    devices.write.parquet(f"{scratch}/devices")
    readings.write.parquet(f"{scratch}/readings")

    def stored(within, name):
        job = device_telemetry_job(
            message_files(spark, f"{scratch}/devices", stream=True),
            message_files(spark, f"{scratch}/readings", stream=True),
            files_sink(f"{scratch}/{name}"),
            within=within,
            salts=2,
        )
        run_available(spark, [job], f"{scratch}/ck-{name}")
        return tuples(spark.read.parquet(f"{scratch}/{name}").select("device", "last_telemetry"))

    batch = joins.join_versions(feeds.device_for_join(devices), feeds.telemetry_for_join(readings), "device")
    assert stored(None, "all") == tuples(batch.select("device", "last_telemetry"))
    assert len(stored("2 days", "near")) == 4


def test_join_state_falls_between_batches(spark, scratch):
    rows = bounded_join(spark, SF, scratch)
    query = start(rows.sparkSession, [Job("j", rows, sink=files_sink(f"{scratch}/rows"))], f"{scratch}/ck")[0]
    query.processAllAvailable()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    stop([query])
    assert len(progress) >= 3
    assert sum(p["stateOperators"][0]["numRowsRemoved"] for p in progress) > 0
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 0


def test_unbounded_outer_stream_join_is_refused(spark, scratch, messages):
    messages({"device": "a"}).write.parquet(f"{scratch}/m")
    stream = feeds.telemetry(message_files(spark, f"{scratch}/m", stream=True))
    outer = stream.join(stream.withColumnRenamed("lastreceivetime", "t"), "device", "left")
    with pytest.raises(Exception, match="watermark"):
        start(spark, [Job("outer", outer, format="memory")])


def test_standing_jobs_write_tables_and_dead_letters(spark, scratch, messages):
    time = "2024-01-01T00:00:00Z"
    events = messages({"device": "a", "event": "1", "receiveTime": time, "persistTime": time}, "{bad")
    telemetry = messages({"device": "a", "lastReceiveTime": time}, {"device": "a"})
    events.write.parquet(f"{scratch}/events")
    telemetry.write.parquet(f"{scratch}/telemetry")
    sources = {
        "device-event": message_files(spark, f"{scratch}/events", stream=True),
        "device-telemetry": message_files(spark, f"{scratch}/telemetry", stream=True),
    }

    def sink_for(which):
        return files_sink(f"{scratch}/out/{which.table.name}")

    jobs = feed_jobs(sources, sink_for, dead_letters=f"{scratch}/dead")
    assert [job.name for job in jobs] == ["event", "telemetry"]
    run_available(spark, jobs, f"{scratch}/ck")
    assert spark.read.parquet(f"{scratch}/out/events").count() == 1
    assert spark.read.parquet(f"{scratch}/out/telemetry").count() == 1
    logs = [spark.read.parquet(f"{scratch}/dead/{name}") for name in ("event", "telemetry")]
    dead = {row["_error"] for log in logs for row in log.collect()}
    assert dead == {"not one JSON object", "missing lastReceiveTime"}
    progress = start(spark, feed_jobs(sources, sink_for, dead_letters=f"{scratch}/dead2"), f"{scratch}/ck2")
    for query in progress:
        query.processAllAvailable()
    counts = {q.name: q.recentProgress[0]["observedMetrics"][q.name].asDict() for q in progress}
    stop(progress)
    assert counts == {name: {"rows": 2, "errors": 1, "good": 1} for name in ("event", "telemetry")}
    with pytest.raises(ValueError, match="dead-letter folder"):
        feed_jobs(sources, sink_for, keep_failed_batches=True)


def test_outcome_sink_writes_both_in_one_pass(spark, scratch):
    rows = spark.range(10).withColumn("_error", F.when(F.col("id") < 3, "bad"))
    outcome_sink(f"{scratch}/rows")(rows, 0)
    stored = spark.read.parquet(f"{scratch}/rows")
    assert {row.outcome: row["count"] for row in stored.groupBy("outcome").count().collect()} == {"good": 7, "bad": 3}


def test_split_sink_evaluates_a_batch_once(spark, scratch):
    counted = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            counted.add(len(part))
            yield part

    rows = spark.range(10).mapInPandas(count, "id bigint")
    rows = rows.withColumn("_error", F.when(F.col("id") < 3, "bad")).withColumn("_payload", F.lit("x"))
    split_sink(files_sink(f"{scratch}/good"), files_sink(f"{scratch}/bad"))(rows, 0)
    assert counted.value == 10
    assert spark.read.parquet(f"{scratch}/bad").count() == 3


def test_command_line_runs_feeds_and_join_on_file_topics(spark, scratch, messages):
    time = "2024-01-0{}T00:00:00Z"
    events = [{"device": "a", "event": str(n % 2), "receiveTime": time.format(n), "persistTime": time.format(n),
               "firstOccurrenceTime": time.format(1), "state": "open" if n == 1 else None} for n in (1, 2, 3)]
    points = [{"register": r, "value": v, "measureTime": time.format(1)} for r, v in (("x", "1"), ("y", 2))]
    reading = {"device": "a", "receiveTime": time.format(1), "persistTime": time.format(1), "dataPoints": points,
               "profile": "p"}
    topics = {
        C.EVENT: [*events, "{bad"], C.MEASUREMENT: [reading],
        C.DEVICE: [{"persistTime": time.format(1), "current": {"device": d}} for d in "ab"],
        C.TELEMETRY: [{"device": "a", "lastReceiveTime": time.format(n)} for n in (1, 2)],
    }
    for which, payloads in topics.items():
        messages(*payloads, topic=which.topic).write.parquet(f"{scratch}/topics/{which.topic}")
    base = ["--files", f"{scratch}/topics", "--available-now"]
    two = ["--feed", "device-event", "--feed", "device-measurement"]
    for by in ("table", "state", "history"):
        folders = ["--checkpoints", f"{scratch}/ck-{by}", "--out", f"{scratch}/{by}", "--dead-letters", f"{scratch}/d-{by}"]
        main([*base, *two, *folders, "--keyed", by, "--pools"])
    event = KeyedTable(f"{scratch}/table/events", tuple(C.EVENT.table.columns), C.EVENT.table.key,
                       ("persisttime", "_partition", "_offset"), partition="current_date")
    assert event.read(spark).count() == 3
    log = spark.read.parquet(f"{scratch}/state/events/log")
    assert log.count() == 3 and spark.read.parquet(f"{scratch}/d-state/event").count() == 1
    points = spark.read.parquet(f"{scratch}/history/measurement_points")
    assert sorted((row.register, row.value) for row in points.collect()) == [("x", 1.0), ("y", 2.0)]
    main([*base, *two, "--checkpoints", f"{scratch}/ck-o", "--out", f"{scratch}/o", "--outcomes"])
    outcomes = spark.read.parquet(f"{scratch}/o/events").groupBy("outcome").count().collect()
    assert {row.outcome: row["count"] for row in outcomes} == {"good": 3, "bad": 1}
    join = ["--join", "device-telemetry", "--state-partitions", "2", "--salts", "2"]
    main([*base, *join, "--checkpoints", f"{scratch}/ck-j", "--out", f"{scratch}/j"])
    assert spark.read.parquet(f"{scratch}/j/device_telemetry").count() == 2
    with pytest.raises(SystemExit):
        arguments([*base, "--checkpoints", "c", "--out", "o", "--join", "device-telemetry"])
    with pytest.raises(SystemExit):
        arguments([*base, "--checkpoints", "c", "--out", "o", "--keyed", "state"])
