"""Streaming queries: each processes what its source holds and returns what its sink then stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import contracts as C
from wattline import feeds
from wattline.operators import joins, keyed
from wattline.operators.conform import conform
from wattline.plans import wire
from wattline.plans.feed_plans import EVENT_ROWS, PARAMETER_ROWS
from wattline.plans.join_plans import DEVICE_SIDE, JOINED, TELEMETRY_SIDE, VERSIONS
from wattline.plans.registry import query
from wattline.sources import message_files
from wattline.streaming.runner import Job, run_available, stateful_session
from wattline.streaming.sinks import external_sink, files_sink, gathered, guarded, outcome_sink
from wattline.streaming.storage import row_group_options, run_dir, size
from wattline.streaming.upsert import KeyedTable, LatestLog

_ARRIVAL = ("persisttime", "_partition", "_offset")
_EVENTS_WITH_ID = EVENT_ROWS.replace("from events", ", event_id from events")

#: The topics that queries write for themselves have so many partitions; a file holds at most so many messages, and a
#: micro-batch reads so many files. At any size a batch is bounded, and even a small topic takes several batches.
TOPIC_PARTITIONS = 16
FILE_MESSAGES = 1_000_000
FILES_PER_BATCH = 4
#: A slice of a timed topic has a file per so many stored bytes, and row groups that several tasks can share a file by.
FILE_BYTES = 64 << 20
ROW_GROUP_BYTES = 4 << 20
#: Days of a slice of a topic in the order of time.
SLICE_DAYS = 8
#: Partitions of state, which the checkpoint keeps: one for each core of a cluster of 3 executors of 4.
STATE_PARTITIONS = 12


def _topic(spark: SparkSession, messages: DataFrame, path: str) -> DataFrame:
    """The messages as a file topic, read back as a stream in bounded micro-batches."""
    dealt = messages.repartition(TOPIC_PARTITIONS, F.xxhash64("topic", "offset"))
    dealt.write.option("maxRecordsPerFile", FILE_MESSAGES).parquet(path)
    return message_files(spark, path, stream=True, max_files_per_trigger=FILES_PER_BATCH)


def timed_topic(spark: SparkSession, messages: DataFrame, path: str, last: Sequence[DataFrame] = ()) -> DataFrame:
    """A file topic whose files come in the order of their messages' time, in slices of ``SLICE_DAYS``.

    Slices follow from the messages' own times, so none is wider and none is left out; messages without a time come
    first. A slice has ``FILES_PER_BATCH`` files, or more if it is large, so that no task writes or reads much of it.
    ``last`` are messages that come after all others, each frame as a batch of its own.
    """
    number = F.floor(F.datediff("timestamp", F.lit("1970-01-01").cast("date")) / SLICE_DAYS)
    staged = messages.withColumn("_slice", F.coalesce(number, F.lit(-(2**31)).cast("bigint")))
    gathered(staged, ["_slice"]).write.partitionBy("_slice").parquet(f"{path}-staged")
    slices = spark.read.parquet(f"{path}-staged")
    for row in slices.select("_slice").distinct().orderBy("_slice").collect():
        files = max(FILES_PER_BATCH, -(-size(spark, f"{path}-staged/_slice={row[0]}") // FILE_BYTES))
        part = slices.where(F.col("_slice") == row[0]).drop("_slice").repartition(files, F.xxhash64("offset"))
        writer = part.write.mode("append").options(**row_group_options(ROW_GROUP_BYTES))
        writer.option("maxRecordsPerFile", FILE_MESSAGES).parquet(path)
    for part in last:
        part.coalesce(1).write.mode("append").parquet(path)
    return message_files(spark, path, stream=True, max_files_per_trigger=FILES_PER_BATCH)


@query("stream_append_events", EVENT_ROWS)
def stream_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from their stream into a date-partitioned append log."""
    run = run_dir(spark, "append-events")
    rows = feeds.events(_topic(spark, wire.event_messages(spark, sf_dir), f"{run}/topic"))
    job = Job("event", rows, sink=files_sink(f"{run}/events", partition_by=["current_date"]))
    run_available(spark, [job], f"{run}/checkpoints")
    return spark.read.parquet(f"{run}/events").select(*C.EVENT.table.columns)


@query(
    "upsert_stream_by_day",
    f"""select * exclude (event_id) from ({_EVENTS_WITH_ID}) qualify row_number() over
        (partition by "current_date", device order by persisttime desc, event_id desc) = 1""",
)
def upsert_stream_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each device and day, merged from several micro-batches."""
    run = run_dir(spark, "upsert-by-day")
    source = _topic(spark, wire.event_messages(spark, sf_dir), f"{run}/topic")
    table = KeyedTable(
        path=f"{run}/table",
        columns=tuple(C.EVENT.table.columns),
        key=("current_date", "device"),
        order=_ARRIVAL,
        partition="current_date",
    )
    run_available(spark, [Job("event", feeds.events(source, meta=True), sink=table.merge)], f"{run}/checkpoints")
    return table.read(spark)


_STATE_SQL = f"""
    select device, event, arg_max("current_date", (persisttime, event_id)) as "current_date",
           max(receivetime) as receivetime, max(firstoccurrencetime) as firstoccurrencetime,
           max(lastoccurrencetime) as lastoccurrencetime, max(persisttime) as persisttime,
           arg_max(occurrencecount, (persisttime, event_id)) as occurrencecount,
           arg_max(state, (persisttime, event_id)) filter (where state is not null) as state
    from ({_EVENTS_WITH_ID}) group by device, event"""


def _event_state(path: str) -> KeyedTable:
    return KeyedTable(
        path=path,
        columns=tuple(C.EVENT.table.columns),
        key=("device", "event"),
        order=_ARRIVAL,
        buckets=8,
        nulls=C.KEEP,
    )


@query("upsert_stream_keep_nulls", _STATE_SQL)
def upsert_stream_keep_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each device and event, merged from several micro-batches in which nulls overwrite nothing."""
    run = run_dir(spark, "upsert-keep-nulls")
    source = _topic(spark, wire.event_messages(spark, sf_dir), f"{run}/topic")
    table = _event_state(f"{run}/table")
    run_available(spark, [Job("event", feeds.events(source, meta=True), sink=table.merge)], f"{run}/checkpoints")
    return table.read(spark)


@query("append_log_compacted", _STATE_SQL)
def append_log_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state kept as a log: batches are appended, every second one compacts, and readers see both."""
    run = run_dir(spark, "compacted-log")
    source = _topic(spark, wire.event_messages(spark, sf_dir), f"{run}/topic")
    log = LatestLog(f"{run}/log", _event_state(f"{run}/table"))
    append = log.append

    def write(batch: DataFrame, batch_id: int) -> None:
        append(batch, batch_id)
        if batch_id % 3 == 1:
            log.compact(batch.sparkSession)

    run_available(spark, [Job("event", feeds.events(source, meta=True), sink=write)], f"{run}/checkpoints")
    return log.read(spark)


@query("stream_retry_replay", EVENT_ROWS)
def stream_retry_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that fails after writing: the query stops, its restart replays the batch, no row is lost or doubled."""
    run = run_dir(spark, "retry-replay")
    source = _topic(spark, wire.event_messages(spark, sf_dir), f"{run}/topic")
    write = files_sink(f"{run}/events")
    fresh = [True]

    def fails_once(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if fresh and batch_id == 1:
            fresh.clear()
            raise RuntimeError("sink failed after writing")

    def job() -> Job:
        return Job("event", feeds.events(source), sink=guarded(fails_once))

    try:
        run_available(spark, [job()], f"{run}/checkpoints")
    except Exception:
        if fresh:
            raise
    run_available(spark, [job()], f"{run}/checkpoints")
    return spark.read.parquet(f"{run}/events").select(*C.EVENT.table.columns)


@query(
    "stream_dead_letters",
    """
    select 'good' as outcome, count(*) as messages from events
    union all select 'bad', count(*) from documents""",
)
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream over a topic with foreign payloads, into a table and a dead-letter log."""
    run = run_dir(spark, "dead-letters")
    messages = wire.event_messages(spark, sf_dir).unionByName(wire.text_payloads(spark, sf_dir))
    source = _topic(spark, messages, f"{run}/topic")
    job = Job("event", feeds.checked(C.EVENT, source), sink=outcome_sink(f"{run}/rows"))
    run_available(spark, [job], f"{run}/checkpoints")
    return spark.read.parquet(f"{run}/rows").groupBy("outcome").agg(F.count("*").alias("messages"))


@query("store_append_events", EVENT_ROWS)
def store_append_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches appended to a store through its data source, each checked against the table's contract first."""
    run = run_dir(spark, "store")
    source = _topic(spark, wire.event_messages(spark, sf_dir), f"{run}/topic")
    sink = external_sink("parquet", C.EVENT.table, options={"path": f"{run}/store"})
    run_available(spark, [Job("event", feeds.events(source, meta=True), sink=sink)], f"{run}/checkpoints")
    return spark.read.parquet(f"{run}/store").select(*C.EVENT.table.columns)


@query("stream_rate_limit", "select count(*) as n, true as several_batches, true as all_bounded from events")
def stream_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first start reads the whole topic, but in batches of a bounded number of files."""
    run = run_dir(spark, "rate-limit")
    rows = feeds.telemetry(_topic(spark, wire.telemetry_messages(spark, sf_dir), f"{run}/topic"))
    run_available(spark, [Job("telemetry", rows, sink=files_sink(f"{run}/log"))], f"{run}/checkpoints")
    batches = spark.read.parquet(f"{run}/log").groupBy("batch_id").agg(F.count("*").alias("n"))
    return batches.agg(
        F.sum("n").alias("n"),
        (F.count("*") > 1).alias("several_batches"),
        (F.max("n") <= FILES_PER_BATCH * FILE_MESSAGES).alias("all_bounded"),
    )


@query(
    "append_log_latest_view",
    "select 'D' || user_id as device, max(ts) as lastreceivetime from events group by user_id",
)
def append_log_latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry touches every device all the time: batches are only appended, and the view reads the log."""
    run = run_dir(spark, "telemetry-log")
    source = _topic(spark, wire.telemetry_messages(spark, sf_dir), f"{run}/topic")
    job = Job("telemetry", feeds.telemetry(source), sink=files_sink(f"{run}/log"))
    run_available(spark, [job], f"{run}/checkpoints")
    feed = C.TELEMETRY
    log = spark.read.parquet(f"{run}/log").select(*feed.table.columns)
    return keyed.latest(log, feed.state_key, [feed.order], feed.table.nulls)


@query(
    "multi_feed_run",
    f"""
    select 'event' as feed, count(*) as n, count(distinct device) as devices from ({EVENT_ROWS})
    union all select 'telemetry', count(*), count(distinct device) from ({TELEMETRY_SIDE})
    union all select 'parameter', count(*), count(distinct device) from ({PARAMETER_ROWS})""",
)
def multi_feed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three feeds at once, each a named query with its own checkpoint and table."""
    run = run_dir(spark, "multi-feed")
    messages = {
        "event": (feeds.events, wire.event_messages),
        "telemetry": (feeds.telemetry, wire.telemetry_messages),
        "parameter": (feeds.parameter, wire.parameter_messages),
    }
    rows = {
        name: read(_topic(spark, make(spark, sf_dir), f"{run}/{name}-topic")) for name, (read, make) in messages.items()
    }
    jobs = [Job(name, frame, sink=files_sink(f"{run}/{name}"), pool=name) for name, frame in rows.items()]
    run_available(spark, jobs, f"{run}/checkpoints")
    stored = [
        spark.read.parquet(f"{run}/{name}").select(F.lit(name).alias("feed"), "device") for name in rows
    ]
    union = stored[0].unionByName(stored[1]).unionByName(stored[2])
    return union.groupBy("feed").agg(F.count("*").alias("n"), F.count_distinct("device").alias("devices"))


def _joined_to_files(spark: SparkSession, run: str, rows: DataFrame) -> DataFrame:
    run_available(rows.sparkSession, [Job("joined", rows, sink=files_sink(f"{run}/rows"))], f"{run}/checkpoints")
    return spark.read.parquet(f"{run}/rows").select(*C.DEVICE_TELEMETRY.columns)


@query("join_inner_stream", JOINED)
def join_inner_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device and telemetry streams joined without a time bound."""
    run = run_dir(spark, "join-unbounded")
    own = stateful_session(spark, STATE_PARTITIONS)
    devices = _topic(own, wire.device_messages(spark, sf_dir, versions=VERSIONS), f"{run}/devices")
    telemetry = _topic(own, wire.telemetry_messages(spark, sf_dir), f"{run}/telemetry")
    joined = joins.join_versions(
        feeds.device_for_join(devices), feeds.telemetry_for_join(telemetry), "device", salts=4
    )
    return _joined_to_files(spark, run, conform(joined, C.DEVICE_TELEMETRY))


_WITHIN, _LATENESS = "10 days", f"{SLICE_DAYS} days"


def bounded_join(spark: SparkSession, sf_dir: str, run: str) -> DataFrame:
    """Telemetry joined to device versions of the ten days before it, from topics in the order of time.

    The topics come in slices of eight days, and a batch takes about one. The lateness covers a slice, so nothing in
    it is late, and state that no later reading can match is dropped on the way.
    """
    own = stateful_session(spark, STATE_PARTITIONS)
    devices = timed_topic(own, wire.device_messages(spark, sf_dir, versions=VERSIONS), f"{run}/devices")
    telemetry = timed_topic(own, wire.telemetry_messages(spark, sf_dir), f"{run}/telemetry")
    joined = joins.join_versions_within(
        feeds.device_for_join(devices),
        feeds.telemetry_for_join(telemetry),
        "device",
        version_time="persisttime",
        reading_time="last_telemetry",
        within=_WITHIN,
        lateness=_LATENESS,
        salts=4,
    )
    return conform(joined, C.DEVICE_TELEMETRY)


@query(
    "join_inner_bounded_stream",
    f"select * from ({JOINED}) where last_telemetry between persisttime and persisttime + INTERVAL 10 DAY",
)
def join_inner_bounded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry within ten days of the device version, over several micro-batches whose watermarks bound the state."""
    run = run_dir(spark, "join-bounded")
    return _joined_to_files(spark, run, bounded_join(spark, sf_dir, run))


@query(
    "join_stream_static",
    f"""select * from ({TELEMETRY_SIDE}) left join
        (select * from ({DEVICE_SIDE}) qualify row_number() over (partition by device order by persisttime desc) = 1)
        using (device)""",
)
def join_stream_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A telemetry stream enriched from the latest-device view, which a batch wrote before."""
    run = run_dir(spark, "device-state")
    feed = feeds.DEVICE_FOR_JOIN
    devices = feeds.device_for_join(wire.device_messages(spark, sf_dir, versions=VERSIONS), meta=True)
    state = keyed.latest_row(devices, feed.state_key, [feed.order, "_partition", "_offset"])
    state.select(*feed.table.columns).write.parquet(f"{run}/state")
    telemetry = feeds.telemetry_for_join(_topic(spark, wire.telemetry_messages(spark, sf_dir), f"{run}/topic"))
    write = files_sink(f"{run}/rows")

    def enrich(batch: DataFrame, batch_id: int) -> None:
        static = batch.sparkSession.read.parquet(f"{run}/state")
        write(joins.join_state(batch, static, "device", how="left"), batch_id)

    run_available(spark, [Job("telemetry", telemetry, sink=enrich)], f"{run}/checkpoints")
    return spark.read.parquet(f"{run}/rows").select(*C.DEVICE_TELEMETRY.columns)
