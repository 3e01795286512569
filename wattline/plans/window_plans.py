"""Streaming queries whose state follows event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import contracts as C
from wattline import feeds
from wattline.operators.audit import observed
from wattline.plans import wire
from wattline.plans.feed_plans import EVENT_ROWS
from wattline.plans.registry import query
from wattline.plans.stream_plans import SLICE_DAYS, STATE_PARTITIONS, timed_topic
from wattline.streaming import audit_log, silence, windows
from wattline.streaming.runner import Job, run_available, stateful_session
from wattline.streaming.sinks import files_sink, outcome_sink
from wattline.streaming.storage import run_dir

_LATENESS = f"{SLICE_DAYS} days"
HEARTBEAT = "heartbeat"


def _event_payload(device: Column, instant: Column) -> Column:
    times = [instant.alias(name) for name in ("receiveTime", "persistTime", "firstOccurrenceTime")]
    return F.struct(device.alias("device"), device.alias("event"), *times)


def heartbeat(messages: DataFrame, topic: str = C.EVENT.topic, payload=_event_payload) -> DataFrame:
    """A last message of a device of its own, so late that the watermark passes all that came before it."""
    at = F.col("at") + F.make_dt_interval(F.lit(100))
    instant = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return messages.agg(F.max("timestamp").alias("at")).select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(payload(F.lit(HEARTBEAT), instant)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(-1).cast("bigint").alias("offset"),
        at.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _event_stream(spark: SparkSession, messages: DataFrame, run: str) -> DataFrame:
    return feeds.events(timed_topic(spark, messages, f"{run}/topic", last=[heartbeat(messages)]))


@query(
    "hourly_counts_stream",
    f"""
    select date_trunc('hour', receivetime) as window_start, event, count(*) as n, min(receivetime) as first_time,
           max(receivetime) as last_time, cast(sum(occurrencecount) as bigint) as sum_occurrencecount
    from ({EVENT_ROWS}) group by all""",
)
def hourly_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and kind, each hour written once when the watermark has passed it."""
    run = run_dir(spark, "hourly-counts")
    own = stateful_session(spark, STATE_PARTITIONS, idle_batches=True)
    rows = _event_stream(own, wire.event_messages(spark, sf_dir), run)
    counted = windows.window_counts(rows, "receivetime", ["event"], lateness=_LATENESS, sums=["occurrencecount"])
    sink = files_sink(f"{run}/rows", gather=False)
    run_available(own, [Job("hourly-counts", counted, sink=sink)], f"{run}/checkpoints")
    stored = spark.read.parquet(f"{run}/rows").where(F.col("event") != HEARTBEAT)
    return stored.select(*counted.columns)


@query("stream_redeliveries", EVENT_ROWS)
def stream_redeliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered again one slice later: the stream passes each on once."""
    run = run_dir(spark, "redeliveries")
    own = stateful_session(spark, STATE_PARTITIONS)
    once = wire.event_messages(spark, sf_dir)
    again = once.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(F.lit(SLICE_DAYS)))
    rows = feeds.events(timed_topic(own, once.unionByName(again), f"{run}/topic"))
    passed = windows.without_redeliveries(rows, C.EVENT.history_key, "persisttime", within=f"{2 * SLICE_DAYS} days")
    sink = files_sink(f"{run}/rows", gather=False)
    run_available(own, [Job("redeliveries", passed, sink=sink)], f"{run}/checkpoints")
    return spark.read.parquet(f"{run}/rows").select(*C.EVENT.table.columns)


_SILENT_HOURS = 6


@query(
    "silence_alarms_stream",
    f"""
    select device, last_seen, last_seen + INTERVAL {_SILENT_HOURS} HOUR as alarm_time, event as last_event
    from (select 'D' || user_id as device, ts as last_seen, max(event_type) as event,
                 lead(ts) over (partition by user_id order by ts) as next from events group by user_id, ts)
    where next is null or next > last_seen + INTERVAL {_SILENT_HOURS} HOUR""",
)
def silence_alarms_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each device as it stood when the device had sent nothing for six hours."""
    run = run_dir(spark, "silence")
    own = stateful_session(spark, STATE_PARTITIONS, idle_batches=True)
    rows = _event_stream(own, wire.event_messages(spark, sf_dir), run)
    alarms = silence.silence_alarms(
        rows, "device", "receivetime", "event", after_seconds=_SILENT_HOURS * 3600, lateness=_LATENESS
    )
    sink = files_sink(f"{run}/rows", gather=False)
    run_available(own, [Job("silence", alarms, sink=sink)], f"{run}/checkpoints")
    stored = spark.read.parquet(f"{run}/rows").where(F.col("device") != HEARTBEAT)
    return stored.select("device", "last_seen", "alarm_time", F.col("last_value").alias("last_event"))


@query(
    "reconcile_batches",
    """
    select (select count(*) from events) + (select count(*) from documents) as rows, (select count(*) from documents)
           as errors, (select count(*) from events) as good, true as several_batches, true as equal_to_files""",
)
def reconcile_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that every micro-batch reported while it was written, kept in an audit table and summed up."""
    run = run_dir(spark, "batch-audit")
    messages = wire.event_messages(spark, sf_dir).unionByName(wire.text_payloads(spark, sf_dir))
    checked = feeds.checked(C.EVENT, timed_topic(spark, messages, f"{run}/topic"))
    log = audit_log.AuditLog(spark, f"{run}/audit", ["event-counts"])
    with log:
        job = Job("event", observed(checked, "event-counts"), sink=outcome_sink(f"{run}/rows"))
        run_available(spark, [job], f"{run}/checkpoints")
        log.settle()
    counts = log.read(spark)
    counted = counts.select("rows", "errors", "good", F.lit(0).alias("stored"), F.lit(1).alias("batches"))
    zero = [F.lit(0).alias(name) for name in ("rows", "errors", "good")]
    stored = spark.read.parquet(f"{run}/rows").agg(F.count("*").alias("stored")).select(*zero, "stored", F.lit(0).alias("batches"))
    sums = counted.unionByName(stored).agg(*[F.sum(name).alias(name) for name in counted.columns])
    return sums.select(
        "rows",
        "errors",
        "good",
        (F.col("batches") > 1).alias("several_batches"),
        (F.col("rows") == F.col("stored")).alias("equal_to_files"),
    )
