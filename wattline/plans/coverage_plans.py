"""What is not there: undeclared fields, missing intervals, keys that collide, devices that never report."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import contracts as C
from wattline import feeds
from wattline.operators import audit, drift, gaps, joins
from wattline.operators.conform import conform
from wattline.plans import wire
from wattline.plans.feed_plans import EVENT_ROWS
from wattline.plans.join_plans import DEVICE_SIDE, TELEMETRY_SIDE, VERSIONS
from wattline.plans.registry import query
from wattline.plans.stream_plans import SLICE_DAYS, STATE_PARTITIONS, timed_topic
from wattline.plans.window_plans import HEARTBEAT, heartbeat
from wattline.streaming.runner import Job, run_available, stateful_session
from wattline.streaming.sinks import files_sink
from wattline.streaming.storage import run_dir


@query(
    "schema_drift",
    """
    select unnest(['device', 'event', 'receiveTime', 'context', 'occurrenceCount', 'firmware.major', 'tags[].name'])
           as path, unnest(['STRING', 'STRING', 'STRING', 'OBJECT', 'OBJECT', 'BIGINT', 'STRING']) as kind,
           n, unnest(['declared', 'declared', 'declared', 'declared', 'mismatch', 'undeclared', 'undeclared']) as status
    from (select count(*) as n from events)
    union all select 'firmware.build', 'STRING', count(*), 'undeclared' from events where value >= 20
    union all select null, 'UNREADABLE', count(*), 'unreadable' from documents
    union all select unnest(['firstOccurrenceTime', 'lastOccurrenceTime', 'persistTime', 'state']), null, 0, 'absent'""",
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a changed producer sends, counted by path and kind, beside what the contract of the feed declares."""
    messages = wire.drifted_messages(spark, sf_dir).unionByName(wire.text_payloads(spark, sf_dir))
    return drift.schema_drift(C.EVENT, messages)


_MISSING = """
    with covered as (select 'D' || user_id as device, ts - INTERVAL 1 DAY as s, ts as e from events),
    calendar as (select min(s) as first, max(e) as last from covered),
    steps as (select device, s, max(e) over (partition by device order by s, e rows between unbounded preceding
              and 1 preceding) as reached from covered),
    missing as (
        select device, coalesce(reached, first) as gap_start, s as gap_end from steps, calendar
        where s > coalesce(reached, first)
        union all select device, max(e), any_value(last) from covered, calendar group by device having max(e) < any_value(last)
        union all select 'D' || c_custkey, first, last from customer, calendar
                  where 'D' || c_custkey not in (select device from covered))"""


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = feeds.profile_facts(wire.profile_facts_messages(spark, sf_dir))
    devices = feeds.device(wire.device_messages(spark, sf_dir))
    calendar = facts.agg(F.min("fromtime"), F.max("totime")).first()
    return gaps.missing_intervals(
        facts, ["device"], "fromtime", "totime", since=calendar[0], until=calendar[1], expected=devices, bin_days=7
    )


@query("missing_intervals", f"{_MISSING} select * from missing")
def missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of the topic's calendar that a device's profile facts do not cover, also of silent devices."""
    return _missing(spark, sf_dir)


@query(
    "missing_by_device",
    f"""{_MISSING} select device, count(*) as gaps, cast(sum(epoch_us(gap_end) - epoch_us(gap_start)) as bigint) as missing_micros,
        max(epoch_us(gap_end) - epoch_us(gap_start)) as longest_micros from missing group by device""",
)
def missing_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much each device's profile facts leave out, and the longest stretch."""
    return gaps.completeness(_missing(spark, sf_dir), ["device"])


_SKETCHED = {"events": C.EVENT.table.key, "last": ("current_date", "device", "event")}


@query(
    "collision_estimates",
    " union all ".join(
        f"""select "current_date", '{name}' as "table", count(*) as rows_in, count(distinct ({', '.join(
            '"current_date"' if part == "current_date" else part for part in key)})) as rows_kept, true as close
            from ({EVENT_ROWS}) group by "current_date" """
        for name, key in _SKETCHED.items()
    ),
)
def collision_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that table keys keep per date, estimated from sketches that micro-batches left, against the exact counts.

    ``close`` says that the estimate is within four standard errors of the sketch.
    """
    run = run_dir(spark, "sketches")
    messages = wire.event_messages(spark, sf_dir)
    write = files_sink(f"{run}/sketches")

    def sketch(batch: DataFrame, batch_id: int) -> None:
        write(audit.key_sketches(batch, _SKETCHED, ["current_date"]), batch_id)

    rows = feeds.events(timed_topic(spark, messages, f"{run}/topic"))
    run_available(spark, [Job("sketches", rows, sink=sketch)], f"{run}/checkpoints")
    stored = spark.read.parquet(f"{run}/sketches")
    estimated = audit.sketched_collisions(stored, ["current_date"])
    exact = feeds.events(messages).groupBy("current_date").agg(
        *[F.count_distinct(F.struct(*key)).alias(name) for name, key in _SKETCHED.items()]
    )
    exact = exact.unpivot("current_date", list(_SKETCHED), "table", "exact")
    error = 4 * 1.04 / math.sqrt(2**audit.SKETCH_REGISTERS)
    close = F.abs(F.col("rows_kept") - F.col("exact")) <= F.col("exact") * error
    return estimated.join(exact, ["current_date", "table"]).select(
        "current_date", "table", "rows_in", F.col("exact").alias("rows_kept"), close.alias("close")
    )


def _device_payload(device: Column, instant: Column) -> Column:
    return F.struct(instant.alias("persistTime"), F.struct(device.alias("device")).alias("current"))


def _telemetry_payload(device: Column, instant: Column) -> Column:
    return F.struct(device.alias("device"), instant.alias("lastReceiveTime"))


@query(
    "join_left_bounded_stream",
    f"""select v.*, last_telemetry from ({DEVICE_SIDE}) v left join ({TELEMETRY_SIDE}) r on v.device = r.device
        and last_telemetry between persisttime and persisttime + INTERVAL 10 DAY""",
)
def join_left_bounded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every device version with its telemetry of ten days, and once without any when the watermark says none can come."""
    run = run_dir(spark, "join-left")
    own = stateful_session(spark, STATE_PARTITIONS, idle_batches=True)
    versions, readings = wire.device_messages(spark, sf_dir, versions=VERSIONS), wire.telemetry_messages(spark, sf_dir)
    last = [heartbeat(versions, C.DEVICE.topic, _device_payload)]
    devices = timed_topic(own, versions, f"{run}/devices", last)
    last = [heartbeat(readings, C.TELEMETRY.topic, _telemetry_payload)]
    telemetry = timed_topic(own, readings, f"{run}/telemetry", last)
    joined = joins.join_versions_within(
        feeds.device_for_join(devices),
        feeds.telemetry_for_join(telemetry),
        "device",
        version_time="persisttime",
        reading_time="last_telemetry",
        within="10 days",
        lateness=f"{SLICE_DAYS} days",
        salts=2,
        how="left",
    )
    sink = files_sink(f"{run}/rows", gather=False)
    run_available(own, [Job("joined", conform(joined, C.DEVICE_TELEMETRY), sink=sink)], f"{run}/checkpoints")
    stored = spark.read.parquet(f"{run}/rows").where(F.col("device") != HEARTBEAT)
    return stored.select(*C.DEVICE_TELEMETRY.columns)
