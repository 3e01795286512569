"""Keyed-table operators and audits."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import contracts as C
from wattline import feeds
from wattline.operators import audit, keyed, layout
from wattline.operators.conform import conform
from wattline.operators.decode import PAYLOAD, split_errors
from wattline.plans import wire
from wattline.plans.feed_plans import EVENT_ROWS, MEASUREMENT_ROWS, PARAMETER_ROWS
from wattline.plans.registry import query
from wattline.streaming.sinks import gathered
from wattline.streaming.storage import run_dir

_ARRIVAL = ["persisttime", "_partition", "_offset"]
_EVENTS_WITH_ID = EVENT_ROWS.replace("from events", ", event_id from events")


def _latest_sql(key: str) -> str:
    return f"""
    select * exclude (event_id) from ({_EVENTS_WITH_ID})
    qualify row_number() over (partition by {key} order by persisttime desc, event_id desc) = 1"""


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.events(wire.event_messages(spark, sf_dir), meta=True)


def _stored(rows: DataFrame) -> DataFrame:
    return rows.drop("_topic", "_partition", "_offset")


@query("latest_by_key", _latest_sql("device, event"))
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, key = C.EARLIER_KEYS["dev_event"]
    return _stored(keyed.latest_row(_events(spark, sf_dir), key, _ARRIVAL))


@query(
    "latest_by_table_key",
    """
    select cast(l_shipdate as date) as receive_date, l_shipdate + to_minutes(l_linenumber) as receivetime,
           max(l_orderkey * 8 + l_linenumber) as last_arrival from lineitem group by all""",
)
def latest_by_table_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings under the table's key, in which all readings received at one instant collide."""
    feed = C.MEASUREMENT
    rows = feeds.measurement(wire.measurement_messages(spark, sf_dir), meta=True)
    newest = keyed.latest_row(rows, feed.table.key, ["_offset"])
    return newest.select(*feed.table.key, F.col("_offset").alias("last_arrival"))


@query(
    "merge_keep_nulls",
    f"""
    select device, event, arg_max("current_date", (persisttime, event_id)) as "current_date",
           max(receivetime) as receivetime, max(firstoccurrencetime) as firstoccurrencetime,
           max(lastoccurrencetime) as lastoccurrencetime, max(persisttime) as persisttime,
           arg_max(occurrencecount, (persisttime, event_id)) as occurrencecount,
           arg_max(state, (persisttime, event_id)) filter (where state is not null) as state
    from ({_EVENTS_WITH_ID}) group by device, event""",
)
def merge_keep_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir)
    return _stored(keyed.latest_values(rows, ["device", "event"], _ARRIVAL))


@query("history_collapses_redeliveries", EVENT_ROWS)
def history_collapses_redeliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message delivered twice: under the history key each row is kept once and none is lost."""
    messages = wire.event_messages(spark, sf_dir)
    rows = feeds.events(messages.unionByName(messages), meta=True)
    return _stored(keyed.latest_row(rows, C.EVENT.history_key, _ARRIVAL))


@query(
    "latest_by_manufacturer",
    """
    select manufacturer, arg_max(c_custkey, c_custkey) as last_id, arg_max('D' || c_custkey, c_custkey) as device,
           arg_max(cast(c_nationkey || '.5' as double), c_custkey) as latitude,
           max(timestamp '2024-01-01' + to_seconds(c_custkey)) as persisttime
    from (select *, case when c_acctbal >= 1000 then 'M' || c_nationkey when c_acctbal >= 0 then '' end as manufacturer
          from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
    where manufacturer is not null group by manufacturer""",
)
def latest_by_manufacturer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier device table: keyed by manufacturer, coordinates as numbers, devices without the key refused."""
    table = C.earlier_table("device_by_manufacturer")
    devices = feeds.device(wire.device_messages(spark, sf_dir), meta=True).drop("date")
    good, _ = split_errors(conform(devices, table, errors=True).withColumn(PAYLOAD, F.lit(None)))
    newest = keyed.latest(good, table.key, _ARRIVAL, table.nulls)
    return newest.select("manufacturer", F.col("_offset").alias("last_id"), "device", "latitude", "persisttime")


@query(
    "latest_register_stat",
    """
    select device, register, date, max(arrival) as last_arrival from (
        select 'P' || l_partkey as device, 'R' || l_suppkey as register, cast(l_shipdate as date) as date,
               l_orderkey * 8 + l_linenumber as arrival from lineitem) group by all""",
)
def latest_register_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register statistics are ordered by arrival only; the newest arrival per state key."""
    feed = C.REGISTER_STATISTIC
    rows = feeds.register_statistic(wire.register_statistic_messages(spark, sf_dir), meta=True)
    newest = keyed.latest_row(rows, feed.state_key, [feed.order])
    return newest.select(*feed.state_key, F.col("_offset").alias("last_arrival"))


_TELEMETRY = "select 'D' || user_id as device, ts as lastreceivetime, event_id as id from events"


@query(
    "top_n_newest",
    f"""select * from ({_TELEMETRY})
        qualify row_number() over (partition by device order by lastreceivetime desc, id desc) <= 3""",
)
def top_n_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.telemetry(wire.telemetry_messages(spark, sf_dir), meta=True)
    top = keyed.top_newest(rows, ["device"], ["lastreceivetime", "_offset"], 3)
    return top.select("device", "lastreceivetime", F.col("_offset").alias("id"))


@query(
    "top_n_newest_large",
    """select event_type as event, ts as persisttime, event_id as id from events
       qualify row_number() over (partition by event_type order by ts desc, event_id desc) <= 1500""",
)
def top_n_newest_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few kinds of events hold all rows: the newest 1500 of each."""
    rows = feeds.events(wire.event_messages(spark, sf_dir), meta=True)
    top = keyed.top_newest(rows, ["event"], ["firstoccurrencetime", "_offset"], 1500)
    return top.select("event", F.col("firstoccurrencetime").alias("persisttime"), F.col("_offset").alias("id"))


@query("newest_first", "select 'D' || user_id as device, ts as lastreceivetime from events")
def newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = C.TELEMETRY.table
    rows = feeds.telemetry(wire.telemetry_messages(spark, sf_dir))
    return keyed.newest_first(rows, table.partition, table.clustering)


@query("slice_by_date", f"""select * from ({EVENT_ROWS}) where "current_date" = date '2024-01-15'""")
def slice_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored under their date, then one date read back from its directory alone."""
    path = run_dir(spark, "events-by-date")
    rows = feeds.events(wire.event_messages(spark, sf_dir))
    gathered(rows, ["current_date"]).write.partitionBy("current_date").parquet(path)
    day = keyed.slice_by(spark.read.parquet(path), current_date=datetime.date(2024, 1, 15))
    return day.select(*C.EVENT.table.columns)


@query(
    "slice_by_device",
    f"""select * from ({EVENT_ROWS}) where "current_date" = date '2024-01-15' and device = 'D8'""",
)
def slice_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored by date and clustered by device, then one device's rows of one date: other row groups are skipped."""
    path = run_dir(spark, "events-by-device")
    rows = feeds.events(wire.event_messages(spark, sf_dir))
    layout.write_clustered(rows, path, ["current_date"], ["device"], ["receivetime"])
    one = keyed.slice_by(spark.read.parquet(path), current_date=datetime.date(2024, 1, 15), device="D8")
    return one.select(*C.EVENT.table.columns)


@query("device_history", f"""select * from ({EVENT_ROWS}) where device = 'D8'""")
def device_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same store read across all dates, newest first: a few row groups of every date."""
    path = run_dir(spark, "events-by-device")
    rows = feeds.events(wire.event_messages(spark, sf_dir))
    layout.write_clustered(rows, path, ["current_date"], ["device"], ["receivetime"])
    one = keyed.slice_by(spark.read.parquet(path), device="D8").select(*C.EVENT.table.columns)
    return keyed.newest_first(one, ["device"], ["receivetime"])


_AUDITED = {
    "events": (EVENT_ROWS, '"current_date", receivetime'),
    "measurement": (MEASUREMENT_ROWS, "receive_date, receivetime"),
    "parameter": (PARAMETER_ROWS, "device, receivetime"),
    "dev_event": (EVENT_ROWS, "device, event"),
}


@query(
    "key_collisions",
    " union all ".join(
        f"""
    select '{name}' as "table", cast(sum(n) as bigint) as rows_in, count(*) as rows_kept,
           cast(sum(n) - count(*) as bigint) as rows_lost, max(n) as largest_collision
    from (select count(*) as n from ({rows}) group by {key})"""
        for name, (rows, key) in _AUDITED.items()
    ),
)
def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = [
        audit.key_collisions(
            feeds.events(wire.event_messages(spark, sf_dir)),
            {"events": C.EVENT.table.key, "dev_event": C.EARLIER_KEYS["dev_event"][1]},
        ),
        audit.key_collisions(
            feeds.measurement(wire.measurement_messages(spark, sf_dir)),
            {"measurement": C.MEASUREMENT.table.key},
        ),
        audit.key_collisions(
            feeds.parameter(wire.parameter_messages(spark, sf_dir)), {"parameter": C.PARAMETER.table.key}
        ),
    ]
    return reduce(DataFrame.unionByName, reports)


def _reconcile_sql(feed: str, rows: str, key: str, source: str) -> str:
    return f"""
    select '{feed}' as feed, cast((select count(*) from {source}) + (select count(*) from documents) as bigint)
           as messages, (select count(*) from documents) as dead_letters, cast(0 as bigint) as messages_without_rows,
           (select count(*) from {source}) as messages_with_rows, cast(sum(n) as bigint) as rows_out,
           cast(0 as bigint) as rows_rejected, cast(sum(n) as bigint) as rows_writable,
           count(*) as rows_kept_by_key
    from (select count(*) as n from ({rows}) group by {key})"""


@query(
    "reconcile_feed",
    _reconcile_sql("device-event", *_AUDITED["events"], "events")
    + " union all "
    + _reconcile_sql("device-measurement", *_AUDITED["measurement"], "lineitem"),
)
def reconcile_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per stage of two feeds whose topics also carry payloads that are not messages."""
    junk = wire.text_payloads(spark, sf_dir)
    sources = {
        C.EVENT: wire.event_messages(spark, sf_dir),
        C.MEASUREMENT: wire.measurement_messages(spark, sf_dir),
    }
    reports = [audit.reconcile(feed, messages.unionByName(junk)) for feed, messages in sources.items()]
    return reduce(DataFrame.unionByName, reports)


@query(
    "reconcile_written_table",
    f"""
    select "current_date" as date, count(*) as rows_expected, count(*) filter (written) as rows_found,
           count(*) filter (not written) as rows_missing
    from (select "current_date", device, event, firstoccurrencetime, persisttime, bool_or(event_id % 7 <> 0) as written
          from ({_EVENTS_WITH_ID}) group by all) group by "current_date\"""",
)
def reconcile_written_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows of the topic never reached the stored table, per date: the table was written with losses."""
    path = run_dir(spark, "lossy-events")
    messages = wire.event_messages(spark, sf_dir)
    feeds.events(messages.where("offset % 7 <> 0")).write.parquet(path)
    return audit.reconcile_written(C.EVENT, messages, spark.read.parquet(path), C.EVENT.history_key)
