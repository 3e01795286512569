"""The twelve feeds: messages in, table rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import contracts as C
from wattline import feeds
from wattline.operators.decode import decode_map
from wattline.plans import wire
from wattline.plans.registry import query
from wattline.sources import json_files
from wattline.streaming.storage import run_dir

_CHANGED = "o_orderdate + INTERVAL 1 DAY + to_seconds(o_orderkey % 86400)"
_ID = "cast(o_orderkey % 2147483647 as integer)"

EVENT_ROWS = """
    select cast(ts + INTERVAL 1 HOUR as date) as "current_date", ts as receivetime, 'D' || user_id as device,
           event_type as event, ts as firstoccurrencetime, ts + INTERVAL 30 MINUTE as lastoccurrencetime,
           cast(json_extract(props, '$.k') as integer) as occurrencecount, ts + INTERVAL 1 HOUR as persisttime,
           case when value >= 20 then 'open' when value >= 10 then 'closed' end as state
    from events"""


@query("feed_event", EVENT_ROWS)
def feed_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.events(wire.event_messages(spark, sf_dir))


@query("feed_telemetry", "select 'D' || user_id as device, ts as lastreceivetime from events")
def feed_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.telemetry(wire.telemetry_messages(spark, sf_dir))


def _device_sql(manufacturer: str) -> str:
    return f"""
    select cast(timestamp '2024-01-01' + to_seconds(c_custkey) as date) as date,
           timestamp '2024-01-01' + to_seconds(c_custkey) as persisttime, n_name as city,
           cast(c_custkey as varchar) as communicationid, c_mktsegment as company, r_name as country,
           '' as description, 'D' || c_custkey as device, n_name as district, '' as floor, n_name as "group",
           cast(c_nationkey as varchar) as housenumber, 'unknown' as inventorystate,
           c_nationkey || '.5' as latitude, c_name as logicalinstallationpoint, r_regionkey || '.25' as longitude,
           case when c_acctbal < 0 then 'suspended' else 'registered' end as managementstate,
           {manufacturer} as manufacturer, c_name as model, cast(c_custkey as varchar) as postalcode,
           '' as reference, r_name as region, cast(null as varchar) as street, 'UTC' as timezone,
           c_mktsegment as type
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""


@query(
    "feed_device_flatten",
    _device_sql("case when c_acctbal >= 1000 then 'M' || c_nationkey when c_acctbal >= 0 then '' end"),
)
def feed_device_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.device(wire.device_messages(spark, sf_dir))


@query(
    "feed_device_default_manufacturer",
    _device_sql("case when c_acctbal >= 1000 then 'M' || c_nationkey else 'unknown' end"),
)
def feed_device_default_manufacturer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.device(wire.device_messages(spark, sf_dir), default_manufacturer="unknown")


# One wide pass with an unnest rather than one pass per register.
MEASUREMENT_ROWS = """
    select cast(l_shipdate as date) as receive_date, l_shipdate + to_minutes(l_linenumber) as receivetime,
           'P' || l_partkey as device, l_shipdate as measuretime,
           l_shipdate + to_minutes(l_linenumber) + INTERVAL 1 SECOND as persisttime, l_linestatus as profile,
           l_returnflag as readingreason, register, unit, cast(reading as float) as value
    from (select *, unnest(['quantity', 'price', 'discount', 'tax']) as register,
                 unnest(['kWh', 'kVAh', 'V', 'A']) as unit,
                 unnest([l_quantity, l_extendedprice, l_discount, l_tax]) as reading from lineitem)"""


@query("feed_measurement", MEASUREMENT_ROWS)
def feed_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.measurement(wire.measurement_messages(spark, sf_dir))


@query("feed_measurement_points", f"select *, measuretime as pointtime from ({MEASUREMENT_ROWS})")
def feed_measurement_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.measurement(wire.measurement_messages(spark, sf_dir), point_time=True)


@query(
    "feed_register_stat",
    """
    select cast(l_shipdate as date) as date, 'P' || l_partkey as device, 'R' || l_suppkey as register,
           cast(l_discount as float) as dd_average, cast(l_quantity as integer) as dd_maximum,
           l_linenumber as dd_minimum, l_linenumber as mr_edited, l_linenumber % 2 as mr_estimated,
           24 as mr_expected, case when l_returnflag = 'R' then l_linenumber end as mr_invalidated,
           cast(l_quantity as integer) as mr_received
    from lineitem""",
)
def feed_register_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.register_statistic(wire.register_statistic_messages(spark, sf_dir))


def _process_sql(started: str) -> str:
    return f"""
    select cast({_CHANGED} as date) as date, {_CHANGED} as persisttime,
           case when o_orderstatus <> 'O' then o_orderdate + INTERVAL 1 DAY end as completiontime,
           case when o_orderstatus = 'F' then 'failed: ' || o_orderpriority end as current_error,
           o_orderstatus as current_status, 'C' || o_custkey as device, 'recurring' as executiontype, {_ID} as id,
           o_orderdate as inittime, 'executing' as previous_status,
           case when o_orderstatus <> 'P' then o_orderpriority end as profile_id,
           case when o_orderstatus <> 'P' then '1' end as reading_reason_code, {started} as starttime,
           o_orderpriority as type
    from orders"""


@query("feed_process", _process_sql("o_orderdate + INTERVAL 1 HOUR"))
def feed_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.process(wire.process_messages(spark, sf_dir))


@query(
    "feed_process_text_times",
    _process_sql("case when o_orderstatus <> 'P' then o_orderdate + INTERVAL 1 HOUR end"),
)
def feed_process_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.process_text_times(wire.process_messages(spark, sf_dir, text_times=True))


@query(
    "process_map_params",
    f"""
    select {_ID} as id, kind, o_orderpriority as profile_id, '1' as reading_reason_code
    from (select *, unnest(case o_orderstatus when 'F' then ['profileRead', 'registerRead']
                           when 'P' then [] else ['profileRead'] end) as kind from orders)""",
)
def process_map_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = decode_map(
        wire.process_messages(spark, sf_dir), feeds.PROCESS_MAP, "parameters", key="kind", value="read"
    )
    return entries.select(
        "id",
        "kind",
        F.col("read.profileId").alias("profile_id"),
        F.col("read.readingReasonCode").alias("reading_reason_code"),
    )


PARAMETER_ROWS = """
    select 'D' || user_id as device, ts + INTERVAL 5 SECOND as receivetime, ts as changetime,
           cast(ts + INTERVAL 5 SECOND as date) as date, json_extract_string(props, '$.k') as newvalue,
           '' as oldvalue, event_type as parameter, ts + INTERVAL 6 SECOND as persisttime
    from events"""


@query("feed_parameter", PARAMETER_ROWS)
def feed_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.parameter(wire.parameter_messages(spark, sf_dir))


@query(
    "feed_profile_facts",
    """
    select 'D' || user_id as device, event_type as profile, cast(ts as date) as date, ts as gatheredat,
           value as actual, case when value > 20 then 'NaN' else '1' end as completeness,
           cast(24 as double) as expected, ts - INTERVAL 1 DAY as fromtime, ts as totime
    from events""",
)
def feed_profile_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.profile_facts(wire.profile_facts_messages(spark, sf_dir))


@query(
    "feed_oper_process",
    f"select {_ID} as id, o_orderpriority as type, {_CHANGED} as persisttime, o_orderstatus as status from orders",
)
def feed_oper_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.operational_process(wire.operational_process_messages(spark, sf_dir))


@query(
    "feed_topology",
    """
    select 'O' || l_orderkey as device, childdevice, l_shipdate as receivetime,
           l_shipdate + INTERVAL 1 SECOND as persisttime, l_shipdate as addtime, datasource
    from (select *, unnest(['P' || l_partkey, 'S' || l_suppkey]) as childdevice,
                 unnest(['part', 'supplier']) as datasource from lineitem)""",
)
def feed_topology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.topology(wire.topology_messages(spark, sf_dir))


@query(
    "feed_derived_measurement",
    """
    select 'S' || l_suppkey as device, 'P' || l_partkey as register, l_shipdate + INTERVAL 1 DAY as persisttime,
           '1' as unit, l_shipdate + to_hours(hour) as time, value, l_returnflag as quality
    from (select *, unnest([0, 1, 2]) as hour, unnest([l_quantity, cast(l_linenumber as double), null]) as value
          from lineitem)""",
)
def feed_derived_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.derived_measurement(wire.derived_measurement_messages(spark, sf_dir))


def _image_sql(side: str, group: str, present: str) -> str:
    values = {
        "meteringpoint": "'M' || o_custkey", "group": group, "servicelevel": "''", "latitude": "cast('22.5' as double)",
        "longitude": "cast(o_custkey || '.25' as double)", "city": "'City ' || o_custkey", "country": "''",
    }
    columns = []
    for name in C.METERING_POINT_FIELDS:
        kind = "double" if name in ("latitude", "longitude") else "varchar"
        value = f"case when {present} then {values[name]} end" if name in values else f"cast(null as {kind})"
        columns.append(f"{value} as {side}_{name}")
    return ", ".join(columns)


_KEPT = "not (o_orderstatus = 'F' and o_orderkey % 5 = 0)"

METERING_POINT_ROWS = f"""
    select {_CHANGED} as persisttime, 'M' || o_custkey as meteringpoint,
           {_image_sql("previous", "'before'", "o_orderstatus <> 'O'")},
           {_image_sql("current", "o_orderpriority", _KEPT)}
    from orders"""


@query("feed_metering_point", METERING_POINT_ROWS)
def feed_metering_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.metering_point(wire.metering_point_messages(spark, sf_dir))


@query("metering_point_json_files", METERING_POINT_ROWS)
def metering_point_json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = wire.source(spark, sf_dir, "orders")
    path = run_dir(spark, "metering-point-json")
    orders.select(wire.metering_point_json(orders)).write.text(path)
    return feeds.metering_point_from_files(json_files(spark, path, C.METERING_POINT.message))


METERING_POINT_DEVICE_ROWS = f"""
    select {_CHANGED} as persisttime, 'M' || o_custkey as meteringpoint, 0 as position, 'D' || o_custkey as device,
           o_orderdate as assigntime, case when o_orderstatus = 'F' then o_orderdate + INTERVAL 30 DAY end as removetime
    from orders where {_KEPT}
    union all
    select {_CHANGED}, 'M' || o_custkey, 1, 'N' || o_orderkey, o_orderdate + INTERVAL 30 DAY, null
    from orders where o_orderstatus = 'F' and {_KEPT}"""


@query("metering_point_devices", METERING_POINT_DEVICE_ROWS)
def metering_point_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.metering_point_devices(wire.metering_point_messages(spark, sf_dir))


@query(
    "metering_point_previous_states",
    f"""
    select {_CHANGED} as persisttime, 'M' || o_custkey as meteringpoint, 0 as position, 'connected' as state,
           o_orderdate as activesince
    from orders where o_orderstatus <> 'O'""",
)
def metering_point_previous_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.metering_point_states(wire.metering_point_messages(spark, sf_dir), "previous")
