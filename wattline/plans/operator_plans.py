"""Single operators: decode, projection, filters, casts and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import contracts as C
from wattline import feeds
from wattline.functions import to_float, to_instant, to_number
from wattline.operators import project
from wattline.operators.conform import conform
from wattline.operators.decode import ERROR, decode, decode_checked, expand
from wattline.plans import wire
from wattline.plans.feed_plans import EVENT_ROWS, METERING_POINT_ROWS
from wattline.plans.registry import query
from wattline.sources import read_feed


@query(
    "decode_json_props",
    "select event_id, cast(json_extract(props, '$.k') as integer) as k from events",
)
def decode_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = wire.source(spark, sf_dir, "events").select("props", F.col("event_id").alias("offset"))
    return expand(decode(rows, "k int", column="props")).withColumnRenamed("_offset", "event_id")


@query(
    "decode_opaque_text",
    """
    select event_id, '{"k":' || json_extract_string(props, '$.k') || '}' as context from events""",
)
def decode_opaque_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = expand(decode(wire.event_messages(spark, sf_dir), C.EVENT.message))
    return records.select(F.col("_offset").alias("event_id"), "context")


@query(
    "dead_letter_split",
    f"""
    select '{C.EVENT.topic}' as topic, event_id as id, cast(null as varchar) as error,
           cast(null as bigint) as payload_chars from events
    union all
    select 'documents', doc_id, case when trim(text, E' \\t\\r\\n') = '' then 'empty payload'
                                     else 'not one JSON object' end, length(text) from documents""",
)
def dead_letter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = wire.event_messages(spark, sf_dir).unionByName(wire.text_payloads(spark, sf_dir))
    rows = decode_checked(messages, C.EVENT.message, C.EVENT.required)
    return rows.select(
        F.col("_topic").alias("topic"),
        F.col("_offset").alias("id"),
        F.col(ERROR).alias("error"),
        F.length("_payload").cast("bigint").alias("payload_chars"),
    )


@query("decode_quoted_numbers", EVENT_ROWS)
def decode_quoted_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senders differ in whether they quote numbers: every second message has its count as text."""
    messages = wire.event_messages(spark, sf_dir)
    quoted = F.regexp_replace(F.col("value").cast("string"), r'"occurrenceCount":(\d+)', '"occurrenceCount":"$1"')
    value = F.when(F.col("offset") % 2 == 0, quoted.cast("binary")).otherwise(F.col("value"))
    checked = feeds.checked(C.EVENT, messages.withColumn("value", value))
    return checked.where(F.col(ERROR).isNull()).select(*C.EVENT.table.columns)


@query(
    "dead_letter_bad_group",
    """
    with m as (select event_id as id, event_id % 6 as kind, cast(json_extract(props, '$.k') as float) as k from events)
    select id, cast(null as varchar) as register, cast(null as float) as value, 'badly typed field' as error
    from m where kind = 0
    union all select id, null, null, 'no array dataPoints' from m where kind = 1
    union all select id, null, null, 'null element of dataPoints' from m where kind = 2
    union all select id, 'b', k, null from m where kind = 2
    union all select id, 'a', null, 'value is not float' from m where kind = 4
    union all select id, 'a', k, null from m where kind in (4, 5)""",
)
def dead_letter_bad_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose group is an object, missing, has a null element, is empty, has a bad number, or is good."""
    k = F.get_json_object("props", "$.k")
    good, bad = F.concat(F.lit('{"register":"a","value":'), k, F.lit("}")), F.lit('{"register":"a","value":"much"}')
    quoted = F.concat(F.lit('{"register":"b","value":"'), k, F.lit('"}'))
    group = (
        F.when(F.col("event_id") % 6 == 0, F.concat(F.lit(',"dataPoints":'), good))
        .when(F.col("event_id") % 6 == 1, F.lit(""))
        .when(F.col("event_id") % 6 == 2, F.concat(F.lit(',"dataPoints":[null,'), quoted, F.lit("]")))
        .when(F.col("event_id") % 6 == 3, F.lit(',"dataPoints":[]'))
        .when(F.col("event_id") % 6 == 4, F.concat(F.lit(',"dataPoints":['), bad, F.lit(","), good, F.lit("]")))
        .otherwise(F.concat(F.lit(',"dataPoints":['), good, F.lit("]")))
    )
    head = F.lit('{"device":"D","receiveTime":"2024-01-01T00:00:00Z"')
    events = wire.source(spark, sf_dir, "events")
    messages = events.select(
        F.col("event_id").alias("offset"), F.concat(head, group, F.lit("}")).cast("binary").alias("value")
    )
    rows = feeds.checked(C.MEASUREMENT, messages)
    return rows.select(F.col("_offset").alias("id"), "register", "value", F.col(ERROR).alias("error"))


@query(
    "dead_letter_null_key",
    """
    select case event_id % 4 when 0 then 'missing device' when 1 then 'null key current_date' end as error,
           count(*) as n from events group by 1""",
)
def dead_letter_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a required field, or without the time that their table's key is derived from."""
    text = F.col("value").cast("string")
    value = (
        F.when(F.col("offset") % 4 == 0, F.regexp_replace(text, '"device":"[^"]*",', ""))
        .when(F.col("offset") % 4 == 1, F.regexp_replace(text, '"persistTime":"[^"]*",', ""))
        .otherwise(text)
    )
    messages = wire.event_messages(spark, sf_dir).withColumn("value", value.cast("binary"))
    rows = feeds.checked(C.EVENT, messages)
    return rows.groupBy(F.col(ERROR).alias("error")).agg(F.count("*").alias("n"))


@query(
    "read_feed_topic",
    "select event_id as id, 'D' || user_id as device from events",
)
def read_feed_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = wire.event_messages(spark, sf_dir).unionByName(wire.telemetry_messages(spark, sf_dir))
    messages = read_feed(spark, C.TELEMETRY, mixed, topic=C.TELEMETRY.topic)
    return feeds.telemetry(messages, meta=True).select(F.col("_offset").alias("id"), "device")


@query("filter_not_null", f"select * from ({EVENT_ROWS}) where state is not null")
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project.require(feeds.events(wire.event_messages(spark, sf_dir)), "state")


@query(
    "flatten_nested",
    """
    select timestamp '2024-01-01' + to_seconds(c_custkey) as "persistTime", 'D' || c_custkey as device,
           n_name as city, c_nationkey || '.5' as latitude, '["' || c_mktsegment || '"]' as tags
    from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
)
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = expand(decode(wire.device_messages(spark, sf_dir), C.DEVICE.message))
    flat = project.flatten(records)
    return flat.select("persistTime", "device", "city", "latitude", "tags")


@query(
    "expand_sibling_structs",
    """
    select 'P' || l_partkey as device, 24 as mr_expected, cast(l_quantity as integer) as mr_received,
           l_linenumber as mr_edited, case when l_returnflag = 'R' then l_linenumber end as mr_invalidated,
           l_linenumber % 2 as mr_estimated, l_linenumber as dd_minimum, cast(l_quantity as integer) as dd_maximum,
           cast(l_discount as float) as dd_average from lineitem""",
)
def expand_sibling_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = wire.register_statistic_messages(spark, sf_dir)
    records = expand(decode(messages, C.REGISTER_STATISTIC.message))
    return project.expand_siblings(records, {"meterReads": "mr_", "deliveryDelay": "dd_"}, keep=["device"])


def _maybe_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records with a group that is missing, empty, or has one or two elements."""
    events = wire.source(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    group = (
        F.when(F.col("event_type") == "error", F.lit(None))
        .when(F.col("event_type") == "view", F.array().cast("array<int>"))
        .when(F.col("event_type") == "click", F.array(k))
        .otherwise(F.array(k, k + 1))
    )
    value = wire.json({"id": F.col("event_id"), "group": group})
    rows = events.select(F.col("event_id").alias("offset"), value.alias("value"))
    return expand(decode(rows, "id bigint, `group` array<int>")).drop("_offset")


_ELEMENTS = """
    select event_id as id, position, k + position as element
    from (select *, cast(json_extract(props, '$.k') as integer) as k,
                 unnest(case when event_type in ('error', 'view') then [{empty}] when event_type = 'click' then [0]
                        else [0, 1] end) as position from events)"""


@query("explode_rows", _ELEMENTS.format(empty=""))
def explode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project.explode_rows(_maybe_empty(spark, sf_dir), "group", position="position")
    return rows.select("id", "position", "element")


@query("explode_outer_empty", _ELEMENTS.format(empty="null"))
def explode_outer_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = project.explode_rows(_maybe_empty(spark, sf_dir), "group", outer=True, position="position")
    return rows.select("id", "position", "element")


@query(
    "parallel_arrays",
    """
    select 'S' || l_suppkey as device, cast(l_quantity as integer) || ',' || l_linenumber || ',n/a' as point_values,
           l_returnflag || ',' || l_returnflag || ',' || l_returnflag as qualities from lineitem""",
)
def parallel_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = wire.derived_measurement_messages(spark, sf_dir)
    records = expand(decode(messages, C.DERIVED_MEASUREMENT.message))
    arrays = project.parallel_arrays(
        records, "consumptionDataPoints", {"point_values": "value", "qualities": "quality"}
    )
    return arrays.select(
        "device",
        F.array_join("point_values", ",").alias("point_values"),
        F.array_join("qualities", ",").alias("qualities"),
    )


@query(
    "element_columns",
    """
    select 'O' || l_orderkey as device, childdevice as "childDevice", l_shipdate as "addTime",
           datasource as "dataSource"
    from (select *, unnest(['P' || l_partkey, 'S' || l_suppkey]) as childdevice,
                 unnest(['part', 'supplier']) as datasource from lineitem)""",
)
def element_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = expand(decode(wire.topology_messages(spark, sf_dir), C.TOPOLOGY.message))
    exploded = project.explode_rows(records.select("device", "children"), "children", into="child")
    return project.element_columns(exploded.drop("children"), "child")


@query(
    "lowercase_columns",
    "select 'D' || user_id as device, ts as lastreceivetime from events",
)
def lowercase_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = expand(decode(wire.telemetry_messages(spark, sf_dir), C.TELEMETRY.message))
    return project.lower_names(records.select("device", "lastReceiveTime"))


@query(
    "rename_columns",
    """select 'D' || user_id as device, event_type as profile, ts - INTERVAL 1 DAY as from_time, ts as to_time
       from events""",
)
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = expand(decode(wire.profile_facts_messages(spark, sf_dir), C.PROFILE_FACTS.message))
    picked = records.select("device", "profile", "from", "to")
    return project.rename(picked, {"from": "from_time", "to": "to_time"})


@query(
    "drop_columns",
    "select 'D' || user_id as device, event_type as event, ts as receivetime from events",
)
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    unwanted = set(C.EVENT.table.columns) - {"device", "event", "receivetime"}
    return project.drop(feeds.events(wire.event_messages(spark, sf_dir)), *sorted(unwanted))


@query(
    "drop_nested_field",
    """select 'O' || l_orderkey as device, childdevice as "childDevice", datasource as "dataSource"
       from (select *, unnest(['P' || l_partkey, 'S' || l_suppkey]) as childdevice,
                    unnest(['part', 'supplier']) as datasource from lineitem)""",
)
def drop_nested_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = expand(decode(wire.topology_messages(spark, sf_dir), C.TOPOLOGY.message))
    exploded = project.explode_rows(records.select("device", "children"), "children", into="child")
    return project.element_columns(project.drop(exploded, "child.addTime", "children"), "child")


@query("split_change_record", METERING_POINT_ROWS)
def split_change_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = expand(decode(wire.metering_point_messages(spark, sf_dir), C.METERING_POINT.message))
    sides = project.split_change(records, C.METERING_POINT_FIELDS, keep=["persistTime"])
    sides = project.lower_names(sides)
    sides = sides.withColumn("meteringpoint", F.coalesce("current_meteringpoint", "previous_meteringpoint"))
    return conform(sides, C.METERING_POINT.table)


# Readings as text in which some are not numbers.
_TEXT = "case when event_type = 'error' then 'bad' when event_type = 'view' then {k} || 'E+2' else {k} end"


@query(
    "try_cast_bad_text",
    """
    select event_id, case when event_type = 'view' then k * 100 when event_type <> 'error' then k end as number,
           cast(case when event_type = 'view' then k * 100 when event_type <> 'error' then k end as float) as reading
    from (select *, cast(json_extract(props, '$.k') as double) as k from events)""",
)
def try_cast_bad_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = wire.source(spark, sf_dir, "events")
    text = F.expr(_TEXT.format(k="get_json_object(props, '$.k')"))
    return events.select("event_id", to_number(text).alias("number"), to_float(text).alias("reading"))


@query(
    "try_timestamp",
    """
    select event_id, case event_type when 'error' then null when 'view' then date_trunc('second', ts)
                     when 'click' then date_trunc('millisecond', ts) else ts end as instant,
           case event_type when 'error' then null when 'view' then date_trunc('second', ts)
                     when 'click' then date_trunc('millisecond', ts) end as patterned
    from events""",
)
def try_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants as text with no, three and six fraction digits, and text that is none; with and without pattern."""
    events = wire.source(spark, sf_dir, "events")
    text = F.expr(
        """case event_type when 'error' then 'not a time'
           when 'view' then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
           when 'click' then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
           else date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") end"""
    )
    return events.select(
        "event_id",
        to_instant(text).alias("instant"),
        to_instant(text, "yyyy-MM-dd'T'HH:mm:ss[.SSS]X").alias("patterned"),
    )


@query(
    "conform_contract",
    """
    select 'D' || user_id as device, try_cast(case when event_type = 'view' then json_extract_string(props, '$.k')
           else event_type end as integer) as event, ts as receivetime,
           case when event_type = 'view' then null else 'event is not int' end as error
    from events""",
)
def conform_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier event table stores the event as a number: text that is none is reported, not written."""
    table = C.earlier_table("dev_event")
    rows = feeds.events(wire.event_messages(spark, sf_dir)).drop("current_date")
    coded = F.when(F.col("event") == "view", F.col("occurrencecount").cast("string")).otherwise(F.col("event"))
    fitted = conform(rows.withColumn("event", coded), table, key=["device"], errors=True)
    return fitted.select("device", "event", "receivetime", F.col(ERROR).alias("error"))
