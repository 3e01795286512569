"""Feed messages made from the given tables.

The tables are not meter data, so each row (never a group of rows) is encoded as one JSON message of a feed;
the operators under test then decode it. Repeated groups come from several columns of the row, so messages are
bounded and encoding needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import contracts as C
from wattline.sources import envelope_columns
from wattline.streaming.storage import size

# Instants with all six fraction digits; the default would cut them to milliseconds.
_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"}


#: Bytes of a table's files that a task makes messages of.
SOURCE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table to make messages of, dealt out by a hash of near-unique columns as a producer would to its topic's
    partitions: a table in one file is one task however many cores there are.

    A task gets at most about ``SOURCE_BYTES`` of a table's files. Left to itself, adaptive execution sizes tasks by the
    narrow rows here, not by the many wider ones that messages unfold to.
    """
    parts = -(-size(spark, f"{sf_dir}/{name}.parquet") // SOURCE_BYTES)
    spread = [parts] if parts > spark.sparkContext.defaultParallelism else []
    return table(spark, sf_dir, name).repartition(*spread, *_SPREAD[name])


def obj(fields: Mapping[str, Column]) -> Column:
    return F.struct(*[column.alias(name) for name, column in fields.items()])


def json(fields: Mapping[str, Column]) -> Column:
    return F.to_json(obj(fields), _JSON)


def instant(of: Column) -> Column:
    """A time without zone as the text that ``json`` makes of it; as queries do, on a UTC session."""
    return F.date_format(of, _JSON["timestampNTZFormat"])


def coded(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def after(column: str, amount: str) -> Column:
    return F.col(column) + F.expr(f"interval {amount}")


def small_id(column: str) -> Column:
    """A table key as the 32-bit id the feeds carry."""
    return (F.col(column) % 2147483647).cast("int")


_SPREAD = {
    "customer": ["c_custkey"],
    "documents": ["doc_id"],
    "events": ["event_id"],
    "lineitem": ["l_shipdate", "l_partkey", "l_linenumber"],
    "orders": ["o_orderkey"],
}

_K = F.get_json_object
_CHANGED = "o_orderdate + make_dt_interval(1, 0, 0, o_orderkey % 86400)"


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "events")
    value = json(
        {
            "device": coded("D", "user_id"),
            "event": F.col("event_type"),
            "firstOccurrenceTime": F.col("ts"),
            "lastOccurrenceTime": after("ts", "30 minutes"),
            "occurrenceCount": _K("props", "$.k").cast("int"),
            "receiveTime": F.col("ts"),
            "persistTime": after("ts", "1 hour"),
            "state": F.when(F.col("value") >= 20, F.lit("open")).when(F.col("value") >= 10, F.lit("closed")),
            "context": F.from_json("props", "k int"),
        }
    )
    return _events_envelope(rows, value, C.EVENT.topic)


def drifted_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a producer that has moved on: fields that nobody declared, one of another type, others no longer sent."""
    rows = source(spark, sf_dir, "events")
    firmware = {"major": F.col("user_id") % 5, "build": F.when(F.col("value") >= 20, F.col("event_type"))}
    value = json(
        {
            "device": coded("D", "user_id"),
            "event": F.col("event_type"),
            "occurrenceCount": F.from_json("props", "k int"),
            "receiveTime": F.col("ts"),
            "context": F.from_json("props", "k int"),
            "firmware": obj(firmware),
            "tags": F.array(obj({"name": F.col("event_type")})),
        }
    )
    return _events_envelope(rows, value, C.EVENT.topic)


def telemetry_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "events")
    value = json({"device": coded("D", "user_id"), "lastReceiveTime": F.col("ts")})
    return _events_envelope(rows, value, C.TELEMETRY.topic)


def parameter_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "events")
    value = json(
        {
            "device": coded("D", "user_id"),
            "parameter": F.col("event_type"),
            "changeTime": F.col("ts"),
            "receiveTime": after("ts", "5 seconds"),
            "persistTime": after("ts", "6 seconds"),
            "newValue": _K("props", "$.k"),
            "oldValue": F.lit(""),
        }
    )
    return _events_envelope(rows, value, C.PARAMETER.topic)


def profile_facts_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "events")
    value = json(
        {
            "device": coded("D", "user_id"),
            "profile": F.col("event_type"),
            "gatheredAt": F.col("ts"),
            "actual": F.col("value"),
            "expected": F.lit(24),
            "completeness": F.when(F.col("value") > 20, "NaN").otherwise("1"),
            "from": after("ts", "-1 day"),
            "to": F.col("ts"),
        }
    )
    return _events_envelope(rows, value, C.PROFILE_FACTS.topic)


def _events_envelope(rows: DataFrame, value: Column, topic: str) -> DataFrame:
    return envelope_columns(
        rows, value, topic=topic, key=coded("D", "user_id"), offset=F.col("event_id"), at=F.col("ts")
    )


def device_messages(spark: SparkSession, sf_dir: str, *, versions: int = 1) -> DataFrame:
    """``versions`` gives each device so many versions, nine days apart."""
    rows = (
        source(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    rows = rows.withColumn("_version", F.explode(F.sequence(F.lit(0), F.lit(versions - 1))))
    persisted = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(9 * _version, 0, 0, c_custkey)")
    geo = obj({"latitude": _text("c_nationkey", ".5"), "longitude": _text("r_regionkey", ".25")})
    address = obj(
        {
            "city": F.col("n_name"), "postalCode": _text("c_custkey"), "street": F.lit(None).cast("string"),
            "houseNumber": _text("c_nationkey"), "floor": F.lit(""), "company": F.col("c_mktsegment"),
            "country": F.col("r_name"), "reference": F.lit(""), "timeZone": F.lit("UTC"),
            "region": F.col("r_name"), "district": F.col("n_name"),
        }
    )
    value = json(
        {
            "persistTime": persisted,
            "current": obj(
                {
                    "device": coded("D", "c_custkey"),
                    "type": F.col("c_mktsegment"),
                    "group": F.col("n_name"),
                    "inventoryState": F.lit("unknown"),
                    "managementState": F.when(F.col("c_acctbal") < 0, "suspended").otherwise("registered"),
                    "communicationId": _text("c_custkey"),
                    "manufacturer": F.when(F.col("c_acctbal") >= 1000, coded("M", "c_nationkey")).when(
                        F.col("c_acctbal") >= 0, ""
                    ),
                    "description": F.lit(""),
                    "model": F.col("c_name"),
                    "location": obj(
                        {"geo": geo, "address": address, "logicalInstallationPoint": F.col("c_name")}
                    ),
                    "tags": F.array("c_mktsegment"),
                }
            ),
        }
    )
    return envelope_columns(
        rows,
        value,
        topic=C.DEVICE.topic,
        key=coded("D", "c_custkey"),
        offset=F.col("c_custkey") * versions + F.col("_version"),
        at=persisted,
    )


def measurement_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "lineitem")
    received = F.expr("l_shipdate + make_dt_interval(0, 0, l_linenumber, 0)")
    points = [
        obj(
            {
                "register": F.lit(register), "value": F.col(column).cast("string"), "unit": F.lit(unit),
                "measureTime": F.col("l_shipdate"),
            }
        )
        for register, column, unit in (
            ("quantity", "l_quantity", "kWh"),
            ("price", "l_extendedprice", "kVAh"),
            ("discount", "l_discount", "V"),
            ("tax", "l_tax", "A"),
        )
    ]
    value = json(
        {
            "device": coded("P", "l_partkey"),
            "measureTime": F.col("l_shipdate"),
            "receiveTime": received,
            "persistTime": received + F.expr("interval 1 second"),
            "readingReason": F.col("l_returnflag"),
            "dataPoints": F.array(*points),
            "status": F.array("l_linestatus"),
            "profile": F.col("l_linestatus"),
        }
    )
    return _lineitem_envelope(rows, value, C.MEASUREMENT.topic, coded("P", "l_partkey"))


def register_statistic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "lineitem")
    reads = {
        "expected": F.lit(24), "received": F.col("l_quantity").cast("int"), "edited": F.col("l_linenumber"),
        "invalidated": F.when(F.col("l_returnflag") == "R", F.col("l_linenumber")),
        "estimated": F.col("l_linenumber") % 2,
    }
    delay = {
        "minimum": F.col("l_linenumber"), "maximum": F.col("l_quantity").cast("int"),
        "average": F.col("l_discount"),
    }
    value = json(
        {
            "device": coded("P", "l_partkey"),
            "register": coded("R", "l_suppkey"),
            "date": F.to_date("l_shipdate"),
            "meterReads": obj(reads),
            "deliveryDelay": obj(delay),
        }
    )
    return _lineitem_envelope(rows, value, C.REGISTER_STATISTIC.topic, coded("P", "l_partkey"))


def topology_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "lineitem")
    children = [
        obj({"childDevice": child, "addTime": F.col("l_shipdate"), "dataSource": F.lit(origin)})
        for child, origin in ((coded("P", "l_partkey"), "part"), (coded("S", "l_suppkey"), "supplier"))
    ]
    value = json(
        {
            "device": coded("O", "l_orderkey"),
            "receiveTime": F.col("l_shipdate"),
            "persistTime": after("l_shipdate", "1 second"),
            "children": F.array(*children),
        }
    )
    return _lineitem_envelope(rows, value, C.TOPOLOGY.topic, coded("O", "l_orderkey"))


def tree_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topology of several levels: a link per message, four made of each row.

    Parts are a binary tree, suppliers rings of up to seven, ``H`` lies above all orders and orders above their parts.
    """
    rows = source(spark, sf_dir, "lineitem")

    def link(parent: str, child: str) -> Column:
        return F.struct(F.expr(parent).alias("parent"), F.expr(child).alias("child"))

    links = F.array(
        link("concat('P', l_partkey div 2)", "concat('P', l_partkey)"),
        link("concat('S', l_suppkey)", "concat('S', l_suppkey div 7 * 7 + (l_suppkey + 1) % 7)"),
        link("'H'", "concat('O', l_orderkey)"),
        link("concat('O', l_orderkey)", "concat('P', l_partkey)"),
    )
    # Times are made text once a row, not once for each of its messages and fields.
    rows = rows.withColumns({"_at": instant(F.col("l_shipdate")), "_after": instant(after("l_shipdate", "1 second"))})
    each = rows.select("*", F.inline(links))
    children = F.array(obj({"childDevice": F.col("child"), "addTime": F.col("_at"), "dataSource": F.lit("tree")}))
    value = json(
        {
            "device": F.col("parent"),
            "receiveTime": F.col("_at"),
            "persistTime": F.col("_after"),
            "children": children,
        }
    )
    return _lineitem_envelope(each, value, C.TOPOLOGY.topic, F.col("parent"))


def derived_measurement_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "lineitem")
    points = [
        obj({"time": after("l_shipdate", f"{hour} hours"), "value": value, "quality": F.col("l_returnflag")})
        for hour, value in enumerate(
            (F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber").cast("string"), F.lit("n/a"))
        )
    ]
    value = json(
        {
            "device": coded("S", "l_suppkey"),
            "register": coded("P", "l_partkey"),
            "persistTime": after("l_shipdate", "1 day"),
            "unit": F.lit("1"),
            "consumptionDataPoints": F.array(*points),
        }
    )
    return _lineitem_envelope(rows, value, C.DERIVED_MEASUREMENT.topic, coded("S", "l_suppkey"))


def _lineitem_envelope(rows: DataFrame, value: Column, topic: str, key: Column) -> DataFrame:
    offset = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return envelope_columns(rows, value, topic=topic, key=key, offset=offset, at=F.col("l_shipdate"))


def process_messages(
    spark: SparkSession, sf_dir: str, *, text_times: bool = False
) -> DataFrame:
    """``text_times`` puts text that is no instant into the start time of orders in progress."""
    rows = source(spark, sf_dir, "orders")
    started = after("o_orderdate", "1 hour")
    if text_times:
        started = F.when(F.col("o_orderstatus") == "P", "not yet").otherwise(
            F.date_format(started, "yyyy-MM-dd'T'HH:mm:ss'Z'")
        )
    read = {"profileId": F.col("o_orderpriority"), "readingReasonCode": F.lit("1")}
    parameters = {
        "profileRead": obj(read),
        "registerRead": F.when(F.col("o_orderstatus") == "F", obj(read)),
    }
    value = json(
        {
            "id": small_id("o_orderkey"),
            "type": F.col("o_orderpriority"),
            "device": coded("C", "o_custkey"),
            "persistTime": F.expr(_CHANGED),
            "initTime": F.col("o_orderdate"),
            "startTime": started,
            "previous": obj({"status": F.lit("executing")}),
            "current": obj(
                {
                    "status": F.col("o_orderstatus"),
                    "error": F.when(F.col("o_orderstatus") == "F", coded("failed: ", "o_orderpriority")),
                }
            ),
            "completionTime": F.when(F.col("o_orderstatus") != "O", after("o_orderdate", "1 day")),
            "executionType": F.lit("recurring"),
            "parameters": F.when(F.col("o_orderstatus") != "P", obj(parameters)),
        }
    )
    return _orders_envelope(rows, value, C.PROCESS.topic)


def operational_process_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "orders")
    value = json(
        {
            "id": small_id("o_orderkey"),
            "type": F.col("o_orderpriority"),
            "persistTime": F.expr(_CHANGED),
            "current": obj({"status": F.col("o_orderstatus")}),
        }
    )
    return _orders_envelope(rows, value, C.OPERATIONAL_PROCESS.topic)


def metering_point_json(rows: DataFrame) -> Column:
    """A change record per order: no previous image while it is open, a replaced device once it is finished; every
    fifth finished one is a deletion, without a current image."""
    finished = F.col("o_orderstatus") == "F"
    deleted = finished & (F.col("o_orderkey") % 5 == 0)
    replaced = after("o_orderdate", "30 days")
    never = F.lit(None).cast("timestamp_ntz")

    def assigned(prefix: str, column: str, start: Column, end: Column) -> Column:
        return obj({"device": coded(prefix, column), "assignTime": start, "removeTime": end})

    def image(devices: Column, group: Column) -> Column:
        return obj(
            {
                "meteringPoint": coded("M", "o_custkey"),
                "group": group,
                "serviceLevel": F.lit(""),
                "devices": devices,
                "stateHistory": F.array(obj({"state": F.lit("connected"), "activeSince": F.col("o_orderdate")})),
                "location": obj(
                    {
                        "geo": obj({"latitude": F.lit("22.5"), "longitude": _text("o_custkey", ".25")}),
                        "address": obj({"city": coded("City ", "o_custkey"), "country": F.lit("")}),
                    }
                ),
            }
        )

    first = assigned("D", "o_custkey", F.col("o_orderdate"), never)
    now = F.filter(
        F.array(
            assigned("D", "o_custkey", F.col("o_orderdate"), F.when(finished, replaced)),
            F.when(finished, assigned("N", "o_orderkey", replaced, never)),
        ),
        lambda device: device.isNotNull(),
    )
    return json(
        {
            "persistTime": F.expr(_CHANGED),
            "previous": F.when(F.col("o_orderstatus") != "O", image(F.array(first), F.lit("before"))),
            "current": F.when(~deleted, image(now, F.col("o_orderpriority"))),
        }
    )


def metering_point_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir, "orders")
    return _orders_envelope(rows, metering_point_json(rows), C.METERING_POINT.topic)


def _orders_envelope(rows: DataFrame, value: Column, topic: str) -> DataFrame:
    return envelope_columns(
        rows, value, topic=topic, key=coded("C", "o_custkey"), offset=F.col("o_orderkey"), at=F.col("o_orderdate")
    )


def text_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts as payloads: well-formed envelopes around what is not JSON."""
    rows = source(spark, sf_dir, "documents")
    return envelope_columns(
        rows,
        F.col("text"),
        topic="documents",
        key=F.col("source"),
        offset=F.col("doc_id"),
        at=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
    )


def _text(column: str, suffix: str = "") -> Column:
    return F.concat(F.col(column).cast("string"), F.lit(suffix))
