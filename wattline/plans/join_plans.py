"""Batch joins of feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import contracts as C
from wattline import feeds
from wattline.operators import joins, keyed
from wattline.operators.conform import conform
from wattline.operators.decode import decode, expand, needed
from wattline.plans import wire
from wattline.plans.registry import query
from wattline.streaming.storage import run_dir

VERSIONS = 3  # of each device, nine days apart
DEVICE_SIDE = """
    select 'D' || c_custkey as device,
           timestamp '2024-01-01' + to_days(9 * version) + to_seconds(c_custkey) as persisttime,
           c_mktsegment as type, 'unknown' as inventorystate,
           case when c_acctbal < 0 then 'suspended' else 'registered' end as managementstate,
           cast(c_custkey as varchar) as communicationid,
           case when c_acctbal >= 1000 then 'M' || c_nationkey when c_acctbal >= 0 then '' end as manufacturer
    from (select *, unnest([0, 1, 2]) as version from customer)
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
TELEMETRY_SIDE = "select 'D' || user_id as device, ts as last_telemetry from events"
JOINED = f"select * from ({DEVICE_SIDE}) join ({TELEMETRY_SIDE}) using (device)"


@query("join_inner_device_telemetry", JOINED)
def join_inner_device_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = feeds.device_for_join(wire.device_messages(spark, sf_dir, versions=VERSIONS))
    telemetry = feeds.telemetry_for_join(wire.telemetry_messages(spark, sf_dir))
    return conform(joins.join_versions(devices, telemetry, "device"), C.DEVICE_TELEMETRY)


@query(
    "join_last_telemetry",
    f"""select * from ({DEVICE_SIDE}) left join
        (select device, max(last_telemetry) as last_telemetry from ({TELEMETRY_SIDE}) group by device)
        using (device)""",
)
def join_last_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every device with its last telemetry only: the latest view per device, then a one-to-one join."""
    devices = feeds.device_for_join(wire.device_messages(spark, sf_dir, versions=VERSIONS))
    telemetry = feeds.telemetry_for_join(wire.telemetry_messages(spark, sf_dir))
    last = keyed.latest_row(telemetry, ["device"], ["last_telemetry"])
    return joins.join_state(devices, last, "device", how="left")


_CHANGED = "o_orderdate + INTERVAL 1 DAY + to_seconds(o_orderkey % 86400)"


@query(
    "join_full_outer",
    f"""
    select * from (select {_CHANGED} as persisttime, 'M' || o_custkey as meteringpoint, 'before' as previous_group
                   from orders where o_orderstatus <> 'O')
    full join (select {_CHANGED} as persisttime, 'M' || o_custkey as meteringpoint,
                      o_orderpriority as current_group from orders where o_orderstatus <> 'F')
    using (persisttime, meteringpoint)""",
)
def join_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previous images (none for open orders) with current images of unfinished orders, by point and time.

    Both sides come from one decode, written once: the join reads each side several times.
    """
    point = C.METERING_POINT
    paths = [f"{side}.{field}" for side in ("previous", "current") for field in ("meteringPoint", "group")]
    schema = needed(point.message, ["persistTime", "current.devices.device", *paths])
    records = expand(decode(wire.metering_point_messages(spark, sf_dir), schema))
    sides = run_dir(spark, "metering-point-sides")
    records.select(
        F.col("persistTime").alias("persisttime"),
        F.col("previous.meteringPoint").alias("previous_point"),
        F.col("previous.group").alias("previous_group"),
        F.when(F.size("current.devices") == 1, F.col("current.meteringPoint")).alias("current_point"),
        F.col("current.group").alias("current_group"),
    ).write.parquet(sides)

    def side(name: str) -> DataFrame:
        rows = spark.read.parquet(sides).filter(F.col(f"{name}_point").isNotNull())
        return rows.select("persisttime", F.col(f"{name}_point").alias("meteringpoint"), f"{name}_group")

    return joins.full_outer(side("previous"), side("current"), ["persisttime", "meteringpoint"], hot_keys=True)
