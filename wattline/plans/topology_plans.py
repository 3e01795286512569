"""Topology below and above a device, and what was installed where at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline import feeds
from wattline.operators import closure, intervals
from wattline.plans import wire
from wattline.plans.feed_plans import METERING_POINT_DEVICE_ROWS
from wattline.plans.registry import query

# A binary tree of parts, rings of suppliers, one device above all orders, and parts shared by orders.
_ALL_LINKS = """
    select distinct p as parent, c as child from (
        select 'P' || (l_partkey // 2) as p, 'P' || l_partkey as c from lineitem
        union all select 'S' || l_suppkey, 'S' || (l_suppkey // 7 * 7 + (l_suppkey + 1) % 7) from lineitem
        union all select 'H', 'O' || l_orderkey from lineitem
        union all select 'O' || l_orderkey, 'P' || l_partkey from lineitem)"""

_PAIRS = f"""
    with recursive every as ({_ALL_LINKS}), links as (select * from every where parent <> child),
    down as (select parent as ancestor, child as descendant, 1 as depth from links
             union select ancestor, child, depth + 1 from down join links on descendant = parent
             where depth < 64 and ancestor <> child)"""


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.topology(wire.tree_messages(spark, sf_dir), only=("device", "childdevice"))


@query(
    "topology_descendants",
    f"{_PAIRS} select ancestor, descendant, min(depth) as depth from down where ancestor <> descendant group by all",
)
def topology_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every device below every other, and how many links down."""
    return closure.descendants(_links(spark, sf_dir))


@query(
    "topology_cycles",
    f"""{_PAIRS} select parent as device, child as childdevice from links
        where exists (select 1 from down where ancestor = child and descendant = parent)
        union all select * from every where parent = child""",
)
def topology_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links that lie on a ring, or lead from a device to itself, which a topology should not have."""
    links = closure.stored_links(_links(spark, sf_dir))
    return closure.in_cycles(links, closure.descendants(closure.ring_candidates(links)))


@query(
    "device_at_time",
    f"""
    select cast(o_orderkey % 2147483647 as integer) as id, device, o_orderdate as inittime, meteringpoint, assigntime,
           removetime
    from orders join ({METERING_POINT_DEVICE_ROWS}) on device = 'D' || o_custkey and assigntime <= o_orderdate
         and (removetime is null or o_orderdate < removetime)""",
)
def device_at_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the device of each process was installed when the process began: open and overlapping assignments."""
    processes = feeds.process(wire.process_messages(spark, sf_dir)).select(
        "id", F.concat(F.lit("D"), F.expr("substring(device, 2)")).alias("device"), "inittime"
    )
    assigned = feeds.metering_point_devices(wire.metering_point_messages(spark, sf_dir)).select(
        "device", "meteringpoint", "assigntime", "removetime"
    )
    return intervals.at_time(
        processes, assigned, "device", "inittime", "assigntime", "removetime", finest=86_400, salts=2
    )
