"""Runnable queries over the given tables, each with the SQL that states its result."""

from wattline.plans import (  # noqa: F401
    coverage_plans,
    feed_plans,
    join_plans,
    operator_plans,
    stream_plans,
    table_plans,
    topology_plans,
    window_plans,
)
from wattline.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
