"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; it runs on a UTC session of its own and returns instants as zone-less timestamps."""

    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(build(utc_session(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def utc_session(spark: SparkSession) -> SparkSession:
    """A session with the caller's settings but UTC; the caller's own session stays as it is."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


def zoneless(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[
            F.col(f"`{field.name}`").cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(f"`{field.name}`")
            for field in rows.schema.fields
        ]
    )
