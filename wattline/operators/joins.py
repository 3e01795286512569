"""Joins of feeds: device versions with telemetry, and the two sides of change records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_versions(versions: DataFrame, readings: DataFrame, on: str, *, salts: int = 1) -> DataFrame:
    """Inner equi-join that emits every (version, reading) pair of a key; null keys never match.

    On two streams without watermarks the join state is unbounded: use ``join_versions_within`` unless that is
    wanted. ``salts`` splits each key's readings over that many partitions and copies the (few) versions to all
    of them, for keys too large for one task. A stream join needs it, since it cannot split a hot key at run time;
    a batch join is split by adaptive execution.
    """
    versions, readings, keys = _salted(versions, readings, on, salts)
    return versions.join(readings, keys).drop("_salt")


def join_versions_within(
    versions: DataFrame,
    readings: DataFrame,
    on: str,
    *,
    version_time: str,
    reading_time: str,
    within: str,
    lateness: str,
    salts: int = 1,
    how: str = "inner",
) -> DataFrame:
    """``join_versions`` for readings at most ``within`` after their version.

    Both sides carry a watermark of ``lateness``, so the state holds only rows that can still match. With ``how="left"``
    a version without a reading comes once, when the watermark has passed the last instant at which one could match; on
    a stream that takes a session with idle batches. A version must then be in one place only, so ``salts`` spreads the
    versions of a key and copies its readings, which costs their state that many times over: keep them few.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a join of versions within a time is inner or left, not {how!r}")
    versions = versions.withWatermark(version_time, lateness)
    readings = readings.withWatermark(reading_time, lateness)
    if how == "left":
        readings, versions, keys = _salted(readings, versions, on, salts)
    else:
        versions, readings, keys = _salted(versions, readings, on, salts)
    left, right = versions.alias("v"), readings.alias("r")
    start, at = F.col(f"v.{version_time}"), F.col(f"r.{reading_time}")
    same = [F.col(f"v.{name}") == F.col(f"r.{name}") for name in keys]
    in_time = (at >= start) & (at <= start + F.expr(f"interval {within}"))
    joined = left.join(right, reduce(Column.__and__, same) & in_time, how)
    return joined.select(
        *[F.col(f"v.{name}") for name in versions.columns if name != "_salt"],
        *[F.col(f"r.{name}") for name in readings.columns if name not in keys],
    )


def join_state(readings: DataFrame, state: DataFrame, on: str, *, how: str = "inner") -> DataFrame:
    """Readings (batch or stream) with the columns of a static one-row-per-key state table.

    No stream state. The state side is broadcast only if Spark finds it under its size limit; beyond that it is
    a shuffled join, which adaptive execution splits at hot keys (in a batch, so inside ``foreachBatch``).
    """
    return readings.join(state, on, how)


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[str], *, hot_keys: bool = False) -> DataFrame:
    """Batch full outer equi-join with the key coalesced; rows with a null key are kept and match nothing.

    Adaptive execution cannot split a hot key of a full outer join. With ``hot_keys`` it is a left join and, for the
    right rows without a partner, an anti join, which it can split; null keys, which would all meet in one task, take
    no part. Each side is then read twice: give it stored tables.
    """
    on = list(on)
    if not hot_keys:
        return left.join(right, on, "full")
    complete = reduce(Column.__and__, [F.col(name).isNotNull() for name in on])
    partners = left.filter(complete).select(*on).distinct()
    joined = left.join(right.filter(complete), on, "left")
    alone = right.filter(complete).join(partners, on, "left_anti").unionByName(right.filter(~complete))
    return joined.unionByName(alone, allowMissingColumns=True)


def _salted(
    versions: DataFrame, readings: DataFrame, on: str, salts: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    if salts <= 1:
        return versions, readings, [on]
    spread = [name for name in readings.columns if name != on]
    readings = readings.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    versions = versions.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return versions, readings, [on, "_salt"]
