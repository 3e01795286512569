"""What is missing: the stretches of time that a key's intervals leave uncovered."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def missing_intervals(
    rows: DataFrame,
    by: Sequence[str],
    start: str,
    end: str,
    *,
    since: datetime | None = None,
    until: datetime | None = None,
    expected: DataFrame | None = None,
    bin_days: int = 30,
) -> DataFrame:
    """Per key the longest stretches ``gap_start`` to ``gap_end`` that no interval ``[start, end)`` covers.

    ``since`` and ``until`` bound the calendar that every key should fill; without them a key's own first and last
    instants do. ``expected`` lists keys that should report: one without any interval misses the whole calendar, so it
    needs both bounds. Overlapping, nested, touching and repeated intervals are one stretch; an interval without a
    start, an end or a length covers nothing, and null keys are a key of their own.

    A key's intervals are cut into bins of ``bin_days`` by their start, so a hot key is many tasks' work: what earlier
    bins cover reaches a bin as one instant, found from one row per key and bin.
    """
    if expected is not None and (since is None or until is None):
        raise ValueError("expected keys need a calendar: give since and until")
    if since is not None and until is not None and since >= until:
        raise ValueError("the calendar ends before it starts")
    names = [f"k{i}" for i in range(len(by))]
    lower, upper = F.lit(since).cast("timestamp"), F.lit(until).cast("timestamp")
    begin, stop = F.col(f"`{start}`").cast("timestamp"), F.col(f"`{end}`").cast("timestamp")
    keys = [F.col(f"`{name}`").alias(own) for name, own in zip(by, names)]
    covered = rows.where(begin < stop).select(
        *keys,
        (F.greatest(begin, lower) if since else begin).alias("s"),
        (F.least(stop, upper) if until else stop).alias("e"),
    )
    covered = covered.where("s < e").groupBy(*names, "s").agg(F.max("e").alias("e"))
    binned = covered.withColumn("bin", F.floor(F.unix_timestamp("s") / F.lit(86_400 * bin_days)))
    ends = binned.groupBy(*names, "bin").agg(F.max("e").alias("last"))
    before = Window.partitionBy(*names).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*names, "bin", "last", F.max("last").over(before).alias("reached"))
    ends = ends.select(*[F.col(name).alias(f"o_{name}") for name in names], F.col("bin").alias("o_bin"), "reached")
    same = F.col("bin") == F.col("o_bin")
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"o_{name}"))
    inside = Window.partitionBy(*names, "bin").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("reached"), F.max("e").over(inside))
    steps = binned.join(ends, same, "left").select(*names, "s", reached.alias("reached"))
    found = steps.select(*names, F.coalesce("reached", lower).alias("gap_start"), F.col("s").alias("gap_end"))
    if until is not None:
        tail = covered.groupBy(*names).agg(F.max("e").alias("gap_start"))
        found = found.unionByName(tail.withColumn("gap_end", upper))
    found = found.where("gap_start < gap_end")
    if expected is not None:
        silent = expected.select(*keys).distinct()
        seen = covered.select(*[F.col(name).alias(f"o_{name}") for name in names]).distinct()
        match = F.lit(True)
        for name in names:
            match = match & F.col(name).eqNullSafe(F.col(f"o_{name}"))
        silent = silent.join(seen, match, "left_anti")
        found = found.unionByName(silent.select(*names, lower.alias("gap_start"), upper.alias("gap_end")))
    return found.select(*[F.col(own).alias(name) for name, own in zip(by, names)], "gap_start", "gap_end")


def completeness(gaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per key with gaps: how many, how many microseconds are missing in all, and in the longest of them."""
    micros = F.unix_micros("gap_end") - F.unix_micros("gap_start")
    return gaps.groupBy(*by).agg(
        F.count("*").alias("gaps"), F.sum(micros).alias("missing_micros"), F.max(micros).alias("longest_micros")
    )
