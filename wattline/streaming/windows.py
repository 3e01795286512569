"""Event-time state on streams: window counts, redeliveries, and rows that come too late for either.

Watermarks bound the state: a window is written once and then forgotten, a key is remembered while its duplicate may come.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def window_counts(
    rows: DataFrame, time: str, by: Sequence[str], *, width: str = "1 hour", lateness: str = "1 hour", sums: Sequence[str] = ()
) -> DataFrame:
    """Rows per window and ``by``: ``window_start, *by, n, first_time, last_time`` and ``sum_…`` of the named columns.

    On a stream in append mode a window is emitted once, when the watermark, the latest time seen less ``lateness``, has
    passed its end; its state goes then. Rows later than that are counted by the query (``dropped_late``). Partial counts
    combine before the shuffle, so a hot group costs one row per task. Rows without a time belong to no window. In batch
    all windows are returned.
    """
    totals = [F.sum(name).alias(f"sum_{name}") for name in sums]
    counted = (
        rows.where(F.col(time).isNotNull())
        .withWatermark(time, lateness)
        .groupBy(F.window(time, width).alias("window"), *by)
        .agg(F.count("*").alias("n"), F.min(time).alias("first_time"), F.max(time).alias("last_time"), *totals)
    )
    names = [total for total in counted.columns if total not in ("window", *by)]
    return counted.select(F.col("window.start").alias("window_start"), *by, *names)


def without_redeliveries(rows: DataFrame, key: Sequence[str], time: str, *, within: str = "1 day") -> DataFrame:
    """The first row of each key among those that come within a time of it; others are redeliveries.

    A key is kept until the watermark is ``within`` past its first row, so the state is that of one such span. A row is
    emitted at once. Keys hold nulls as values.
    """
    return rows.withWatermark(time, within).dropDuplicatesWithinWatermark(list(key))


def progress(queries: Iterable[StreamingQuery]) -> list[dict]:
    """Per finished micro-batch with state: rows in, rows in state, rows dropped as late."""
    out = []
    for query in queries:
        for one in query.recentProgress:
            for state in one["stateOperators"]:
                out.append(
                    {
                        "query": query.name,
                        "batch_id": one["batchId"],
                        "rows_in": one["numInputRows"],
                        "rows_in_state": state["numRowsTotal"],
                        "dropped_late": state["numRowsDroppedByWatermark"],
                    }
                )
    return out
