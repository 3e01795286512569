"""Where rows go: rows lost to a table's key, and stage-by-stage counts of a feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline import feeds
from wattline.contracts import Feed
from wattline.operators.decode import ERROR


def key_collisions(rows: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per named key: rows in, rows a table with this key keeps, rows it loses, and the largest single collision.

    All keys are counted in one pass over the rows, each task reducing its rows to one per key before the shuffle.
    """
    columns = list(dict.fromkeys(name for key in keys.values() for name in key))
    sets = list(dict.fromkeys(tuple(sorted(key, key=columns.index)) for key in keys.values()))
    groups = (
        rows.select(*columns)
        .groupingSets([list(key) for key in sets], *columns)
        .agg(F.count("*").alias("_n"), F.grouping_id().alias("_set"))
    )
    counted = groups.agg(
        *[_collisions(_set_id(columns, key)).alias(name) for name, key in keys.items()],
    )
    measures = ("rows_in", "rows_kept", "rows_lost", "largest_collision")
    report = [
        F.struct(F.lit(name).alias("table"), *[F.col(f"`{name}`.{measure}") for measure in measures])
        for name in keys
    ]
    return counted.select(F.inline(F.array(*report)))


def _set_id(columns: Sequence[str], key: Sequence[str]) -> int:
    """Spark's ``grouping_id`` of a grouping set: a bit per column, set where the column is not in the set."""
    return sum(1 << place for place, name in enumerate(reversed(columns)) if name not in key)


def _collisions(set_id: int) -> Column:
    n = F.when(F.col("_set") == set_id, F.col("_n"))
    zero = F.lit(0).cast("bigint")
    return F.struct(
        F.coalesce(F.sum(n), zero).alias("rows_in"),
        F.count(n).alias("rows_kept"),
        F.coalesce(F.sum(n - 1), zero).alias("rows_lost"),
        F.coalesce(F.max(n), zero).alias("largest_collision"),
    )


#: Relative standard error of a sketch of ``2^k`` registers is about ``1.04 / sqrt(2^k)``.
SKETCH_REGISTERS = 12


def key_sketches(rows: DataFrame, keys: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """Per group of ``by`` and named key: rows, and a mergeable sketch of the keys among them.

    A micro-batch appends its own, a few kilobytes for each group and key; ``sketched_collisions`` merges those of any
    batches without a look at the rows. Each task sketches its rows before the shuffle. Null parts of a key are values.
    """
    sketches = [
        F.struct(
            F.lit(name).alias("table"),
            F.col("n").alias("rows"),
            F.col(f"`sketch {name}`").alias("sketch"),
        )
        for name in keys
    ]
    counted = rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        *[
            F.hll_sketch_agg(F.xxhash64(*key, *[F.col(part).isNull() for part in key]), F.lit(SKETCH_REGISTERS)).alias(
                f"sketch {name}"
            )
            for name, key in keys.items()
        ],
    )
    return counted.select(*by, F.inline(F.array(*sketches)))


def sketched_collisions(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``rows_in`` (exact), ``rows_kept`` and ``rows_lost`` (estimates) per group and table, from stored sketches.

    A replayed batch must have replaced its sketches (``files_sink`` does that): its rows would be counted twice, though
    its keys would not.
    """
    merged = sketches.groupBy(*by, "table").agg(
        F.sum("rows").alias("rows_in"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("kept")
    )
    kept = F.least("kept", "rows_in")
    return merged.select(*by, "table", "rows_in", kept.alias("rows_kept"), (F.col("rows_in") - kept).alias("rows_lost"))


def observed(rows: DataFrame, name: str) -> DataFrame:
    """The same rows, counted on their way to a sink without another pass.

    For a frame with an ``_error`` column, batch or stream; a running query reports the counts of each
    micro-batch under ``name`` in its progress.
    """
    return rows.observe(
        name,
        F.count("*").alias("rows"),
        F.count(ERROR).alias("errors"),
        F.count_if(F.col(ERROR).isNull()).alias("good"),
    )


def reconcile(feed: Feed, messages: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """One row of counts for a feed: messages read, dead-lettered, without rows and with rows, and the rows produced,
    rejected, and kept by the key.

    Always ``messages = dead_letters + messages_without_rows + messages_with_rows``. The payload is parsed once. Rows
    are counted per key first, so the shuffle carries one row per key and task.
    """
    key = tuple(key or feed.table.key)
    rows = feeds.checked(feed, messages, position="_element")
    good = F.col(ERROR).isNull()
    first = F.coalesce(F.col("_element"), F.lit(0)) == 0
    produced = F.col("_made")
    per_key = rows.groupBy(*key).agg(
        F.count_if(first).alias("messages"),
        F.count_if(F.col("_bad_message") & first).alias("dead_letters"),
        F.count_if(F.col("_empty")).alias("messages_without_rows"),
        F.count_if(produced & first).alias("messages_with_rows"),
        F.count_if(produced).alias("rows_out"),
        F.count_if(produced & ~good).alias("rows_rejected"),
        F.count_if(produced & good).alias("_n"),
    )
    zero = F.lit(0).cast("bigint")
    counts = ("messages", "dead_letters", "messages_without_rows", "messages_with_rows", "rows_out", "rows_rejected")
    return per_key.agg(
        *[F.coalesce(F.sum(name), zero).alias(name) for name in counts],
        F.coalesce(F.sum("_n"), zero).alias("rows_writable"),
        F.count_if(F.col("_n") > 0).alias("rows_kept_by_key"),
    ).select(F.lit(feed.name).alias("feed"), "*")


def reconcile_written(feed: Feed, messages: DataFrame, written: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per date, the keys that the topic's good rows have, and how many of them the stored table holds or lacks.

    ``written`` is what was really stored, read back; a loss anywhere between topic and table shows here. Both sides
    are reduced to their keys before the join, so copies of a key cost nothing. Feeds without a date give one row.
    """
    key = list(key)
    date = F.col(feed.date[0]) if feed.date else F.lit(None).cast("date")
    good = feeds.checked(feed, messages).where(F.col(ERROR).isNull())
    expected = good.groupBy(*key).agg(F.min(date).alias("date"))
    stored = written.select(*[F.col(name).alias(f"_{name}") for name in key], F.lit(True).alias("_found")).distinct()
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in key]
    return (
        expected.join(stored, same, "left")
        .groupBy("date")
        .agg(
            F.count("*").alias("rows_expected"),
            F.count("_found").alias("rows_found"),
            F.count_if(F.col("_found").isNull()).alias("rows_missing"),
        )
    )
