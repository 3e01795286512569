"""What a keyed table computes: the latest row per key, newest-first reads and partition slices.

Batch operators. Ordering is by several columns so that it is total; the last ones break ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.contracts import KEEP


def latest_row(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest whole row of each key, its nulls included; of equally new rows, the largest by value.

    One aggregation: each task reduces a key to one row before the shuffle, so a key that holds a large share
    of all rows costs one row per task, not one giant group. The maximum of (order, values) needs a single
    buffer, which makes it cheaper than ``max_by`` and than a ranking window.
    """
    rank = _beyond(key, order)
    values = [*rank, *[name for name in rows.columns if name not in key and name not in rank]]
    if len(values) == 1:  # a plain maximum, which Spark can aggregate by hash instead of by sort
        return rows.groupBy(*key).agg(F.max(values[0]).alias(values[0])).select(*rows.columns)
    merged = rows.groupBy(*key).agg(F.max(F.struct(*values)).alias("_newest"))
    return merged.select(*[_placed(name, key) for name in rows.columns])


def latest_values(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key, the newest non-null value of every column: a null never overwrites a value.

    The order columns themselves come from the newest row.
    """
    rank = _beyond(key, order)
    values = [name for name in rows.columns if name not in key and name not in rank]
    kept = [newest_present(F.col(name), F.struct(*rank)).alias(name) for name in values]
    merged = rows.groupBy(*key).agg(F.max(F.struct(*rank)).alias("_newest"), *kept)
    return merged.select(
        *[F.col(f"{name}.value").alias(name) if name in values else _placed(name, key) for name in rows.columns]
    )


def newest_present(value: Column, rank: Column) -> Column:
    """Aggregate: the (rank, value) pair of the newest row that has the value, null if none has."""
    return F.max(F.when(value.isNotNull(), F.struct(rank.alias("rank"), value.alias("value"))))


def latest(rows: DataFrame, key: Sequence[str], order: Sequence[str], nulls: str) -> DataFrame:
    """Current state under the table's null rule."""
    return (latest_values if nulls == KEEP else latest_row)(rows, key, order)


def newest_first(rows: DataFrame, partition: Sequence[str], clustering: Sequence[str]) -> DataFrame:
    """Clustering order: partitions together, newest row first within each.

    A range sort on all the columns, so one large partition is still spread over many tasks.
    """
    return rows.orderBy(*partition, *[F.col(name).desc() for name in clustering])


def top_newest(
    rows: DataFrame, key: Sequence[str], order: Sequence[str], n: int, *, salts: int = 64
) -> DataFrame:
    """The ``n`` newest rows of each key.

    Rows are ranked per (key, salt) first and then per key, whatever ``n`` is: the newest ``n`` of a key are among
    the newest ``n`` of its salted parts. A key of any size is so spread over ``salts`` tasks, and at most
    ``n * salts`` of its rows meet in one; choose ``salts`` by the largest key.
    """
    newest = [F.col(name).desc_nulls_last() for name in order]

    def ranked(frame: DataFrame, *by: str) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(*by).orderBy(*newest))
        return frame.withColumn("_rank", number).filter(F.col("_rank") <= n).drop("_rank")

    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    return ranked(ranked(salted, *key, "_salt").drop("_salt"), *key)


def slice_by(rows: DataFrame, **equals) -> DataFrame:
    """Rows whose columns equal the given literals; on a partition column this prunes directories."""
    for name, value in equals.items():
        rows = rows.filter(F.col(name) == F.lit(value))
    return rows


def _beyond(key: Sequence[str], order: Sequence[str]) -> list[str]:
    return [name for name in order if name not in key]


def _placed(name: str, key: Sequence[str]) -> Column:
    return F.col(name) if name in key else F.col(f"_newest.{name}").alias(name)
