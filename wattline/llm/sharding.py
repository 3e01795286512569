"""Sharding by sampled splitters: size-weighted samples of keys choose quantiles, records are partitioned by range.

1. Every record has a size and a place in one total order: its key, then its id, then its copy number. Records of one
   key, as copies of a text, are neighbours.
2. Records are drawn with a chance in proportion to their size. Equal steps through the drawn places are the splitters
   of ranges of about equal bytes; a hot key has many drawn records, so it is divided as well.
3. A range that still holds too many bytes or rows is subdivided by splitters drawn inside it, until none does.
4. Ranges are counted and their counts summed up, so every record knows the bytes before it without a sort of the
   whole. Shard boundaries are the exact quantiles of these; a boundary inside a small group of equal keys moves to the
   nearer end of the group, so that only groups beyond that size are cut.

Only records' sizes and places are shuffled, never their texts. The driver holds splitters, range counts' sums and
boundaries: numbers of shards and ranges, not of records.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import cut

#: Rows of a range while there are few, most ranges beyond that, and drawn places for each of their splitters.
RANGE_ROWS = 20_000
MOST_RANGES = 16_384
DRAWN = 32
#: A range is overfull beyond so many times its share.
OVERFULL = 2
#: A group of equal keys stays whole while it is at most this share of a shard.
WHOLE_GROUP = 0.01

_TOP = 1 << 53


def text_key(text: Column) -> Column:
    """Sixteen hexadecimal digits of a text's md5: equal texts are neighbours, null and empty are equal."""
    return F.substring(F.md5(F.coalesce(text, F.lit("")).cast("binary")), 1, 16)


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null, plus one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _range_of(splitters: list[str]):
    """How many splitters are at or below a place."""
    sorted_places = np.array(splitters, dtype="S48")

    def find(place: pa.Array) -> pa.Array:
        own = np.array(place.to_pylist(), dtype="S48")
        return pa.array(np.searchsorted(sorted_places, own, side="right").astype(np.int32))

    return F.arrow_udf(find, "int")


def _drawn(rows: DataFrame, chance: Column, salt: int) -> DataFrame:
    dice = F.pmod(F.xxhash64(F.col("place"), F.lit(salt)), F.lit(_TOP)) / F.lit(float(_TOP))
    return rows.where(dice < chance)


def ranges(placed: DataFrame, range_rows: int = RANGE_ROWS, most_ranges: int = MOST_RANGES) -> DataFrame:
    """Rows of ``place, size`` with their ``range``; ranges are in the order of places.

    A row's load is half its share of the bytes and half that of the rows, so that neither many small records nor a few
    large ones overfill a range.
    """
    whole = placed.agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).first()
    wanted = min(most_ranges, math.ceil(whole.rows / range_rows))
    if wanted < 2:
        return placed.withColumn("range", F.lit(0))
    load = 0.5 * F.col("size") / F.lit(max(whole.bytes, 1)) + F.lit(0.5 / whole.rows)
    sample = _drawn(placed, load * wanted * DRAWN, 0)
    nth = F.ntile(wanted).over(Window.orderBy("place"))  # over the sample, whose size the parameters bound
    heads = sample.select("place", nth.alias("nth")).groupBy("nth").agg(F.min("place").alias("place"))
    splitters = sorted(row.place for row in heads.where("nth > 1").collect())
    while True:
        ranged = placed.withColumn("range", _range_of(splitters)(F.col("place")))
        loads = ranged.groupBy("range").agg(
            F.sum(load).alias("load"), F.max(load).alias("most"), F.min("place").alias("a"), F.max("place").alias("b")
        )
        # one record cannot be cut, so the largest does not count
        full = loads.where((F.col("load") - F.col("most")) * wanted > OVERFULL).collect()
        if not full:
            return ranged
        some = _drawn(ranged.where(F.col("range").isin([r.range for r in full])), load * wanted * DRAWN, len(splitters))
        own = Window.partitionBy("range")
        middle = F.least(F.lit(DRAWN), F.count("*").over(own)) / 2
        picked = some.select("place", (F.row_number().over(own.orderBy("place")) % DRAWN == F.ceil(middle)).alias("take"))
        new = {row.place for row in picked.where("take").collect()} | {r.b for r in full}  # an end always divides
        splitters = sorted(new | set(splitters))


def shards(
    docs: DataFrame,
    n_shards: int,
    key: Column,
    size: Column,
    doc_id: str = "doc_id",
    carry: dict[str, Column] | None = None,
    range_rows: int = RANGE_ROWS,
    whole_group: float = WHOLE_GROUP,
) -> DataFrame:
    """One row per row: ``doc_id, size, *carry, range, shard, slot``; shards have about equal sums of ``size``.

    ``key`` is text of up to 16 characters that orders the records; shards are consecutive ranges of it. ``slot`` counts a
    shard's rows from 0 in that order. A group of equal keys of at most ``whole_group`` of a shard is in one shard; a larger one is cut where the
    shard is full. Shards differ from the mean by at most that share and one record, which is never cut; with few or
    very unequal records some may be empty.

    Null keys, sizes and ids count as empty, 0 and empty. Rows equal in key and id are interchangeable and all kept;
    other columns of ``docs`` play no part, whatever their names. An empty table has no rows.
    """
    carry = carry or {}
    ids = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))
    place = F.concat(
        F.rpad(F.coalesce(key, F.lit("")), 16, " "),
        F.substring(F.md5(ids.cast("binary")), 1, 16),
        F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"),
    )
    placed = cut(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.coalesce(size, F.lit(0)).cast("long").alias("size"),
            *[column.alias(name) for name, column in carry.items()],
            place.alias("place"),
        )
    )
    ranged = ranges(placed, range_rows)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "range",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        )
    )
    within = Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = cut(
        ranged.withColumn("upto", F.sum("size").over(within))
        .withColumn("nth", F.row_number().over(Window.partitionBy("range").orderBy("place")))
        .join(sums, "range")
        .withColumn("end", F.col("bytes_before") + F.col("upto"))
        .withColumn("row", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("group", F.substring("place", 1, 16))
        .drop("upto", "nth", "bytes_before", "rows_before", "place")
    )
    first = _first_rows(numbered, n_shards, whole_group)
    starts = F.array(*[F.lit(x).cast("long") for x in first])
    shard = F.size(F.filter(starts, lambda x: x <= F.col("row"))) - 1
    return numbered.select(
        "doc_id", "size", *carry, "range", shard.alias("shard"), (F.col("row") - F.get(starts, shard)).alias("slot")
    )


def _first_rows(numbered: DataFrame, n_shards: int, whole_group: float) -> list[int]:
    """The number of the first row of every shard, in the whole order; equal where a shard is empty."""
    total = numbered.agg(F.max("end")).first()[0] or 0
    # the records that hold a boundary, at most one for each; compared as whole numbers
    scaled = lambda at: F.call_function("div", at.cast("decimal(20,0)") * n_shards, F.lit(max(total, 1)).cast("decimal(20,0)"))
    near = numbered.where(scaled(F.col("end")) > scaled(F.col("end") - F.col("size")))
    held = near.select("group", "size", "end", "row").collect()
    groups = {
        g.group: g
        for g in numbered.where(F.col("group").isin([h.group for h in held]))
        .groupBy("group")
        .agg(
            F.min(F.col("end") - F.col("size")).alias("start"),
            F.max("end").alias("end"),
            F.min("row").alias("first"),
            F.max("row").alias("last"),
        )
        .collect()
    }
    held.sort(key=lambda h: h.row)
    ends = [h.end * n_shards for h in held]
    out = [0]
    for bound in (total * s for s in range(1, n_shards)):
        at = bisect.bisect_left(ends, bound)
        if at == len(held):
            out.append(out[-1])
            continue
        row, group = held[at], groups[held[at].group]
        whole = group.end - group.start <= whole_group * total / n_shards
        start, end = (group.start, group.end) if whole else (row.end - row.size, row.end)
        first, after = (group.first, group.last + 1) if whole else (row.row, row.row + 1)
        out.append(max(out[-1], first if 2 * bound < (start + end) * n_shards else after))
    return out
