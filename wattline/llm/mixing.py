"""Mixing sources to target weights by Pfair scheduling.

Every source's documents are cut into blocks. Block ``j`` of a source with weight ``w`` is released at slot
``floor(j / w)`` and due by slot ``ceil((j + 1) / w)``; earliest deadline first gives each slot to one block, so that
at any slot each source has had its share of the slots with a deviation below one block. When a source has run out, the
others start a new schedule among themselves, with the same weights.

The schedule is a list of slots for each source, laid out when the query is built from nothing but the sources' sizes and
weights. Blocks grow with the corpus, so that it has a bounded number of them. Rows are numbered without bringing a
source together: a source is split into ranges of the hashed id, small enough for a task; a block then picks up its slot.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import column, whole

#: Documents of one source in a block of a small corpus, blocks of a large one, rows of a source that one task numbers.
BLOCK_ROWS = 16
MOST_BLOCKS = 250_000
RANGE_ROWS = 4_000
#: Weights are whole parts of about so many, finer than one block in the longest schedule.
PARTS = 1 << 40
#: Without target weights, a source's weight is its size to this power.
TEMPER = 0.5

OUT = ("mix_share", "mix_block", "mix_slot", "mix_pos")


def parts_of(weights: list[float]) -> list[int]:
    """Weights as whole numbers of a sum near ``PARTS``, 1 at least."""
    total = sum(weights)
    return [max(1, math.floor(PARTS * weight / total + 0.5)) for weight in weights]


def schedule(parts: list[int], blocks: list[int]) -> list[list[int]]:
    """For each source the slots of its blocks, by earliest deadline among the released; ties go to the earlier source."""
    slots: list[list[int]] = [[] for _ in parts]
    alive = [i for i, n in enumerate(blocks) if n]
    slot = 0
    while alive:
        total, begun, done = sum(parts[i] for i in alive), slot, dict.fromkeys(alive, 0)
        waiting, released = [(0, i) for i in alive], []
        ended = None
        while ended is None:
            while waiting and waiting[0][0] <= slot - begun:
                _, i = heapq.heappop(waiting)
                heapq.heappush(released, (-(-(done[i] + 1) * total // parts[i]), i))
            _, i = heapq.heappop(released)
            slots[i].append(slot)
            slot += 1
            done[i] += 1
            if len(slots[i]) == blocks[i]:
                ended = i
            else:
                heapq.heappush(waiting, (done[i] * total // parts[i], i))
        alive.remove(ended)
    return slots


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    source: str = "source",
    doc_id: str = "doc_id",
    block_rows: int | None = None,
) -> DataFrame:
    """Every row with its place in the mix; sorting by ``mix_slot, mix_pos`` gives the mixed order.

    ``mix_share`` is the source's share of the slots while all sources last, ``mix_block`` its block's number,
    ``mix_slot`` the block's slot in the whole mix, where no slot stays empty, ``mix_pos`` the row's place in its block.
    A block has ``block_rows`` rows; by default ``BLOCK_ROWS``, and more in a corpus of more than ``MOST_BLOCKS`` such
    blocks.

    A source's rows are taken in the order of the md5 of their id, then id, then a hash of all columns; equal rows are
    interchangeable and all kept. Null is a source of its own, and so are null ids an id. Sources without a target
    weight, or with none above 0, come when the others have run out. Columns of ``docs`` named like a result's are
    replaced, all others kept, whatever their names. An empty table gives an empty mix. The driver holds the list of
    sources and slots, of which there are ``MOST_BLOCKS`` and one more for each source at most.
    """
    sizes = docs.groupBy(column(source).alias("s")).agg(F.count("*").alias("n")).collect()
    sizes.sort(key=lambda row: (row.s is not None, str(row.s)))
    block_rows = block_rows or max(BLOCK_ROWS, math.ceil(sum(row.n for row in sizes) / MOST_BLOCKS))
    if weights is None:
        target = [row.n**TEMPER for row in sizes]
    else:
        target = [max(0.0, float(weights.get(row.s) or 0.0)) for row in sizes]
        target = target if sum(target) else [1.0] * len(sizes)
    parts = parts_of(target) if sizes else []
    slots = schedule(parts, [-(-row.n // block_rows) for row in sizes])
    kind = docs.select(column(source)).schema[0].dataType.simpleString()
    plan = docs.sparkSession.createDataFrame(
        [(row.s, i, -(-row.n // RANGE_ROWS), parts[i] / sum(parts), slots[i]) for i, row in enumerate(sizes)],
        f"own {kind}, nth int, ranges bigint, mix_share double, slots array<bigint>",
    )
    sources = F.broadcast(plan.drop("slots"))
    each_slot = F.broadcast(plan.select("nth", F.posexplode("slots").alias("mix_block", "mix_slot")))
    order = F.md5(F.coalesce(column(doc_id).cast("string"), F.lit("")).cast("binary"))
    placed = (
        docs.select(
            whole(docs, *OUT),
            column(source).alias("source"),
            column(doc_id).alias("id"),
            order.alias("order"),
            F.xxhash64(*[column(name) for name in docs.columns if name not in OUT]).alias("hash"),
        )
        .join(sources, F.col("source").eqNullSafe(F.col("own")))
        .drop("own", "source")
        .withColumn(
            "range",
            F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("bigint") * F.col("ranges") / F.lit(2**32)),
        )
    )
    before = Window.partitionBy("nth").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        placed.groupBy("nth", "range")
        .agg(F.count("*").alias("n"))
        .select("nth", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("nth", "range").orderBy("order", "id", "hash")
    number = F.col("before") + F.col("number") - 1
    return (
        placed.withColumn("number", F.row_number().over(within))
        .join(counts, ["nth", "range"])
        .select("row", "nth", "mix_share", F.floor(number / block_rows).alias("mix_block"), (number % block_rows).cast("long").alias("mix_pos"))
        .join(each_slot, ["nth", "mix_block"])
        .select("row.*", *OUT)
    )
