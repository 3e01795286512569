"""Approximate nearest neighbours by a permutation index.

A fixed number of vectors are pivots. Every vector is represented by the order of its nearest pivots, and posted in the
inverted files of these with its place in the order. A query looks into the files of its own nearest pivots only and adds
up how far the places that it finds are from its own: Spearman's footrule, in which a vector that is not listed counts as
listed last. The best few per cent of that ranking are ranked again by their exact inner product.

Rows are dealt into shards by hash, each with its own inverted files, and queries into blocks; a shard and a block are
a unit of work of bounded size, and its result is the block's nearest within the shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import column, cut

#: Pivots (the bound of the sample that the index is fitted on, for each vector length), places posted of each vector's
#: order, files that a query looks into, vectors in a shard, queries in a block.
PIVOTS = 1024
PLACES = 256
LOOKS = 128
SHARD_ROWS = 4096
BLOCK_ROWS = 4096
#: The share of the vectors that the footrule ranking passes on to the exact ranking, ties included; a share of 1 makes
#: the search exact. Of a shard at least ``RERANK_TIMES * k`` are passed on.
RERANK_SHARE = 0.05
RERANK_TIMES = 5


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``row, vec_id, vector, size`` of the vectors that take part, ``row`` being a number of their own.

    Left out are null ids and vectors that are null, empty, zero or hold a null, NaN or infinite component. Repeated
    ids and repeated rows all take part. Vectors meet those of their own length, since others have no inner product.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(
        column(vec_id).alias("vec_id"), column(embedding).cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & ~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0))
    return cut(rows.select(F.monotonically_increasing_id().alias("row"), "*", F.size("vector").alias("size")))


class Pivots:
    """Pivots of one vector length, lifted to one length in space.

    A further component lifts every vector to the length of the longest, so that the largest inner product with a
    query is also the nearest; pivots are lifted like all rows, queries have 0 there.
    """

    def __init__(self, chosen: np.ndarray, most: float, places: int):
        self.most, self.places = most, min(places, len(chosen))
        self.lifted = np.column_stack([chosen, self._lift(chosen)])

    def _lift(self, vectors: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.most - (vectors**2).sum(axis=1), 0))

    def order(self, vectors: np.ndarray, places: int, query: bool) -> np.ndarray:
        """Numbers of each vector's nearest pivots, nearest first."""
        extra = np.zeros(len(vectors)) if query else self._lift(vectors)
        near = np.column_stack([vectors, extra]) @ self.lifted.T
        return np.argsort(-near, axis=1, kind="stable")[:, :places]


def choose_pivots(rows: DataFrame, pivots: int = PIVOTS, places: int = PLACES) -> dict[int, Pivots]:
    """For each vector length the different ones of its first ``2 * pivots`` vectors by hash order."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    out = {}
    for size, most in sorted(tuple(r) for r in rows.groupBy("size").agg(F.max(square)).collect()):
        sample = rows.where(F.col("size") == size).orderBy(F.xxhash64("vec_id", "vector"), "row").limit(2 * pivots)
        different = list(dict.fromkeys(tuple(row.vector) for row in sample.select("vector").collect()))[:pivots]
        out[size] = Pivots(np.array(different, dtype=np.float64), most, places)
    return out


class Shard:
    """Inverted files of some vectors: for each pivot everyone's place for it, the one behind the last where not listed.

    A file lists a good part of its shard, so a place per vector is shorter than the list of who has which.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, order: np.ndarray, n_pivots: int):
        self.ids, self.rows, self.vectors, self.places = ids, rows, vectors, order.shape[1]
        by_vector = np.full((len(ids), n_pivots), self.places, dtype=np.int16)
        np.put_along_axis(by_vector, order, np.arange(self.places, dtype=np.int16)[None, :], 1)
        self.files = np.ascontiguousarray(by_vector.T)

    def nearest(self, row: int, vector: np.ndarray, looks: np.ndarray, k: int, share: float):
        """Ids and scores of the nearest found, and how many vectors were scored exactly."""
        footrule = np.zeros(len(self.ids), dtype=np.int32)
        part = np.empty(len(self.ids), dtype=np.int16)
        for place, pivot in enumerate(looks):
            np.abs(np.subtract(self.files[pivot], np.int16(place), out=part), out=part)
            footrule += part
        footrule[self.rows == row] = np.iinfo(np.int32).max
        wanted = min(len(footrule), max(RERANK_TIMES * k, int(np.ceil(share * len(footrule)))))
        cutoff = np.partition(footrule, wanted - 1)[wanted - 1]
        candidates = np.flatnonzero((footrule <= cutoff) & (self.rows != row))
        score = (self.vectors[candidates] * vector).sum(axis=1)
        scored = len(candidates)
        if scored > k:
            least = np.partition(score, scored - k)[scored - k]
            candidates, score = candidates[score >= least], score[score >= least]
        best = np.lexsort((self.ids[candidates], -score))[:k]
        return self.ids[candidates[best]], score[best], scored


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _searcher(pivots: dict[int, Pivots], k: int, looks: int, share: float):
    def search(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(members) and len(queries):
            own = pivots[int(members["size"].iloc[0])]
            held, asked = _stack(members["vector"]), _stack(queries["q_vector"])
            shard = Shard(
                members["vec_id"].to_numpy(),
                members["row"].to_numpy(),
                held,
                own.order(held, own.places, False),
                len(own.lifted),
            )
            files = own.order(asked, min(looks, own.places), True)
            for row, query_id, vector, look in zip(queries["q_row"], queries["q_id"], asked, files):
                out.append((row, query_id, *shard.nearest(row, vector, look, k, share)))
        return pd.DataFrame(out, columns=["row", "query_id", "ids", "scores", "scored"])

    return search


def found(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    pivots: int = PIVOTS,
    places: int = PLACES,
    looks: int = LOOKS,
    share: float = RERANK_SHARE,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``row, query_id, ids, scores, scored``: per query and shard, its nearest there and how many were scored."""
    rows = usable(vectors, vec_id, embedding)
    sizes = [tuple(r) for r in rows.groupBy("size").agg(F.count("*"), F.count_if(is_query)).collect()]
    chosen = choose_pivots(rows, pivots, places)
    parts = lambda n, most: max(1, -(-n // most))
    plan = {size: (parts(n, SHARD_ROWS), parts(asked, BLOCK_ROWS)) for size, n, asked in sizes}
    if not plan:
        plan = {0: (1, 1)}
    n_shards = F.create_map(*[F.lit(x).cast("long") for size, (n, _) in plan.items() for x in (size, n)])
    n_blocks = F.create_map(*[F.lit(x).cast("long") for size, (_, n) in plan.items() for x in (size, n)])
    size = F.col("size").cast("long")
    dealt = rows.withColumn("shards", n_shards[size]).withColumn("blocks", n_blocks[size])
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    # a shard goes to every block of queries, a query to every shard; a unit is one of each
    members = dealt.select(
        "size", F.pmod(F.xxhash64("row"), "shards").alias("shard"), every("blocks").alias("block"), "row", "vec_id", "vector"
    )
    asked = dealt.where(is_query).select(
        "size", every("shards").alias("shard"), F.pmod(F.xxhash64("row", F.lit(1)), "blocks").alias("block"), "row", "vec_id", "vector"
    )
    asked = asked.toDF("q_size", "q_shard", "q_block", "q_row", "q_id", "q_vector")  # a cogroup needs names of its own
    return (
        members.groupBy("size", "shard", "block")
        .cogroup(asked.groupBy("q_size", "q_shard", "q_block"))
        .applyInPandas(
            _searcher(chosen, k, looks, share),
            "row bigint, query_id bigint, ids array<bigint>, scores array<double>, scored bigint",
        )
    )


def search(vectors: DataFrame, is_query: Column, k: int = 20, **options) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector of which ``is_query`` (a condition on ``vec_id``) holds, the
    ``k`` others of largest inner product that the index finds, nearest first, ties to the smaller id.

    All vectors are indexed, see ``usable`` for those that take part; every row but the query's own can be found, also
    one of the same id. With fewer than ``k`` others, all are returned; an empty table has no result. Scores are sums in
    double precision over the vectors as given. Other columns play no part. ``options`` are those of ``found``.
    """
    each = found(vectors, is_query, k, **options).select("row", "query_id", F.explode(F.arrays_zip("ids", "scores")).alias("hit"))
    nearest = Window.partitionBy("row").orderBy(F.desc("hit.scores"), "hit.ids")
    return (
        each.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score"))
    )
