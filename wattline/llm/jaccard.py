"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

1. Every text becomes the set of its word shingles, its MinHash values, and one hash per band of them.
2. Texts with the same words are one *copy class*, so copies are never compared with each other.
3. Classes that share a band are linked to the least class of that band, a star instead of all pairs, and connected.
   Whatever may be similar now lies in one candidate group.
4. The shingle sets of a group are compared in full. A large group is cut into blocks by hash, and every pair of
   blocks is a unit of work of bounded size, so that a group of any size spreads over the cluster; a unit returns sums
   per class, not pairs.
5. Verified links are connected to the classes of near duplicates.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm import textbytes
from wattline.llm.common import column, components, cut, sized_broadcast, whole

#: Words in a shingle, least similarity, wanted recall of a pair of just that similarity, MinHash values affordable.
SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 192
#: Classes and shingles in a block; a unit of work holds two blocks.
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 2_000_000
#: Classes of small groups that are verified together.
PACK = 1000
#: Most candidate classes whose keys are broadcast to pick up their texts; beyond it that join is shuffled.
BROADCAST_BOUND = 500_000


def choose_bands(threshold: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """The most selective bands: as many rows as the hashes allow while a pair at the threshold is still found."""
    best = None
    for rows in range(1, most_hashes + 1):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))) if threshold < 1 else 1
        if bands * rows <= most_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("this recall needs more MinHash values")
    return best


def _sketches(shingle: int, bands: int, rows: int):
    rng = np.random.default_rng(20240607)
    factor = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    offset = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)

    def sketch(text: pa.Array) -> pa.Array:
        words = np.zeros(len(text), dtype=np.int64)
        runs = np.zeros(len(text), dtype=np.int64)
        copy = np.zeros(len(text), dtype=np.int64)
        band = np.zeros((len(text), bands), dtype=np.int64)
        mix = textbytes._powers(0xD6E8FEB86659FD93, bands * rows).reshape(bands, rows)
        for begun, raws in textbytes.chunks(textbytes.views(text)):
            cut_up = textbytes.tokenize(raws)
            hashes = cut_up.hashes()
            grams, first = textbytes.rolling(hashes, cut_up.first, shingle)
            low = (grams >> np.uint64(32)).astype(np.uint32)
            for d in range(len(raws)):
                own = hashes[cut_up.first[d] : cut_up.first[d + 1]]
                if not len(own):
                    continue
                least = np.full(bands * rows, 0xFFFFFFFF, dtype=np.uint32)
                mine = low[first[d] : first[d + 1]]
                for at in range(0, len(mine), 2048):
                    part = mine[None, at : at + 2048] * factor[:, None] + offset[:, None]
                    np.minimum(least, part.min(axis=1), out=least)
                keys = (least.reshape(bands, rows).astype(np.uint64) + np.uint64(1)) * mix
                keys = textbytes.mixed(keys.sum(axis=1) + np.arange(bands, dtype=np.uint64))
                i = begun + d
                words[i], runs[i] = len(own), len(mine)
                factors, _ = textbytes._Tables.of(len(own))
                copy[i] = textbytes.mixed((own * factors).sum(keepdims=True) + np.uint64(len(own)))[0].astype(np.int64)
                band[i] = keys.view(np.int64)
        lists = pa.ListArray.from_arrays(
            np.arange(0, band.size + 1, bands, dtype=np.int32), pa.array(band.ravel()), mask=pa.array(words == 0)
        )
        return pa.StructArray.from_arrays(
            [pa.array(words), pa.array(runs), pa.array(copy), lists], names=["n_words", "n_runs", "copy", "bands"]
        )

    return F.arrow_udf(sketch, "n_words bigint, n_runs bigint, copy bigint, bands array<bigint>")


def _sets(shingle: int):
    def sets(text: pa.Array) -> pa.Array:
        out = [b""] * len(text)
        for begun, raws in textbytes.chunks(textbytes.views(text)):
            cut_up = textbytes.tokenize(raws)
            grams, first = textbytes.rolling(cut_up.hashes(), cut_up.first, shingle)
            for d in range(len(raws)):
                out[begun + d] = np.unique(grams[first[d] : first[d + 1]]).tobytes()
        return pa.array(out, pa.binary())

    return F.arrow_udf(sets, "binary")


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the sets have a Jaccard similarity of the threshold or more, as a symmetric matrix without diagonal."""
    k = len(sets)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    owner = np.repeat(np.arange(k), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[column] > 1  # what only one set holds meets nothing
    owner, column = owner[shared], (np.cumsum(counts > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((k, k))
    total = int(column[-1]) + 1 if len(column) else 0
    width = max(64, 4_000_000 // k)
    for at in range(0, total, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        part = np.zeros((k, min(width, total - at)), dtype=np.float32)
        part[owner[lo:hi], column[lo:hi] - at] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    out = common >= threshold * union - 1e-9
    np.fill_diagonal(out, False)
    return out


def _verifier(threshold: float):
    def one_group(group: pd.DataFrame) -> pd.DataFrame:
        nodes, sizes = group["node"].to_numpy(), group["size"].to_numpy()
        own = group["own"].to_numpy()
        adjacent = linked([np.frombuffer(x, dtype=np.uint64) for x in group["grams"]], threshold)
        if own.min() != own.max():  # two blocks: pairs within a block belong to the block's own unit
            adjacent &= own[:, None] != own[None, :]
        label = nodes.copy()
        while True:
            near = np.where(adjacent, label[None, :], label[:, None]).min(axis=1)
            near = np.minimum(near, label)
            if (near == label).all():
                break
            label = near
        links = adjacent @ sizes
        some = links > 0
        return pd.DataFrame({"node": nodes[some], "links": links[some], "peer": label[some]})

    def verify(groups: pd.DataFrame) -> pd.DataFrame:
        parts = [one_group(group) for _, group in groups.groupby("root")]
        return pd.concat(parts, ignore_index=True)

    return verify


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    most_hashes: int = MOST_HASHES,
) -> DataFrame:
    """One row per document row: ``doc_id, text_hash, n_words, class_id, n_links, stays``.

    ``class_id`` is the least id in the document's class, the documents connected through pairs of the similarity or
    more; ``n_links`` counts the other rows that it forms such a pair with; exactly the row of least id (then least
    ``text_hash``) of a class ``stays``, and so do rows equal to it in id and text.

    A text of fewer than ``shingle`` words is one shingle. A text without words, null or empty, is alone in its class
    and stays. Null ids come before all others and may be a ``class_id``. Rows may repeat. Word sequences and shingles
    are told apart by 64-bit hashes. Texts of any length are taken whole.
    """
    bands, rows = choose_bands(threshold, recall, most_hashes)
    sketch = _sketches(shingle, bands, rows)(F.col("text"))
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )
    thin = cut(base.select("doc_id", "text_hash", sketch.alias("s")).select("doc_id", "text_hash", "s.*"))
    some = thin.where("n_words > 0")
    copies = some.groupBy("copy").agg(
        F.count("*").alias("size"),
        F.min(F.struct("doc_id", "text_hash")).alias("chosen"),
        F.any_value("n_runs").alias("n_runs"),
        F.any_value("bands").alias("bands"),
    )
    posts = copies.select(F.col("copy").alias("a"), F.explode("bands").alias("band"))
    stars = posts.groupBy("band").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1")
    groups = components(posts.join(stars, "band").select("a", "b"))
    members = cut(groups.join(copies.withColumnRenamed("copy", "node").drop("bands"), "node"))
    blocks = F.greatest(
        F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n_runs") / BLOCK_SHINGLES)
    )
    sizes = members.groupBy("root").agg(blocks.alias("blocks"))
    n_members = members.count()
    wanted = members.join(sizes, "root").select(
        "node",
        "root",
        "size",
        "blocks",
        F.col("chosen.doc_id").alias("_id"),
        F.col("chosen.text_hash").alias("_hash"),
        F.pmod(F.xxhash64("node"), "blocks").alias("own"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    gathered = (
        base.join(sized_broadcast(wanted, n_members, BROADCAST_BOUND), same)
        .select("node", "root", "size", "blocks", "own", _sets(shingle)(F.col("text")).alias("grams"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .withColumn("small", F.col("blocks") == 1)
        .withColumn("pack", F.when(F.col("small"), F.pmod("root", F.lit(n_members // PACK + 1))).otherwise(F.col("root")))
        .dropDuplicates(["node", "low", "high"])
    )
    verified = cut(
        gathered.groupBy("small", "pack", "low", "high").applyInPandas(
            _verifier(threshold), "node bigint, links bigint, peer bigint"
        )
    )
    classes = components(verified.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    flat = (
        copies.select(F.col("copy").alias("node"), "size", "chosen")
        .join(classes, "node", "left")
        .join(links, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("size") - 1)
    )
    least = flat.groupBy("root").agg(F.min("chosen").alias("kept"))
    found = flat.join(least, "root").select(F.col("node").alias("copy"), "n_links", "kept")
    own = F.struct("doc_id", "text_hash")
    return thin.join(found, "copy", "left").select(
        "doc_id",
        "text_hash",
        "n_words",
        F.when(F.col("n_words") > 0, F.col("kept.doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        ((F.col("n_words") == 0) | own.eqNullSafe(F.col("kept"))).alias("stays"),
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class, all columns kept; rows equal in id and text are one document."""
    found = cut(near_duplicates(docs, doc_id, text, **options).select("doc_id", "text_hash", "stays"))
    listed = found.groupBy("doc_id", "text_hash").agg(F.min("stays").alias("stays"), F.count("*").alias("n"))
    gone = cut(listed.where("NOT stays OR n > 1").withColumnsRenamed({"doc_id": "their_id", "text_hash": "their_hash"}))
    rows = docs.select(whole(docs), column(doc_id).alias("id"), F.xxhash64(column(text)).alias("hash"))
    same = F.col("id").eqNullSafe(F.col("their_id")) & F.col("hash").eqNullSafe(F.col("their_hash"))
    # those that go, and those that repeat, are sent to the documents, so that no other text is shuffled
    marked = rows.join(sized_broadcast(gone, gone.count(), BROADCAST_BOUND), same, "left")
    repeated = marked.where("stays").dropDuplicates(["id", "hash"]).select("row.*")
    return marked.where("n IS NULL").select("row.*").unionByName(repeated)
