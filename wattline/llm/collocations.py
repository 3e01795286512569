"""Phrase collocations by the layout of external stream estimation: sorted count streams instead of hash tables.

1. Tasks count the phrases of one word, then of two, then of three in whole texts; Spark adds the counts up. A phrase that
   is frequent enough has frequent parts, so each length counts only what has them: a bit per hash of the frequent
   shorter phrases lets the rest pass by. A false bit lets one through that the exact counts drop, so any number of
   bits gives the same result.
2. The counts of all lengths are one stream in prefix order: a phrase comes right after its beginnings. One lockstep
   pass over the sorted stream hands every phrase the counts of its beginnings. The stream is then put into suffix
   order, and a second pass hands every phrase the counts of its endings. Streams are stored in ranges; a range starts
   with the counts of its first phrase's beginnings, so that a hot first word is no bound on a range.
3. A phrase now has all counts of its cuts, and knows if it makes up enough of a shorter one to absorb it. Absorbed
   phrases leave by a sorted merge, and the best of every language are ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm import textbytes
from wattline.llm.common import cut

#: Longest phrase, least count, share in percent at which a longer phrase absorbs a shorter one, phrases per language.
LONGEST = 3
LEAST = 10
ABSORB = 50
TOP = 2000
#: Bytes of text counted together before they leave the task.
CHUNK = 1 << 20
#: Bits for each frequent phrase, and most bits of all: 64 MB, sent to every task.
BITS_EACH = 16
MOST_BITS = 1 << 29

#: Fixed by the contract: what separates words, and what separates pieces.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"]] = 2
_KIND[0x0A:0x0E] = 2


def _names(longest: int) -> list[str]:
    return [f"w{i + 1}" for i in range(longest)]


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of the values of a large_binary array."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(data if data is not None else b"", dtype=np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    up, down = textbytes._Tables.of(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    return textbytes.mixed((sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]] + (at[1:] - at[:-1]).astype(np.uint64))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return textbytes.mixed(left * np.uint64(0x9FB21C651E98DF25) + right)


class _Bits:
    """One bit per hash."""

    def __init__(self, raw: bytes):
        self.raw = np.frombuffer(raw, dtype=np.uint8)

    def have(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(len(self.raw) * 8 - 1)
        return (self.raw[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _cut_long(own: memoryview, size: int) -> Iterator[memoryview]:
    """Parts of a text that end where a piece ends; a piece longer than ``size`` is not cut."""
    if len(own) <= size:
        yield own
        return
    ends = np.flatnonzero(_KIND[np.frombuffer(own, dtype=np.uint8)] == 2)
    begun = 0
    while len(own) - begun > size:
        nth = max(np.searchsorted(ends, begun + size), np.searchsorted(ends, begun) + 1) - 1
        if nth >= len(ends):
            break
        yield own[begun : ends[nth] + 1]
        begun = int(ends[nth]) + 1
    yield own[begun:]


class _Chunk:
    """Words of some texts of one language, as numbers into their distinct values."""

    def __init__(self, raws: list, lang: np.uint64):
        low = textbytes._LOWER[np.frombuffer(b"\n" + b"\n".join(raws) + b"\n", dtype=np.uint8)]
        kind = _KIND[low]
        inside = kind == 0
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        start, end = edge[0::2], edge[1::2]
        offsets = np.concatenate([[0], np.cumsum(end - start)])
        data = low[inside]
        values = pa.Array.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        self.words = values.dictionary
        self.id = values.indices.to_numpy().astype(np.int64)
        piece = np.cumsum(kind == 2, dtype=np.int32)[start]
        self.together = piece[1:] == piece[:-1]
        self.lang = lang

    def counts(self, length: int, bits: list[_Bits]) -> tuple[list[np.ndarray], np.ndarray]:
        """Word numbers, one array per place, and counts of the phrases whose beginning and end may be frequent."""
        n, code, places = len(self.words), self.id, [np.arange(len(self.words))]
        starts = np.arange(len(self.id))
        hashes = _joined(_word_hashes(self.words), np.full(n, self.lang))
        word_hash = hashes
        for k in range(1, length):
            known = bits[k - 1].have(hashes)[code]  # phrases of k words, by their first word
            slot = np.full(len(self.id), -1)
            slot[starts] = np.arange(len(starts))
            left, right = starts, starts + 1
            fits = right < len(self.id)
            left, right = left[fits], right[fits]
            fits = (slot[right] >= 0) & self.together[left]
            left, right = left[fits], right[fits]
            ok = known[slot[left]] & known[slot[right]]
            left = left[ok]
            pair, code = np.unique(code[slot[left]] * n + self.id[left + k], return_inverse=True)
            before, last = pair // n, pair % n
            places = [place[before] for place in places] + [last]
            hashes = _joined(hashes[before], word_hash[last])
            starts = left
        return places, np.bincount(code, minlength=len(places[0]))


def _counter(length: int, bits: list[bytes]):
    """Partial counts of the phrases of a length, as ``key, f``; with one word also the number of all words.

    A key is the words, joined by blanks, a tab and the language; the number of all words has none. One column is less
    to shuffle than several, and no word holds a blank or a tab.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [_Bits(raw) for raw in bits]
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            which = langs.indices.to_numpy(zero_copy_only=False)
            texts = textbytes.views(batch.column(1))
            for nth, lang in enumerate(langs.dictionary.to_pylist()):
                salt = _word_hashes(pa.array([lang.encode("utf-8", "surrogatepass")], pa.large_binary()))[0]
                own = [part for i in np.flatnonzero(which == nth) for part in _cut_long(texts[i], CHUNK)]
                for _, raws in textbytes.chunks(own, CHUNK):
                    chunk = _Chunk(raws, salt)
                    places, counts = chunk.counts(length, known)
                    columns = [chunk.words.take(pa.array(place)) for place in places]
                    key = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary())) if length > 1 else columns[0]
                    if length == 1:
                        key = pa.concat_arrays([key, pa.array([b""], pa.large_binary())])
                        counts = np.append(counts, len(chunk.id))
                    mark = pa.scalar(b"\t" + lang.encode("utf-8", "surrogatepass"), pa.large_binary())
                    key = pc.binary_join_element_wise(key, mark, pa.scalar(b"", pa.large_binary()))
                    yield pa.RecordBatch.from_arrays(
                        [key.view(pa.large_string()).cast(pa.string()), pa.array(counts.astype(np.int64))], ["key", "f"]
                    )

    return count


def _bits_of(frequent: DataFrame, length: int) -> bytes:
    """A bit for the hash of every frequent phrase: as many bits as ``BITS_EACH`` asks for, ``MOST_BITS`` at most."""
    many = frequent.count()
    n_bits = min(MOST_BITS, max(1 << 16, 1 << (many * BITS_EACH).bit_length()))
    block = min(n_bits, 1 << 20)

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [column.cast(pa.binary()).cast(pa.large_binary()) for column in batch.columns]
            salt = _word_hashes(columns[0])
            hashes = _joined(_word_hashes(columns[1]), salt)
            for column in columns[2:]:
                hashes = _joined(hashes, _joined(_word_hashes(column), salt))
            at = np.unique(hashes & np.uint64(n_bits - 1)).astype(np.int64)
            if len(at):
                first = np.flatnonzero(np.diff(at // block, prepend=-1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(at[first] // block),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(first, len(at)).astype(np.int32)), pa.array((at % block).astype(np.int32))
                        ),
                    ],
                    ["block", "at"],
                )

    def pack(table: pa.Table) -> pa.Table:
        flags = np.zeros(block, dtype=np.uint8)
        for at in table.column("at").chunks:
            flags[at.flatten().to_numpy()] = 1
        packed = np.packbits(flags, bitorder="little").tobytes()
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([packed])})

    found = (
        frequent.select("lang", *_names(length))
        .mapInArrow(positions, "block bigint, at array<int>")
        .groupBy("block")
        .applyInArrow(pack, "block bigint, bits binary")
    )
    whole = bytearray(n_bits // 8)
    for row in found.toLocalIterator():
        whole[row.block * block // 8 : (row.block + 1) * block // 8] = row.bits
    return bytes(whole)


def counts(docs: DataFrame, text: str, lang: str, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts ``lang, w1 …, f`` of all phrases that occur ``least`` times, and ``lang, n`` of all words.

    Absent words are null.
    """
    names = _names(longest)
    read = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    said = F.substring_index("key", "\t", 1)
    levels, bits = [], []
    for length in range(1, longest + 1):
        summed = read.mapInArrow(_counter(length, bits), "key string, f bigint").groupBy("key").agg(F.sum("f").alias("f"))
        frequent = summed.where((F.col("f") >= least) | (said == "")).select(
            F.expr("substring(key, char_length(substring_index(key, '\t', 1)) + 2)").alias("lang"),
            F.when(said != "", F.split(said, " ")).alias("words"),
            "f",
        )
        frequent = cut(frequent.select("lang", *[F.get("words", F.lit(k)).alias(name) for k, name in enumerate(names[:length])], "f"))
        levels.append(frequent.where("w1 IS NOT NULL"))
        if length == 1:
            totals = frequent.where("w1 IS NULL").select("lang", F.col("f").alias("n"))
        if length < longest:
            bits.append(_bits_of(levels[-1], length))
    whole = levels[0]
    for level in levels[1:]:
        whole = whole.unionByName(level, allowMissingColumns=True)
    return whole.select("lang", *names, "f"), totals


def _lockstep(keys: list[str], out: list[str], heads: dict):
    """One pass over a stream sorted by ``keys``: each row gets the counts of its beginnings, from the rows before it."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            f = batch.column("f").to_numpy()
            filled = [batch.column(key).is_valid().to_numpy(zero_copy_only=False) for key in keys]
            level = np.sum(filled, axis=0)
            if held is None:
                held = heads[tuple(batch.column(name)[0].as_py() for name in ("lang", *keys))]
            columns, after = [], []
            for k, carried in enumerate(held, 1):
                at = np.maximum.accumulate(np.where(level == k, np.arange(len(f)), -1))
                value = np.where(at >= 0, f[at], carried)
                after.append(int(value[-1]))
                columns.append(pa.array(value, mask=level < k))
            held = after
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *out])

    return walk


def _beginnings(stream: DataFrame, keys: list[str], out: list[str]) -> DataFrame:
    """The stream in the order of ``keys``, with the counts of every row's first words as ``out``."""
    order = ["lang", *keys]
    laid = cut(stream.repartitionByRange(*order).sortWithinPartitions(*order))
    # what precedes each range: the counts of its first phrase's beginnings, at most one row per range and length
    first = laid.groupBy(F.spark_partition_id().alias("nth")).agg(F.min(F.struct(*order)).alias("first"))
    firsts = [row.first for row in first.collect()]
    wanted = {tuple(row) for row in firsts}
    begun = [
        (row[0], *row[1 : k + 1], *[None] * (len(keys) - k)) for row in wanted for k in range(1, len(out) + 1) if row[k] is not None
    ]
    kinds = ", ".join(f"{key} string" for key in keys)
    asked = laid.sparkSession.createDataFrame(sorted(set(begun), key=repr), f"lang string, {kinds}").alias("asked")
    same = [F.col(f"asked.{name}").eqNullSafe(laid[name]) for name in order]
    found = laid.join(F.broadcast(asked), same).select(*[laid[name] for name in order], "f").collect()
    known = {tuple(row[:-1]): row.f for row in found}
    heads = {
        row: [known.get((row[0], *row[1 : k + 1], *[None] * (len(keys) - k)), 0) for k in range(1, len(out) + 1)]
        for row in wanted
    }
    kinds = {field.name: field.dataType.simpleString() for field in laid.schema.fields}
    schema = ", ".join([*[f"{name} {kind}" for name, kind in kinds.items()], *[f"{name} bigint" for name in out]])
    return laid.mapInArrow(_lockstep(keys, out, heads), schema)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a² / (l r)), exactly: products of decimals, not of longs."""
    wide = lambda x: x.cast("decimal(16,0)")
    top, below = F.lit(1_000_000).cast("decimal(7,0)") * (wide(a) * wide(a)), wide(left) * wide(right)
    return F.call_function("div", top, below)


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    absorb: int = ABSORB,
) -> DataFrame:
    """Phrases of 2 to ``longest`` words that occur ``least`` times: ``lang, phrase, words, a, l, r, n, score, k``.

    A-Z are lower-cased; ``.,;:!?`` and line ends part a text into pieces, blanks and tabs a piece into words. ``a`` is
    the phrase's count in its language (null: ``und``), overlaps included, ``n`` the language's words. Of the phrase's
    cuts the one with the least score ``floor(10^6 a² / (l r))`` counts, ``l`` and ``r`` being the counts of its parts and
    ``k`` the words of the first; the least ``k`` of equal ones. A phrase inside a longer one that occurs ``absorb``
    percent as often is left out.

    Null and empty texts hold nothing; repeated rows count each; other columns play no part. Texts of any length are
    taken whole, a piece of one (no punctuation, no line end) must fit in a task. An empty table gives no phrase.
    """
    names = _names(longest)
    found, totals = counts(docs, text, lang, longest, least)
    left = [f"l{k}" for k in range(1, longest)]
    right = [f"r{k}" for k in range(1, longest)]
    tail = [f"s{k}" for k in range(1, longest + 1)]
    with_left = _beginnings(found, names, left)
    turned = F.reverse(F.filter(F.array(*names), lambda w: w.isNotNull()))
    suffixed = with_left.select("*", *[F.get(turned, F.lit(k)).alias(name) for k, name in enumerate(tail)])
    both = cut(_beginnings(suffixed, tail, right).drop(*tail))
    size = sum((F.col(name).isNotNull().cast("int") for name in names), F.lit(0))
    sized = both.withColumn("size", size).where("size > 1")
    cuts = []
    for length in range(2, longest + 1):
        ways = [
            F.struct(
                _score(F.col("f"), F.col(left[k - 1]), F.col(right[length - k - 1])).alias("score"),
                F.lit(k).alias("k"),
                F.col(left[k - 1]).alias("l"),
                F.col(right[length - k - 1]).alias("r"),
            )
            for k in range(1, length)
        ]
        cuts.append((length, F.least(*ways) if len(ways) > 1 else ways[0]))
    best = F.when(F.col("size") == cuts[0][0], cuts[0][1])
    for length, way in cuts[1:]:
        best = best.when(F.col("size") == length, way)
    words = F.filter(F.array(*names), lambda w: w.isNotNull())
    scored = sized.withColumn("best", best).withColumn("key", words)
    marks = []
    for length in range(3, longest + 1):
        own = sized.where(F.col("size") == length)
        for names_of, of in ((names[: length - 1], left[length - 2]), (names[1:length], right[length - 2])):
            marks.append(own.where(100 * F.col("f") >= absorb * F.col(of)).select("lang", F.array(*names_of).alias("key")))
    kept = scored
    if marks:
        absorbed = marks[0]
        for mark in marks[1:]:
            absorbed = absorbed.unionByName(mark)
        kept = scored.join(absorbed.hint("merge"), ["lang", "key"], "left_anti")
    return kept.join(F.broadcast(totals), "lang").select(
        "lang",
        F.array_join("key", " ").alias("phrase"),
        F.col("key").alias("words"),
        F.col("f").alias("a"),
        F.col("best.l").alias("l"),
        F.col("best.r").alias("r"),
        "n",
        F.col("best.score").alias("score"),
        F.col("best.k").alias("k"),
    )


def best_of_each(phrases: DataFrame, top: int = TOP, salts: int = 64) -> DataFrame:
    """The first ``top`` phrases of every language by score, count (both descending) and text, with their ``rank``.

    Salted parts of a language are ranked first, so that at most ``top * salts`` phrases of it meet in a task.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]

    def ranked(frame: DataFrame, *by: Column) -> DataFrame:
        number = F.row_number().over(Window.partitionBy("lang", *by).orderBy(*order))
        return frame.withColumn("rank", number).where(F.col("rank") <= top)

    return ranked(ranked(phrases, F.pmod(F.xxhash64("phrase"), F.lit(salts))))
