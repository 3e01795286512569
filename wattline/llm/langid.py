"""Language identification by interpolated Kneser-Ney character language models.

Spark counts the character n-grams of every training text, per language, and computes from all of them the n-grams of
all orders, with their interpolated probabilities, and the contexts, with the weight they leave to the next shorter one.
They are stored in the shared folder, sorted by language, order and hash; tasks map them as arrays and look up what
their texts need. A text gets the language whose model codes it in the fewest bits per character.
"""

from __future__ import annotations

import fcntl
import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm import textbytes
from wattline.llm.common import column, held_out, whole
from wattline.streaming.storage import delete, run_dir

#: Characters of the longest n-gram.
ORDER = 4
#: Bytes of text that are worked on together.
CHUNK = 1 << 20
#: A language is accepted if its model codes the text no worse than it codes this share of its calibration texts. By how
#: much the runner-up is worse would say less: one text of mixed languages in its training changes that.
ACCEPT_SHARE = 0.99
#: Rejection is calibrated on one in so many training texts, all of them, by models that have not seen these; the models
#: that then predict have learnt them as well.
CALIBRATION_PART = 16
UNKNOWN = "und"

_SPACE = 32
#: So many different signs four of which fit into 64 bits.
_PACKED = (1 << 16) - 1
_BASE = 0x9E3779B97F4A7C15


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters of all texts with one space for anything between, and where each text begins.

    A text is padded by ``ORDER - 1`` spaces in front and one behind, so that words at its ends are like any others.
    """
    pad = " " * (ORDER - 1)
    padded = [f"{pad}{text.lower()} " for text in texts]
    raw = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, padded), dtype=np.int64, count=len(texts))
    begin = np.concatenate([[0], np.cumsum(lengths)])
    letter = _LETTER[np.minimum(raw, len(_LETTER) - 1)]
    out = np.where(letter, raw, np.uint32(_SPACE))
    keep = out != _SPACE
    keep[1:] |= keep[:-1]
    for k in range(ORDER - 1):
        keep[begin[:-1] + k] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return out[keep], kept[begin]


#: What counts as a letter: all above the ASCII range but common Latin-1 signs and general punctuation.
_LETTER = np.zeros(0x10000, dtype=bool)
_LETTER[97:123] = True
_LETTER[0xAA:] = True
_LETTER[[*range(0xAB, 0xB5), *range(0xB6, 0xBA), *range(0xBB, 0xC0), 0xD7, 0xF7]] = False
_LETTER[[*range(0x2000, 0x2070), 0x20AC, 0x2122, 0xFEFF, 0xFFFD]] = False


def grams(chars: np.ndarray, order: int, where: np.ndarray) -> np.ndarray:
    """Hashes of the ``order`` characters that end at the given positions."""
    out = np.zeros(len(where), dtype=np.uint64)
    for k in range(order):
        out += (chars[where - k].astype(np.uint64) + np.uint64(1)) * np.uint64(pow(_BASE, k + 1, 1 << 64))
    return textbytes.mixed(out ^ np.uint64(order))


def _runs(texts: list[str | textbytes.Raw | None]):
    """Runs of texts of about ``CHUNK`` bytes, decoded, with the number of the first."""
    for at, raws in textbytes.chunks(texts, CHUNK):
        yield at, [str(own, "utf-8", "replace") for own in raws]


def _starts(begin: np.ndarray, n: int) -> np.ndarray:
    """Positions that a text is scored at: all but its leading padding."""
    some = np.ones(n, dtype=bool)
    for k in range(ORDER - 1):
        some[begin[:-1] + k] = False
    return some


def _count(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The longest n-grams of the texts and how often each stands in them."""
    chars, begin = characters(texts)
    where = np.flatnonzero(_starts(begin, len(chars)))
    ids, alphabet = pd.factorize(chars)
    signs = np.array([chr(c) for c in alphabet.tolist()], dtype=object)
    if len(alphabet) > _PACKED:
        codes, columns = _by_pairs([ids[where - (ORDER - 1 - k)].astype(np.int64) for k in range(ORDER)])
    else:
        bits = max(1, len(alphabet).bit_length())
        packed = np.zeros(len(where), dtype=np.uint64)
        for k in range(ORDER):
            packed = (packed << np.uint64(bits)) | ids[where - (ORDER - 1 - k)].astype(np.uint64)
        codes, values = pd.factorize(packed)
        mask = np.uint64((1 << bits) - 1)
        columns = [((values >> np.uint64(bits * (ORDER - 1 - k))) & mask).astype(np.int64) for k in range(ORDER)]
    letters = [signs[column] for column in columns]
    return sum(letters[1:], letters[0]), np.bincount(codes, minlength=len(letters[0]))


def _by_pairs(columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers of the different rows of some columns, and the columns of these rows, when a row is too wide for 64 bits."""
    codes, rows = columns[0], [np.arange(columns[0].max(initial=-1) + 1)]
    for column in columns[1:]:
        width = int(column.max(initial=0)) + 1
        codes, pairs = pd.factorize(codes * width + column)
        rows = [own[pairs // width] for own in rows] + [pairs % width]
    return codes, rows


def _counter(batches):
    for batch in batches:
        groups = list(zip(batch.column("lang").to_pylist(), batch.column("apart").to_pylist()))
        texts = textbytes.views(batch.column("text"))
        for lang, apart in dict.fromkeys(groups):
            held: dict[str, int] = {}
            own = [text for text, group in zip(texts, groups) if group == (lang, apart)]
            for _, run in _runs(own):
                for gram, n in zip(*map(np.ndarray.tolist, _count(run))):
                    held[gram] = held.get(gram, 0) + n
            counts = pa.array(list(held.values()), pa.int64())
            zero = pa.array(np.zeros(len(held), dtype=np.int64))
            columns = [pa.array([lang] * len(held)), pa.array(list(held)), counts, zero if apart else counts]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n", "seen"])


def count_ngrams(docs: DataFrame, text: str = "text", lang: str = "lang", apart: Column | None = None) -> DataFrame:
    """``lang, gram, n, seen`` over every training text in full: batches count first, then one aggregation.

    ``seen`` leaves out the texts that are ``apart``.
    """
    rows = docs.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), (F.lit(False) if apart is None else apart).alias("apart")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    counted = rows.mapInArrow(_counter, "lang string, gram string, n bigint, seen bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


@dataclass
class KneserNey:
    """Per order the sorted hashes of seen n-grams with their probability, and of contexts with their backoff."""

    seen: list[np.ndarray]
    prob: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    floor: float

    def log2(self, chars: np.ndarray, where: np.ndarray) -> np.ndarray:
        """Bits of the characters at the given positions."""
        return -np.log2(self._probability(chars, where, ORDER))

    def _probability(self, chars: np.ndarray, where: np.ndarray, order: int) -> np.ndarray:
        if order == 0 or not len(where):
            return np.full(len(where), self.floor)
        at, hit = _find(self.seen[order - 1], grams(chars, order, where))
        out = self.prob[order - 1][at]
        unseen = where[~hit]  # only these need the shorter n-gram
        left = np.ones(len(unseen))
        context, known = _find(self.contexts[order - 1], grams(chars, order - 1, unseen - 1))
        left[known] = self.backoff[order - 1][context[known]]
        out[~hit] = left * self._probability(chars, unseen, order - 1)
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _hash_text(texts: np.ndarray, order: int) -> np.ndarray:
    if order == 0:
        return np.full(len(texts), grams(np.zeros(1, np.uint32), 0, np.zeros(1, np.int64))[0])
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return grams(chars, order, np.arange(order - 1, len(chars), order))


def build(ngrams: list[str], counts: list[int]) -> KneserNey:
    """The model from counts of the longest n-grams; lower orders count in how many contexts an n-gram is seen."""
    frame = pd.DataFrame({"gram": ngrams, "n": np.asarray(counts, dtype=float)})
    by_order: list[pd.Series] = [frame.groupby("gram")["n"].sum()]
    for order in range(ORDER - 1, 0, -1):
        longer = by_order[0]
        by_order.insert(0, pd.Series(1.0, index=longer.index.str[1:]).groupby(level=0).sum())
    letters = len(by_order[0])
    floor = 1.0 / (letters + 1)
    seen, prob, contexts, backoff = [], [], [], []
    lower: dict[str, float] = {"": floor}
    for order, table in enumerate(by_order, start=1):
        ones, twos = (table == 1).sum(), (table == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        context = table.index.str[:-1]
        groups = table.groupby(context)
        total, kinds = groups.sum(), groups.size()
        left = discount * kinds / total
        suffix = table.index.str[1:]
        base = np.fromiter((lower[x] for x in suffix), dtype=float, count=len(table)) if order > 1 else floor
        p = (table.to_numpy() - discount) / total[context].to_numpy() + left[context].to_numpy() * base
        lower = dict(zip(table.index, p))
        for keys, values, into, out in (
            (_hash_text(table.index.to_numpy(), order), p, seen, prob),
            (_hash_text(left.index.to_numpy(), order - 1), left.to_numpy(), contexts, backoff),
        ):
            ranked = np.argsort(keys)
            into.append(keys[ranked])
            out.append(values[ranked])
    return KneserNey(seen, prob, contexts, backoff, floor)


def hashed(gram: Column, order: int) -> Column:
    """Hashes of n-grams as signed numbers in the order of the unsigned ones."""

    def of(texts: pa.Array) -> pa.Array:
        keys = _hash_text(texts.to_numpy(zero_copy_only=False), order)
        return pa.array((keys ^ _SIGN).view(np.int64))

    return F.arrow_udf(of, "bigint")(gram)


_SIGN = np.uint64(1 << 63)


def _stored(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def estimates(counted: DataFrame, work: str) -> tuple[dict[str, float], DataFrame]:
    """What ``build`` computes, by Spark, from ``lang, gram, n`` of any size, for every language.

    Tables on the way are written under ``work``, which may go when the rows have been stored.

    The probability of a letter never seen by language, in order of name, and rows ``part, key, value``: ``part`` is
    ``2 * ORDER`` times the language's number and twice the order below the n-gram's, and one more for contexts. What
    is collected is a row per language.
    """
    tables = {ORDER: _stored(counted.select("lang", "gram", F.col("n").cast("double").alias("c")), f"{work}/{ORDER}")}
    for order in range(ORDER - 1, 0, -1):
        shorter = tables[order + 1].groupBy("lang", F.expr("substring(gram, 2)").alias("gram"))
        tables[order] = _stored(shorter.agg(F.count("*").cast("double").alias("c")), f"{work}/{order}")
    letters = {row.lang: row["count"] for row in tables[1].groupBy("lang").count().collect()}
    floors = {name: 1.0 / (letters[name] + 1) for name in sorted(letters)}
    spark = counted.sparkSession
    numbers = [(name, i, floor) for i, (name, floor) in enumerate(floors.items())]
    known = F.broadcast(spark.createDataFrame(numbers, "lang string, nth bigint, floor double"))
    lower, out = known.selectExpr("lang", "'' AS suffix", "floor AS base"), []
    for order, table in sorted(tables.items()):
        ones, twos = (F.count_if(F.col("c") == i) for i in (1, 2))
        rule = F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(0.5)
        discounts = F.broadcast(table.groupBy("lang").agg(rule.alias("discount")))
        split = table.select(
            "*", F.expr(f"substring(gram, 1, {order - 1})").alias("context"), F.expr("substring(gram, 2)").alias("suffix")
        )
        contexts = split.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
        contexts = contexts.join(discounts, "lang")
        left = (F.col("discount") * F.col("kinds") / F.col("total")).alias("left")
        contexts = _stored(contexts.select("lang", "context", "discount", "total", left), f"{work}/contexts-{order}")
        p = (F.col("c") - F.col("discount")) / F.col("total") + F.col("left") * F.col("base")
        found = split.join(contexts, ["lang", "context"]).join(lower, ["lang", "suffix"])
        found = _stored(found.select("lang", "gram", p.alias("p")), f"{work}/found-{order}")
        lower = found.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("base"))
        for kind, frame, gram, length, value in (
            (0, found, "gram", order, "p"),
            (1, contexts, "context", order - 1, "left"),
        ):
            part = F.col("nth") * (2 * ORDER) + 2 * (order - 1) + kind
            out.append(
                frame.join(known, "lang").select(
                    part.alias("part"), hashed(F.col(gram), length).alias("key"), F.col(value).alias("value")
                )
            )
    rows = out[0]
    for frame in out[1:]:
        rows = rows.unionByName(frame)
    return floors, rows


def store(counted: DataFrame) -> tuple[list[str], Stored]:
    """Languages and models over all n-grams, written sorted to the shared folder and offered to every executor."""
    spark = counted.sparkSession
    folder = run_dir(spark, "langid")
    floors, rows = estimates(counted, f"{folder}-work")
    rows.orderBy("part", "key").write.parquet(folder)
    delete(spark, f"{folder}-work")
    files = sorted(spark.read.schema(rows.schema).parquet(folder).inputFiles())
    for file in files:
        spark.sparkContext.addFile(file)
    return list(floors), Stored(os.path.basename(folder), [os.path.basename(file) for file in files], list(floors.values()))


@dataclass
class Stored:
    """The models of all languages, in files; what travels to a task is their names."""

    name: str
    files: list[str]
    floors: list[float]

    def __iter__(self):
        keys, values, ends = _mapped(self.name, tuple(self.files), 2 * ORDER * len(self.floors))
        for i, floor in enumerate(self.floors):
            at = [slice(ends[j], ends[j + 1]) for j in range(2 * ORDER * i, 2 * ORDER * (i + 1))]
            own, contexts = at[0::2], at[1::2]
            yield KneserNey(
                [keys[x] for x in own], [values[x] for x in own],
                [keys[x] for x in contexts], [values[x] for x in contexts], floor,
            )


@lru_cache(maxsize=1)
def _mapped(name: str, files: tuple[str, ...], parts: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Keys and values of all parts one after another, mapped, and where each part begins and the last one ends.

    The first process of an executor that asks turns the stored files, batch by batch, into two array files beside them.
    """
    base = os.path.join(SparkFiles.getRootDirectory(), name)
    with open(f"{base}.lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(f"{base}.ends.npy"):
            counts = np.zeros(parts + 1, dtype=np.int64)
            with open(f"{base}.keys", "wb") as keys, open(f"{base}.values", "wb") as values:
                for file in files:
                    with pq.ParquetFile(SparkFiles.get(file)) as stored:
                        for batch in stored.iter_batches():
                            counts[1:] += np.bincount(batch["part"].to_numpy(), minlength=parts)
                            keys.write((batch["key"].to_numpy().view(np.uint64) ^ _SIGN).tobytes())
                            values.write(batch["value"].to_numpy().tobytes())
            np.save(f"{base}.new.npy", np.cumsum(counts))
            os.replace(f"{base}.new.npy", f"{base}.ends.npy")
    keys, values = (np.memmap(f"{base}.{x}", kind, "r") for x, kind in (("keys", np.uint64), ("values", np.float64)))
    return keys, values, np.load(f"{base}.ends.npy").tolist()


@dataclass
class Model:
    langs: list[str]
    tables: list[KneserNey] | Stored
    accept: list[float]
    slope: float = 1.0

    def bits(self, run: list[str]) -> np.ndarray:
        """Cross-entropy in bits per character, a row per text, a column per language."""
        chars, begin = characters(run)
        where = np.flatnonzero(_starts(begin, len(chars)))
        codes, _ = pd.factorize(grams(chars, ORDER, where))
        first = np.zeros(codes.max() + 1 if len(codes) else 0, dtype=np.int64)
        first[codes[::-1]] = where[::-1]  # each distinct n-gram is looked up once
        counts = np.diff(begin) - (ORDER - 1)
        owner = np.repeat(np.arange(len(run)), counts)
        out = np.zeros((len(run), len(self.langs)))
        for i, own in enumerate(self.tables):
            if len(first):
                total = np.bincount(owner, weights=own.log2(chars, first)[codes], minlength=len(run))
                out[:, i] = total / np.maximum(counts, 1)
        return out

    def predict(self, texts: list[str | textbytes.Raw | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores (0 to 1) and acceptance; unknown, 0 and refused for a text without a letter."""
        lang = [UNKNOWN] * len(texts)
        score, accepted = np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
        for at, run in _runs(texts):
            some = [i for i, text in enumerate(run) if any(map(str.isalpha, text))]
            if not some or not self.langs:
                continue
            bits = self.bits([run[i] for i in some])
            best = bits.argmin(axis=1)
            where = at + np.array(some)
            n = np.minimum([len(run[i]) for i in some], 200)
            weights = np.exp2(-np.clip((bits - bits.min(axis=1, keepdims=True)) * n[:, None], 0, 200))
            score[where] = 1 / weights.sum(axis=1)
            accepted[where] = bits.min(axis=1) <= np.array(self.accept)[best]
            for i, k in zip(where, best):
                lang[i] = self.langs[k]
        return lang, score, accepted


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Models of all languages of the documents outside the held-out part, from all their texts in full.

    The texts are counted once. Models of the texts outside the calibration part code the texts in it, in one pass
    for all languages; the models returned are those of all texts. So no language is lost, however
    few its texts are; one without calibration texts that its own model wins is always accepted. Null texts and
    languages teach nothing, repeated rows count as often as they stand there, and without any rows there is no language.
    """
    known = docs.where(~held_out(F.col(doc_id)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    apart = F.pmod(F.xxhash64(doc_id), F.lit(CALIBRATION_PART)) == 0
    work = run_dir(docs.sparkSession, "langid-counts")
    counted = _stored(count_ngrams(known, text, lang, apart), work)
    langs, tables = store(counted.where("seen > 0").select("lang", "gram", F.col("seen").alias("n")))
    trial = Model(langs, tables, [np.inf] * len(langs))
    won = known.where(apart).select(F.col(lang).alias("own"), coded(trial, F.col(text)).alias("found"))
    bits = F.when(F.col("own") == F.col("found.lang"), F.col("found.bits"))
    most = won.groupBy("own").agg(F.percentile_approx(bits, F.lit(ACCEPT_SHARE), F.lit(10_000)).alias("most"))
    accept = {row.own: row.most for row in most.collect() if row.most is not None}
    langs, tables = store(counted)
    delete(docs.sparkSession, work)
    return Model(langs, tables, [accept.get(name, np.inf) for name in langs])


def coded(model: Model, text: Column) -> Column:
    """``lang, bits`` of whole texts: the language that wins, and its bits per character; null without a letter."""

    def of(texts: pa.Array) -> pa.Array:
        langs: list[str | None] = [None] * len(texts)
        least = np.zeros(len(texts))
        for at, run in _runs(textbytes.views(texts)):
            some = [i for i, own in enumerate(run) if any(map(str.isalpha, own))]
            if some and model.langs:
                bits = model.bits([run[i] for i in some])
                least[at + np.array(some)] = bits.min(axis=1)
                for i, k in zip(some, bits.argmin(axis=1)):
                    langs[at + i] = model.langs[k]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(least)], names=["lang", "bits"])

    return F.arrow_udf(of, "lang string, bits double")(text)


def predict(model: Model, text: Column) -> Column:
    """``lang_pred, score, accepted`` of whole texts."""

    def of(texts: pa.Array) -> pa.Array:
        found = model.predict(textbytes.views(texts))
        return pa.StructArray.from_arrays([pa.array(x) for x in found], names=["lang_pred", "score", "accepted"])

    return F.arrow_udf(of, "lang_pred string, score double, accepted boolean")(text)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``lang_score`` and ``lang_accepted``; columns of these names are replaced.

    Null texts and texts without a letter are ``und``, score 0, not accepted. A text is not accepted
    if the best model codes it worse than nearly all calibration texts of its language; ties of languages go to the first
    language in order of name. Repeated rows and other columns are kept.
    """
    out = docs.select(
        whole(docs, "lang_pred", "lang_score", "lang_accepted"), predict(model, column(text)).alias("found")
    )
    found = F.col("found")
    return out.select(
        "row.*",
        found["lang_pred"].alias("lang_pred"),
        found["score"].alias("lang_score"),
        found["accepted"].alias("lang_accepted"),
    )
