"""Benchmark decontamination: test n-grams are looked up in every window of the training texts.

The hashes of all benchmark windows are a literal set inside the scan, so a document's windows are tested where it is
read and only windows that hit leave the row. Hits are then verified by joining their words with the benchmark's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import INSIDE, OUTSIDE, bind, column, cut, sized_broadcast, whole, words

#: Words in a window; a shorter item is one window of its own length.
NGRAM = 13
#: A document is contaminated if it has a hit and at least one word in so many is hit.
ONE_IN = 20
#: Most window hashes that are put into the plan as a set (8 MB), and most windows that are broadcast to verify hits.
#: Beyond the first every window goes to the verifying join; beyond the second that join is shuffled.
SET_BOUND = 1_000_000
BROADCAST_BOUND = 200_000


def windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", ngram: int = NGRAM) -> DataFrame:
    """Distinct windows of the benchmark: ``window`` (words joined by spaces), ``length``, ``hash``, ``items``."""

    def cut_up(all_words: Column) -> Column:
        length = F.least(F.lit(ngram), F.size(all_words))
        starts = F.sequence(F.lit(1), F.size(all_words) - length + 1)
        return F.transform(starts, lambda i: F.slice(all_words, i, length))

    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("words"))
    cut_items = items.where(F.size("words") > 0).select(
        "item", F.explode(bind(F.col("words"), cut_up)).alias("window")
    )
    return cut_items.groupBy(
        F.array_join("window", " ").alias("window"),
        F.size("window").alias("length"),
        F.xxhash64(F.transform("window", lambda word: F.xxhash64(word))).alias("hash"),
    ).agg(F.collect_set("item").alias("items"))


def _scan(text: Column, sets: dict[int, list[int]], prefilter: bool) -> Column:
    """``n_words`` and the windows that may hit, each with its position, length and words."""

    def found(all_words: Column, hashes: Column, length: int, wanted: list[int]) -> Column:
        starts = F.when(
            F.size(hashes) >= length, F.sequence(F.lit(1), F.size(hashes) - length + 1)
        ).otherwise(F.array().cast("array<int>"))
        if prefilter:
            starts = F.filter(starts, lambda i: F.xxhash64(F.slice(hashes, i, length)).isin(wanted))
        return F.transform(
            starts,
            lambda i: F.struct(
                i.alias("start"),
                F.lit(length).alias("length"),
                F.array_join(F.slice(all_words, i, length), " ").alias("window"),
            ),
        )

    def scan(all_words: Column) -> Column:
        hits = bind(
            F.transform(all_words, lambda word: F.xxhash64(word)),
            lambda hashes: F.concat(*[found(all_words, hashes, n, wanted) for n, wanted in sorted(sets.items())]),
        )
        return F.struct(F.size(all_words).cast("long").alias("n_words"), hits.alias("hits"))

    return F.transform(F.array(words(text)), scan)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    ngram: int = NGRAM,
    one_in: int = ONE_IN,
) -> DataFrame:
    """One row per document row: ``doc_id, digest, n_words, n_hit, spans, items, n_items, contaminated``.

    ``spans`` are the hits as (start, length) in words from 1, in order; ``items`` the ids found, sorted as strings.
    Null or empty texts have no words and are never contaminated; items without words have no windows; an empty
    benchmark contaminates nothing. Repeated rows give repeated results, null ids are kept, and documents with one id
    but different texts are told apart by ``digest``, a hash of the text. A text may be of any length: what leaves its
    row are its hits.
    """
    known = windows(benchmark, item_id, "text", ngram)
    rows = known.select("length", "hash").distinct().limit(SET_BOUND + 1).collect()
    prefilter = len(rows) <= SET_BOUND
    lengths = sorted(row.length for row in known.select("length").distinct().collect())
    sets = {n: [row.hash for row in rows if row.length == n] if prefilter else [] for n in lengths}
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if sets:
        scanned = base.select("doc_id", F.xxhash64("text").alias("digest"), F.inline(_scan(F.col("text"), sets, prefilter)))
    else:
        nothing = F.array().cast("array<struct<start:int,length:int,window:string>>")
        scanned = base.select(
            "doc_id",
            F.xxhash64("text").alias("digest"),
            F.size(words(F.col("text"))).cast("long").alias("n_words"),
            nothing.alias("hits"),
        )
    hits = scanned.select("doc_id", "digest", "n_words", F.posexplode_outer("hits").alias("nth", "hit"))
    verified = hits.withColumn("window", F.col("hit.window")).join(
        sized_broadcast(known.select("window", "items"), len(rows), BROADCAST_BOUND), "window", "left"
    )
    span = F.when(F.col("items").isNotNull(), F.struct("hit.start", "hit.length"))
    grouped = verified.groupBy("doc_id", "digest", "n_words").agg(
        F.count(F.when(F.coalesce(F.col("nth"), F.lit(0)) == 0, 1)).alias("copies"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda done, s: F.struct(
            F.greatest(done["end"], s["start"] + s["length"]).alias("end"),
            (done["n"] + F.greatest(F.lit(0), s["start"] + s["length"] - F.greatest(done["end"], s["start"]))).alias("n"),
        ),
        lambda done: done["n"].cast("long"),
    )
    n_hit = F.col("n_hit")
    return (
        grouped.withColumn("n_hit", covered)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (n_hit > 0) & (one_in * n_hit >= F.col("n_words")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .drop("copy", "copies")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, all columns and repeated rows kept."""
    found = contamination(docs, benchmark, doc_id, text, **options).where("contaminated")
    bad = cut(found.select(F.col("doc_id").alias("bad_id"), F.col("digest").alias("bad_digest")).distinct())
    rows = docs.select(whole(docs), column(doc_id).alias("id"), F.xxhash64(column(text)).alias("digest"))
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("digest") == F.col("bad_digest"))
    # the few that go are sent to the documents, so that no text is shuffled
    return rows.join(sized_broadcast(bad, bad.count(), BROADCAST_BOUND), same, "left_anti").select("row.*")


def remove_spans(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All documents, with every hit word and the separators after it cut out of the text; other columns kept.

    A text without hits is returned unchanged.
    """
    found = contamination(docs, benchmark, doc_id, text, **options).where("n_hit > 0")
    spans = found.select(
        F.col("doc_id").alias("hit_id"), F.col("digest").alias("hit_digest"), F.col("spans").alias("hit_spans")
    ).dropDuplicates(["hit_id", "hit_digest"])
    rows = docs.select(
        whole(docs), column(doc_id).alias("id"), column(text).alias("text"), F.xxhash64(column(text)).alias("digest")
    )
    same = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("digest") == F.col("hit_digest"))
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"({INSIDE}+{OUTSIDE}*)"), F.lit(1))
    lead = F.regexp_extract(F.col("text"), f"^({OUTSIDE}*)", 1)
    covered = F.array_distinct(
        F.flatten(
            F.transform("hit_spans", lambda s: F.sequence(s["start"] - 1, s["start"] + s["length"] - 2))
        )
    )
    kept = bind(
        F.map_from_arrays(covered, F.transform(covered, lambda i: F.lit(True))),
        lambda hit: F.filter(pieces, lambda piece, i: ~F.map_contains_key(hit, i)),
    )
    cut_text = F.when(F.col("hit_spans").isNull(), F.col("text")).otherwise(F.concat(lead, F.array_join(kept, "")))
    return rows.join(spans, same, "left").select(
        *[cut_text.alias(name) if name == text else F.col(f"row.`{name}`") for name in docs.columns]
    )
