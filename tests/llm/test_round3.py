"""Conversation repair, sharding and collocations, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wattline.llm import collocations, repair, sharding, textbytes

# -- runs of words in short chunks


@pytest.mark.parametrize("width", range(1, 14))
def test_runs_of_short_chunks_are_those_of_a_loop(width):
    for n in range(7):
        for split in range(n + 1):
            texts = [" ".join(f"w{i}" for i in range(split)), " ".join(f"w{i}" for i in range(split, n))]
            ((_, raws),) = textbytes.chunks(texts)
            cut = textbytes.tokenize(raws)
            runs, first = textbytes.rolling(cut.hashes(), cut.first, width)
            want = [max(1, k - width + 1) if k else 0 for k in (split, n - split)]
            assert [int(b - a) for a, b in zip(first, first[1:])] == want and len(runs) == sum(want)
            assert len(set(runs.tolist())) == len(runs)


# -- conversation repair

TURNS = "conv_id bigint, turn bigint, role string, text string"


def fault_of(rows):
    """Rows of one conversation in order, with their first fault."""
    seen, out = set(), []
    for turn, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def brute_audit(rows):
    """The cheapest audit, ASCII-least, by walking from the end and comparing whole strings."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    far = (10**9, "")
    best = {"": (0, ""), "s": far, "u": far, "a": (0, "")}

    def inserts(best):
        for _ in range(4):
            for state, after in itertools.product(steps, "ua"):
                if after in steps[state]:
                    cost, audit = best[after]
                    best[state] = min(best[state], (cost + 2, "I" + audit))
        return best

    best = inserts(best)
    for _, role, _, fault in reversed(rows):
        cut, new = fault == "truncated", {}
        for state in steps:
            ways = [(best[state][0] + 3, "D" + best[state][1])]
            if fault not in ("blank", "duplicate"):
                for initial, after in steps[state].items():
                    cost, audit = best[after]
                    if initial in "ua":
                        ways.append((cost + 2 + cut, "R" + audit))
                    if role[:1] == initial:
                        ways.append((cost + cut, "K" + audit))
            new[state] = min(ways)
        best = inserts(new)
    return best[""]


def apply_audit(rows, audit):
    out, rest = [], list(rows)
    for edit in audit:
        row = None if edit == "I" else rest.pop(0)
        if edit == "D":
            continue
        role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((row[1] if edit == "K" else role, row[2] if row else ""))
    return out


def brute_summary(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    marked = fault_of(rows)
    cost, audit = brute_audit(marked)
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    kinds = Counter(r[3] for r in marked)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    said = "\n".join(f"{role}:{text}" for role, text in apply_audit(marked, audit))
    sha = hashlib.sha256(said.encode()).hexdigest()
    return gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, sha


def some_conversations(rng, n, longest):
    rows = []
    for conv in range(n):
        for _ in range(rng.randint(0, longest)):
            role = rng.choice(["system", "user", "assistant", "tool", "user", "assistant"])
            text = rng.choice(["Yes.", "No!", "cut off", " ", "", "Why?", f"t{rng.randrange(9)}.", "\tx.\n"])
            rows.append((conv, rng.choice([None, *range(12)]), role, text))
    return rows


def summaries(frame, **options):
    return {r[0]: tuple(r)[1:] for r in repair.audits(frame, **options).collect()}


def test_audits_are_brute_force(spark):
    rows = some_conversations(random.Random(4), 150, 9)
    own = defaultdict(list)
    for conv, *row in rows:
        own[conv].append(tuple(row))
    frame = spark.createDataFrame(rows, TURNS).repartition(5)
    assert summaries(frame) == {conv: brute_summary(mine) for conv, mine in own.items()}


def test_a_long_conversation_is_settled_on_the_way(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "cut", "", f"t{i}."])) for i in range(1500)]
    frame = spark.createDataFrame(rows, TURNS)
    want = brute_summary([row[1:] for row in rows])
    assert summaries(frame) == {1: want}
    walk, held = repair.Walk(), 0
    for _, role, _, fault in fault_of([row[1:] for row in rows]):
        walk.turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated", (role, "", None))
        walk.settled()
        held = max(held, len(walk.tree.edit))
    assert held < 4 * repair.FLUSH  # not the conversation's length


def test_repaired_turns_are_the_audit(spark):
    rows = some_conversations(random.Random(8), 30, 7)
    frame = spark.createDataFrame(rows, TURNS)
    edits, lines = defaultdict(str), defaultdict(list)
    for r in sorted(repair.repaired(frame).collect(), key=lambda r: (r.conv_id, r.place)):
        edits[r.conv_id] += r.edit
        if r.role is not None:
            lines[r.conv_id].append(f"{r.role}:{r.text}")
    whole = summaries(frame)
    assert {conv: row[6] for conv, row in whole.items()} == dict(edits)
    for conv, row in whole.items():
        assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == row[7]
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines[conv]))


def test_equal_hashes_do_not_decide(monkeypatch):
    monkeypatch.setattr(repair, "_MOD", 1)  # every hash is 0
    rng = random.Random(2)
    tree = repair.Audits()
    nodes = {0: ""}
    for _ in range(200):
        parent = rng.choice(list(nodes))
        edit = rng.choice("DIKR")
        nodes[tree.add(parent, edit)] = nodes[parent] + edit
    for a, b in itertools.product(rng.sample(list(nodes), 60), repeat=2):
        assert tree.less(a, b) == (nodes[a] < nodes[b])


def test_repair_of_odd_tables(spark):
    nothing = hashlib.sha256(b"").hexdigest()
    assert repair.audits(spark.createDataFrame([], TURNS)).collect() == []
    rows = [(None, None, None, None), (None, None, None, None), (3, 1, "user", "Hi.")]
    frame = spark.createDataFrame(rows, TURNS).withColumn("fault", F.lit(1)).withColumn("here", F.lit("x")).withColumn("digest", F.lit(2))
    assert summaries(frame)[None] == (0, 2, 0, 0, 1, 6, "DD", nothing)
    assert summaries(frame)[3][5:7] == (2, "KI")
    gone = spark.createDataFrame([(7, 1, "user", "a", False)], TURNS + ", kept boolean")
    assert summaries(gone, here="kept") == {7: (0, 0, 0, 0, 0, 0, "", nothing)}


# -- sharding


def dealt(frame, n=8, **options):
    found = sharding.shards(frame, n, sharding.text_key(F.col("text")), sharding.text_size(F.col("text")), **options)
    return found.collect()


def check_shards(rows, n, whole):
    total = sum(r.size for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    most = max(r.size for r in rows)
    for s in range(n):
        assert abs(sum(r.size for r in by[s]) - total / n) <= most + whole * total / n + 1


def test_shards_of_a_hot_key_and_long_texts(spark, docs):
    rng = random.Random(1)
    texts = ["hot text"] * 400 + ["x" * rng.choice([3, 30, 300]) + str(i) for i in range(700)] + ["long " * 900, None, "", ""]
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, "n"), (5, "hot text"), (5, "hot text")]
    frame = docs(*rows)
    for range_rows in (10_000, 40, 3):
        got = dealt(frame, range_rows=range_rows)
        assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
        check_shards(got, 8, sharding.WHOLE_GROUP)
    places = lambda found: sorted((repr(r.doc_id), r.size, r.shard, r.slot) for r in found)
    assert len({tuple((i, s) for i, s, _, _ in places(dealt(frame.repartition(k), range_rows=r))) for k, r in ((1, 50), (7, 9))}) == 1


def test_ranges_are_subdivided(spark):
    rows = [("a" * 16 + f"{i:032x}", 1) for i in range(500)] + [("b" * 48, 100_000)] + [("c" * 16 + f"{i:032x}", 1) for i in range(500)]
    frame = spark.createDataFrame(rows, "place string, size bigint")
    found = sharding.ranges(frame, range_rows=20).groupBy("range").agg(F.count("*").alias("n"), F.max("place").alias("most"))
    got = sorted((r["range"], r.n, r.most) for r in found.collect())
    assert sum(n for _, n, _ in got) == 1001 and [most for _, _, most in got] == sorted(most for _, _, most in got)
    assert max(n for _, n, _ in got) <= 4 * 20 + 1


def test_groups_below_the_bound_stay_together(spark, docs):
    rows = [(i, f"group {i // 4}") for i in range(4000)]
    got = dealt(docs(*rows), range_rows=300)
    shards_of = defaultdict(set)
    for r in got:
        shards_of[r.doc_id // 4].add(r.shard)
    assert all(len(s) == 1 for s in shards_of.values())


def test_shards_of_odd_tables(docs):
    assert dealt(docs()) == []
    got = dealt(docs((1, None), (1, None)).withColumn("range", F.lit("x")).withColumn("place", F.lit(3)))
    assert sorted((r.size, r.slot >= 0) for r in got) == [(1, True), (1, True)]


# -- collocations


def brute_phrases(rows, longest=3, least=10, absorb=50):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(low)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang in f:
        some = {g: a for g, a in f[lang].items() if len(g) > 1 and a >= least}
        for g, a in some.items():
            if any(
                len(q) > len(g) and 100 * b >= absorb * a and any(q[i : i + len(g)] == g for i in range(len(q)))
                for q, b in some.items()
            ):
                continue
            score, k = min((10**6 * a * a // (f[lang][g[:k]] * f[lang][g[k:]]), k) for k in range(1, len(g)))
            out.append((lang, " ".join(g), a, f[lang][g[:k]], f[lang][g[k:]], n[lang], score))
    return sorted(out)


def found_phrases(frame, **options):
    rows = collocations.collocations(frame, **options).collect()
    return sorted((r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows)


@pytest.fixture
def corpus():
    rng = random.Random(6)
    words = ["the", "of", "New", "York", "City", "é", "ß", "x y", "\x01", "a-b", "ça", "Z"]
    make = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " "]) for _ in range(n))
    rows = [(make(rng.randint(0, 60)), rng.choice(["en", "en", "fr", None, "und"])) for _ in range(80)]
    rows += [("New York City " * 30, "en"), (None, "en"), ("", None), ("...", "zz"), (make(4000), "en"), ("a a a a " * 9, "de")]
    return rows


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases_are_brute_force(spark, corpus, longest):
    frame = spark.createDataFrame(corpus, "text string, lang string").withColumn("w1", F.lit(1)).withColumn("f", F.lit("x"))
    want = brute_phrases(corpus, longest)
    assert len(want) > 30 and found_phrases(frame, longest=longest) == want


def test_ranges_chunks_and_full_bits_change_nothing(spark, corpus, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 200)
    monkeypatch.setattr(collocations, "MOST_BITS", 64)  # every bit is set: all phrases pass to the exact counts
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set(coalesce, "false")
    try:
        assert found_phrases(spark.createDataFrame(corpus, "text string, lang string")) == brute_phrases(corpus)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset(coalesce)


def test_long_texts_are_cut_between_pieces():
    text = b"one two. three " * 50 + b"four" * 30 + b"! five"
    parts = list(collocations._cut_long(memoryview(text), 64))
    assert b"".join(parts) == text and len(parts) > 5
    assert all(bytes(part)[-1:] in b".!" for part in parts[:-1])


def test_products_beyond_64_bits(spark):
    rows = [(4_000_000_000_000, 5_000_000_000_000, 6_000_000_000_000)]
    a, left, right = rows[0]
    frame = spark.createDataFrame(rows, "a bigint, l bigint, r bigint")
    assert frame.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (left * right)


def test_best_of_each(spark):
    rows = [("en", f"p{i:03}", i % 7, i % 5) for i in range(200)] + [("fr", "q", 1, 1)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, a bigint, score bigint")
    got = {(r.lang, r["rank"]): r.phrase for r in collocations.best_of_each(frame, top=20, salts=3).collect()}
    order = sorted((r for r in rows if r[0] == "en"), key=lambda r: (-r[3], -r[2], r[1]))
    assert got == {("en", i): r[1] for i, r in enumerate(order[:20], 1)} | {("fr", 1): "q"}


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert found_phrases(empty) == [] and found_phrases(spark.createDataFrame([(None, None), ("a b", "en")], empty.schema)) == []
