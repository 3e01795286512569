"""The Jaccard join against all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from wattline.llm import jaccard, textbytes
from wattline.llm.common import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def grams(text, n=5):
    own = words(text)
    return {tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))} if own else set()


def brute(rows):
    sets = [grams(text) for _, text in rows]
    near = [
        {j for j in range(len(rows)) if j != i and a and sets[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j])}
        for i, a in enumerate(sets)
    ]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            todo += [k for k in near[todo.pop()] if k not in seen and not seen.add(k)]
        ids = [rows[k][0] for k in seen]
        out.append((rows[i][0], None if None in ids else min(ids), len(near[i])))
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.near_duplicates(frame).collect()), key=repr)


@pytest.fixture
def corpus():
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = []
    for size in (9, 40, 60, 200):
        for _ in range(4):
            base = [rng.choice(vocabulary) for _ in range(size)]
            texts.append(" ".join(base))
            for _ in range(6):
                other = list(base)
                for _ in range(rng.randint(0, 1 + size // 30)):
                    other[rng.randrange(size)] = rng.choice(vocabulary)
                texts.append(" ".join(other).title() if rng.random() < 0.2 else " ".join(other))
    texts += ["one two three", "One, two THREE!", "one two", "", "", None, "...", "a"]
    return texts


def test_words_and_runs_are_those_of_the_pattern():
    texts = ["Hello, wörld! ÉT x9", None, "", "a b c d e f g", "  one", " ... ", "A B c d e f g h", "\x00Zß\x7f"]
    ((_, raws),) = textbytes.chunks(texts)
    cut = textbytes.tokenize(raws)
    got = [bytes(cut.low[s:e]).decode() for s, e in zip(cut.start, cut.end)]
    assert got == [word for text in texts for word in words(text)]
    hashes = cut.hashes()
    assert len(set(hashes.tolist())) == len(set(got))
    runs, first = textbytes.rolling(hashes, cut.first, 5)
    assert np.diff(first).tolist() == [len(grams(text)) for text in texts]
    assert len(set(runs.tolist())) == len(set().union(*map(grams, texts)))


def test_chunks_take_every_text_once():
    texts = ["x" * n for n in (5, 0, 30, 1, 1, 1, 12)] + [None]
    parts = list(textbytes.chunks(texts, 10))
    assert [bytes(raw).decode() for _, raws in parts for raw in raws] == [text or "" for text in texts]
    assert [at for at, _ in parts] == list(np.cumsum([0, *[len(raws) for _, raws in parts]]))[:-1]


def test_bands_reach_the_recall():
    bands, rows = jaccard.choose_bands(0.8, 0.9999, 192)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 192


def test_all_pairs(docs, corpus):
    rows = list(enumerate(corpus)) + [(3, corpus[3]), (None, corpus[8]), (500, corpus[40])]
    assert found(docs(*rows)) == brute(rows)


def test_blocks_and_shuffles_change_nothing(docs, corpus, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", 3)
    monkeypatch.setattr(jaccard, "PACK", 5)
    monkeypatch.setattr(jaccard, "BROADCAST_BOUND", 0)
    rows = list(enumerate(corpus))
    assert found(docs(*rows)) == brute(rows)


def test_one_of_each_class_stays(docs, corpus):
    rows = list(enumerate(corpus)) + [(3, corpus[3])]
    frame = docs(*rows).withColumnRenamed("n_chars", "copy")
    kept = jaccard.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    want = {class_id for _, class_id, _ in brute(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_nothing(docs):
    assert found(docs()) == []
    assert found(docs(None, "")) == [(0, 0, 0), (1, 1, 0)]


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, rng.randrange(501, 600)) for _ in range(50)] + [(7, 7), (None, 3)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {n: 100 for n in range(100, 161)} | {n: 500 for e in edges if e[0] == 500 for n in e}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
