"""Decontamination and mixing, against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattline.llm import decontaminate, mixing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def judged(text, items, ngram=13, one_in=20):
    own, hit, found = words(text), set(), set()
    for item, other in items:
        their = words(other)
        n = min(ngram, len(their))
        wins = {tuple(their[i : i + n]) for i in range(len(their) - n + 1)} if n else set()
        for i in range(len(own) - n + 1 if n else 0):
            if tuple(own[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(own), len(hit), sorted(found), len(hit) > 0 and one_in * len(hit) >= len(own)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def outcome(frame):
    rows = frame.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted(((r[0], r[1], r[2], list(r[3]), r[4]) for r in rows), key=repr)


@pytest.fixture
def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "über", "x9"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(10, make(30)), (2, make(13)), (3, make(5)), (4, "Only"), (5, ""), (6, None), (7, "... !")]
    texts = [make(rng.randint(0, 80)) for _ in range(20)]
    texts += [f"{make(10)}, {items[0][1].upper()}. {make(200)}", f"{make(400)} {items[2][1]}", items[1][1], "only ONLY", "", None]
    texts += [make(30000) + " " + items[0][1]]
    return texts, items


def test_contamination_is_brute_force(spark, docs, corpus):
    texts, items = corpus
    rows = [(i % 24, text) for i, text in enumerate(texts)] + [(None, "only"), (5, texts[5]), (5, texts[5])]
    want = sorted(((i, *judged(text, items)[:2], *judged(text, items)[2:]) for i, text in rows), key=repr)
    assert outcome(decontaminate.contamination(docs(*rows), bench(spark, items))) == want


def test_beyond_the_bounds_the_result_is_the_same(spark, docs, corpus, monkeypatch):
    texts, items = corpus
    frame = docs(*texts[-9:])
    before = outcome(decontaminate.contamination(frame, bench(spark, items)))
    monkeypatch.setattr(decontaminate, "SET_BOUND", 3)
    monkeypatch.setattr(decontaminate, "BROADCAST_BOUND", 0)
    assert outcome(decontaminate.contamination(frame, bench(spark, items))) == before


def test_empty_tables(spark, docs):
    assert outcome(decontaminate.contamination(docs("a b"), bench(spark, []))) == [(0, 2, 0, [], False)]
    assert outcome(decontaminate.contamination(docs(), bench(spark, [(1, "a")]))) == []


def test_contaminated_documents_go_and_all_else_stays(spark, docs):
    frame = docs((1, "say hello"), (1, "clean"), (2, None), (3, "clean"), (3, "clean"), (None, "hello")).withColumn(
        "items", F.lit(1)
    )
    kept = decontaminate.drop_contaminated(frame, bench(spark, [(1, "Hello")]))
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "clean"), (2, None), (3, "clean"), (3, "clean")]


def test_spans_are_cut_out(spark, docs):
    frame = docs("--One, TWO three! four  end.", "nothing", None, "")
    cut = decontaminate.remove_spans(frame, bench(spark, [(1, "two three"), (2, "three Four")]))
    assert sorted(((r.doc_id, r.text) for r in cut.collect())) == [(0, "--One, end."), (1, "nothing"), (2, None), (3, "")]


def deviations(weights, blocks):
    """While all sources last: the greatest deviation of any source, at any slot, from its target weight, in blocks."""
    slots = mixing.schedule(mixing.parts_of(weights), blocks)
    assert sorted(x for one in slots for x in one) == list(range(sum(blocks)))
    total, most, last = sum(weights), 0.0, min(one[-1] for one in slots if one)
    for weight, one in zip(weights, slots):
        done = 0
        for slot in [*[x for x in one if x <= last], last + 1]:
            most = max(most, abs(done - slot * weight / total), abs(done + (slot <= last) - (slot + (slot <= last)) * weight / total))
            done += 1
    return most


def test_pfair_deviation_is_below_one_block():
    rng = random.Random(1)
    for _ in range(40):
        weights = [rng.random() ** 3 for _ in range(rng.randint(1, 15))]
        assert deviations(weights, [rng.randint(1, 80) for _ in weights]) < 1
    assert deviations([0.9995, 0.0005], [6000, 3]) < 1
    thousand = [0.5002] + [0.4998 / 999] * 999
    assert deviations(thousand, [5002] + [6] * 999) < 1
    assert mixing.parts_of([0.9995, 0.0005])[1] / mixing.PARTS == pytest.approx(0.0005, abs=1e-12)


def test_when_a_source_runs_out_the_others_go_on_in_proportion():
    slots = mixing.schedule(mixing.parts_of([0.0, 3, 1, 8]), [4, 30, 20, 2])
    assert slots[0] == list(range(52, 56))
    begun = slots[3][-1] + 1
    for slot in range(begun, 40):
        assert abs(sum(begun <= x < slot for x in slots[1]) - 0.75 * (slot - begun)) < 1


def test_mix_keeps_every_row_and_follows_the_weights(spark, docs, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    rows = [(i, f"t{i}", "en", "a" if i % 3 else "b") for i in range(300)] + [(7, "x", "en", None), (None, None, "en", "a")]
    frame = docs(*rows, *rows[:5]).withColumn("mix_pos", F.lit("clash"))
    mixed = mixing.mix(frame, {"a": 3.0, "b": 1.0}, block_rows=4).orderBy("mix_slot", "mix_pos").collect()
    assert Counter((r.doc_id, r.text, r.source) for r in mixed) == Counter((r[0], r[1], r[3]) for r in [*rows, *rows[:5]])
    assert len({(r.mix_slot, r.mix_pos) for r in mixed}) == len(mixed)
    assert {r.mix_slot for r in mixed} == set(range(max(r.mix_slot for r in mixed) + 1))
    shares = {r.source: r.mix_share for r in mixed}
    assert shares["a"] == pytest.approx(0.75) and shares[None] < 1e-9 and mixed[-1].source is None
    last = min(max(r.mix_slot for r in mixed if r.source == s) for s in "ab")
    for t in range(1, last):
        for s in "ab":
            done = len({r.mix_block for r in mixed if r.source == s and r.mix_slot < t})
            assert abs(done - shares[s] * t) < 1


def test_blocks_grow_with_the_corpus(docs, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 5)
    rows = mixing.mix(docs(*[(i, "t", "en", "ab"[i % 2]) for i in range(200)])).collect()
    assert len({r.mix_slot for r in rows}) <= 7 and len(rows) == 200


def test_numbering_is_that_of_one_window(spark, docs, monkeypatch):
    frame = docs(*[(i * 7, f"t{i}", "en", "hot") for i in range(120)])
    place = lambda: sorted((r.doc_id, r.mix_slot, r.mix_pos) for r in mixing.mix(frame).collect())
    whole = place()
    monkeypatch.setattr(mixing, "RANGE_ROWS", 5)
    assert place() == whole


def test_mix_of_nothing(docs):
    assert mixing.mix(docs()).collect() == []
