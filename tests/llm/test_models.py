"""Trained operators: held-out accuracy, exact brute force of their parts, and edge cases."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from wattline.llm import langid, licenses, permutation, quality, textbytes, toxicity
from wattline.llm.common import held_out, table

EMPTY_LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_part(spark):
    import zlib

    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    assert not spark.sql("SELECT CAST(NULL AS BIGINT) AS id").select(held_out(F.col("id"))).first()[0]


# toxicity


def spoken(rng, n, extra=()):
    out = [rng.choice(["la", "to", "mir", "ent", "sol", "bek", "ru"]) + rng.choice(["na", "ti", "go", ""]) for _ in range(n)]
    for word in extra:
        out[rng.randrange(n)] = word
    return " ".join(out)


@pytest.fixture(scope="module")
def toxic_corpus(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(700):
        bad = i % 5 == 0
        text = spoken(rng, rng.randint(5, 80), [f"grumf{rng.choice('abcdefghij')}{rng.choice('xyz')}"] if bad else [])
        rows.append((i, text, "ab"[i % 2], "s", len(text)))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return docs, spark.createDataFrame(labels, EMPTY_LABELS)


def test_toxicity_on_unseen_documents_and_words(toxic_corpus):
    docs, labels = toxic_corpus
    model = toxicity.fit(docs, labels)
    judged = toxicity.judge(docs, model).join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert len(judged) > 100
    assert np.mean([(r.toxicity >= 0.3) == bool(r[-1]) for r in judged]) > 0.97
    assert np.mean([r.toxic == bool(r[-1]) for r in judged]) > 0.97
    assert model.scores(["la tona grumfqq mirti " + "solna " * 30])[0] > 0.3 > model.scores(["solna ruti lago"])[0]


def test_scores_do_not_depend_on_the_batch_or_on_ids(toxic_corpus):
    docs, labels = toxic_corpus
    model = toxicity.fit(docs, labels, per_class=60)
    texts = [r.text for r in docs.limit(40).collect()] + ["", None, "!!", "grumfax", "la " * 300_000 + "grumfax"]
    together = model.scores(texts)
    assert np.allclose(together, [model.scores([t])[0] for t in texts])
    assert ((together >= 0) & (together <= 1)).all() and together[-5] == together[-4] == together[-3]
    edge = docs.limit(1).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "1 AS toxic")
    row = toxicity.judge(edge.unionAll(edge), model).collect()
    assert len(row) == 2 and row[0].toxicity == pytest.approx(together[-4]) and set(edge.columns) <= set(row[0].asDict())


def test_convolution_is_that_of_the_definition():
    rng = np.random.default_rng(0)
    model = toxicity.train(["a b", "c d"] * 30, np.array([0, 1] * 30), [None] * 60, (30, 30))
    model.filters = [rng.normal(size=w.shape).astype(np.float32) for w in model.filters]
    model.out = rng.normal(size=len(model.out))
    text = "one two three four five"
    rows = toxicity.word_features(textbytes.tokenize([text.encode()]))
    vectors = model.words[rows].mean(axis=1)
    padded = np.vstack([vectors, np.zeros((2, toxicity.DIM))])
    pooled = []
    for width, weights, bias in zip(toxicity.WIDTHS, model.filters, model.bias):
        reply = [sum(padded[t + j] @ weights[j] for j in range(width)) + bias for t in range(len(vectors))]
        pooled.append(np.maximum(np.max(reply, axis=0), 0))
    logit = np.concatenate(pooled) @ model.out[:-1] + model.out[-1]
    got = model.logits(rows, np.array([0, len(rows)]))
    assert got[0] == pytest.approx(logit, rel=1e-4)


def test_toxicity_without_labels_of_both_classes(spark, docs):
    frame = docs("a", "b", None)
    none = spark.createDataFrame([], EMPTY_LABELS)
    assert max(toxicity.fit(frame, none).scores(["a", ""])) < 1e-6
    ones = spark.createDataFrame([(i, 1, 1) for i in (0, 1)], EMPTY_LABELS)
    assert min(toxicity.fit(frame, ones).scores(["a", ""])) > 0.99
    assert toxicity.judge(docs(), toxicity.fit(docs(), none)).collect() == []


# quality


def test_quality_tells_junk_from_prose(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    judged = quality.posteriors(docs, quality.fit(docs, labels), *quality.document_site())
    rows = judged.drop("quality_evidence").join(labels.withColumnRenamed("quality", "good"), "doc_id")
    rows = rows.where(held_out(F.col("doc_id"))).collect()
    assert np.mean([r.rejected != bool(r.good) for r in rows]) > 0.9


def test_site_posteriors_are_the_formulas(spark):
    rng = random.Random(1)
    hosts = {"h0": 0.9, "h1": 0.2, "h2": 0.6, None: 0.5}
    rows = [
        (h, f"{h}/{rng.randint(0, 2)}", min(max(rng.gauss(rate, 0.1), 0.0), 1.0))
        for h, rate in hosts.items()
        for _ in range({"h0": 300, "h1": 60, "h2": 2, None: 30}[h])
    ]
    got = {(r.host, r.path): r for r in quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    n = Counter(h for h, _, _ in rows)
    s = {h: sum(p for x, _, p in rows if x == h) for h in hosts}
    mean = sum(s.values()) / len(rows)
    between = sum(n[h] * (s[h] / n[h] - mean) ** 2 for h in hosts) / len(rows)
    chance = mean * (1 - mean)

    def strength(each, spread):
        return min(max(chance / max(spread - chance / each, chance / 1e4) - 1, 1.0), 1e4)

    kappa = strength(len(rows) / len(hosts), between)
    for (host, path), row in got.items():
        own = [p for h, x, p in rows if (h, x) == (host, path)]
        assert row.n == len(own) and row.sum_p == pytest.approx(sum(own))
        assert row.host_rate == pytest.approx((s[host] + kappa * mean) / (n[host] + kappa))
    inside = sum(r.n * (r.sum_p / r.n - r.host_rate) ** 2 for r in got.values()) / len(rows)
    weight = strength(len(rows) / len(got), inside)
    assert all(r.weight == pytest.approx(weight) for r in got.values())


def test_quality_edge_rows(spark, docs):
    frame = docs((1, None), (1, None), (None, ""), (3, "word " * 200_000), (4, "%%% ### !!!", None, None)).withColumn(
        "quality", F.lit("clash")
    )
    none = spark.createDataFrame([], EMPTY_LABELS)
    for bound in (quality.BROADCAST_BOUND, 0):
        quality.BROADCAST_BOUND, before = bound, quality.BROADCAST_BOUND
        try:
            rows = quality.posteriors(frame, quality.fit(frame, none), *quality.document_site()).collect()
        finally:
            quality.BROADCAST_BOUND = before
        assert len(rows) == 5 and all(0 < r.quality < 1 and r.quality_evidence == 0 for r in rows)
    assert quality.posteriors(docs(), quality.fit(docs(), none), *quality.document_site()).collect() == []


def test_url_sites(spark):
    urls = [("https://A.b/x/y?q",), ("//h/p",), ("no url",), (None,)]
    host, path = quality.url_site()
    rows = spark.createDataFrame(urls, "url string").select(host.alias("h"), path.alias("p")).collect()
    assert [tuple(r) for r in rows] == [("a.b", "a.b/x"), ("h", "h"), ("", ""), (None, None)]


# language


def plain_kneser_ney(ngrams, context, char, order):
    """The recursive definition, straight from counts of the longest n-grams."""
    tables = {langid.ORDER: dict(ngrams)}
    for k in range(langid.ORDER - 1, 0, -1):
        tables[k] = Counter(gram[1:] for gram in tables[k + 1])
    if order == 0:
        return 1 / (len(tables[1]) + 1)
    own, context = tables[order], context[len(context) - order + 1 :]
    ones, twos = (sum(v == i for v in own.values()) for i in (1, 2))
    discount = ones / (ones + 2 * twos) if ones and twos else 0.5
    after = {g: c for g, c in own.items() if g[:-1] == context}
    lower = plain_kneser_ney(ngrams, context, char, order - 1)
    if not after:
        return lower
    total = sum(after.values())
    return max(after.get(context + char, 0) - discount, 0) / total + discount * len(after) / total * lower


def test_kneser_ney_is_the_definition():
    text = "la casa es la casa de la rosa y el oso"
    padded = " " * (langid.ORDER - 1) + text + " "
    ngrams = Counter(padded[i : i + langid.ORDER] for i in range(len(padded) - langid.ORDER + 1))
    own = langid.build(list(ngrams), list(ngrams.values()))
    model = langid.Model(["x"], [own], [0.0])
    for probe in ("la rosa", "zz", "el caso es"):
        chars = " " * (langid.ORDER - 1) + probe + " "
        bits = [
            -math.log2(plain_kneser_ney(ngrams, chars[: i], chars[i], langid.ORDER)) for i in range(langid.ORDER - 1, len(chars))
        ]
        assert model.bits([probe])[0, 0] == pytest.approx(sum(bits) / len(bits))


def test_ngram_counts_are_exact(spark, docs):
    texts = [("a", "Ab, ab  c!"), ("b", "ÉÉ 12"), ("a", ""), ("a", None), (None, "zz"), ("a", "x" * 3000)]
    frame = docs(*[(i, text, lang) for i, (lang, text) in enumerate(texts)])
    want = Counter()
    for lang, text in texts:
        if lang and text is not None:
            letters = "   " + re.sub(r"[^a-zà-öø-ÿ]+", " ", text.lower()).lstrip(" ")
            letters = letters.rstrip(" ") + " "
            if letters.strip():
                want.update((lang, letters[i : i + 4]) for i in range(len(letters) - 3))
    got = {(r.lang, r.gram): r.n for r in langid.count_ngrams(frame).collect() if r.gram.strip()}
    assert got == {k: n for k, n in want.items() if k[1].strip()}


def test_language_models_hold_every_ngram(spark, docs):
    rng = random.Random(3)
    wide = ["".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(4000)) for _ in range(30)]
    rows = [(i, text, "zh") for i, text in enumerate(wide)] + [(100 + i, "la casa de la rosa " * 3, "es") for i in range(9)]
    counted = langid.count_ngrams(docs(*rows))
    by_lang = {}
    for r in counted.collect():
        by_lang.setdefault(r.lang, {})[r.gram] = r.n
    assert len(by_lang["zh"]) > 110_000
    langs, tables = langid.store(counted)
    assert langs == ["es", "zh"]
    for name, own in zip(langs, tables):
        want = langid.build(list(by_lang[name]), list(by_lang[name].values()))
        assert own.floor == want.floor
        for got, expected in zip((own.seen, own.contexts), (want.seen, want.contexts)):
            assert all(np.array_equal(a, b) for a, b in zip(got, expected, strict=True))
        for got, expected in zip((own.prob, own.backoff), (want.prob, want.backoff)):
            assert all(np.allclose(a, b, rtol=1e-12) for a, b in zip(got, expected, strict=True))


def test_no_language_is_lost(spark, docs):
    greek = [(i, "και το της στην " * 3, "el") for i in range(4000, 6000)]
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(langid.CALIBRATION_PART)) == 0
    rows = docs(*greek).where(apart & ~held_out(F.col("doc_id"))).limit(3)
    assert rows.count() == 3
    model = langid.fit(rows.unionByName(docs(*[(i, "the of and in " * 5, "en") for i in range(60)])))
    assert model.langs == ["el", "en"] and model.predict(["το της και"])[0] == ["el"]
    assert model.accept[0] == np.inf  # no other text of it to calibrate by
    assert langid.fit(rows).langs == ["el"]


def test_calibration_is_the_entropy_of_unseen_texts(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    known = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(langid.CALIBRATION_PART)) == 0
    langs, tables = langid.store(langid.count_ngrams(known.where(~apart)))
    trial = langid.Model(langs, tables, [np.inf] * len(langs))
    entropies = {name: [] for name in langs}
    for row in known.where(apart).collect():
        if any(map(str.isalpha, row.text)):
            bits = trial.bits([row.text])
            if langs[bits.argmin()] == row.lang:
                entropies[row.lang].append(bits.min())
    model = langid.fit(docs)
    for name, most in zip(model.langs, model.accept):
        assert np.isclose(most, np.quantile(entropies[name], langid.ACCEPT_SHARE, method="inverted_cdf"))


def test_counts_of_more_signs_than_fit_64_bits():
    signs = [chr(c) for c in range(0x10000, 0x10000 + 70_000)]
    text = "".join(signs) + "".join(signs[:50])
    grams, counts = langid._count([text])
    padded = "   " + text.lower() + " "
    want = Counter(padded[i : i + 4] for i in range(len(padded) - 3))
    assert dict(zip(grams.tolist(), counts.tolist())) == want


def test_any_number_of_languages(spark, docs):
    model = langid.fit(docs(*[(i, f"word{chr(0x4E00 + i % 120)} " * 3, f"l{i % 120}") for i in range(1200)]))
    assert len(model.langs) == 120 and model.predict([f"word{chr(0x4E00 + 7)}"])[0] == ["l7"]


def test_language_of_unseen_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs)
    rows = langid.identify(docs, model).where(held_out(F.col("doc_id"))).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert np.mean([r.lang_accepted for r in rows]) > 0.9
    assert all(0 <= r.lang_score <= 1 for r in rows)


def test_language_edge_rows(spark, docs):
    train = docs(*[(i, "der die das und " * 5, "de") if i % 2 else (i, "the of and in " * 5, "en") for i in range(400)])
    model = langid.fit(train)
    texts = [None, "", "12 !?", "the and of", "und das die", "一二" * 9, "the of " * 200_000]
    lang, score, accepted = model.predict(texts)
    assert lang[:5] == ["und", "und", "und", "en", "de"] and lang[6] == "en"
    assert score[:3].tolist() == [0, 0, 0] and not accepted[:3].any() and not accepted[5]
    assert np.allclose(score, [model.predict([t])[1][0] for t in texts])
    empty = langid.fit(docs())
    assert empty.predict(["abc", None])[0] == ["und", "und"]
    assert langid.identify(docs(), empty).collect() == []
    clash = docs("the of", "the of").withColumn("lang_score", F.lit("x"))
    assert [r.lang_pred for r in langid.identify(clash, model).collect()] == ["en", "en"]


# nearest neighbours


def brute_nearest(rows, k):
    """Of ``(id, vector)`` rows that take part."""
    out = Counter()
    for at, (q, own) in enumerate(rows):
        if q % 20 == 0:
            ranked = sorted(
                (-float((np.array(v) * np.array(own)).sum()), i)
                for other, (i, v) in enumerate(rows)
                if other != at and len(v) == len(own)
            )[:k]
            out.update((q, rank, i, round(-s, 9)) for rank, (s, i) in enumerate(ranked, 1))
    return out


def vectors_frame(spark, rows):
    rows = [(i, v and [x if x is None else float(x) for x in v]) for i, v in rows]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("row", F.lit("x"))


def nearest(spark, rows, **options):
    got = permutation.search(vectors_frame(spark, rows), F.col("vec_id") % 20 == 0, **options).collect()
    return Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got)


def test_neighbours_ties_bad_vectors_and_repeated_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, np.float32(rng.integers(-3, 4, 6) + 0.5).astype(float).tolist()) for i in range(61)]
    good += [(i, good[0][1]) for i in range(100, 130)] + [(5, good[5][1]), (5, [9.5] * 6), (20, [1.5] * 6), (40, good[40][1])]
    good += [(260, [1.0] * 5), (261, [2.0] * 5), (262, [-1.0] * 5)]  # another length: only these meet
    odd = [(200, None), (220, []), (240, [0.0] * 6), (280, [1.0, None, 1, 1, 1, 1]),
           (300, [float("nan")] * 6), (320, [float("inf")] * 6), (None, [1.0] * 6)]
    assert nearest(spark, good + odd, k=7, share=1.0) == brute_nearest(good, 7)
    few = [(0, [1.0, 2.0]), (1, [2.0, 1.0])]
    assert nearest(spark, few) == brute_nearest(few, 20)
    assert nearest(spark, []) == Counter()


def test_recall_over_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(permutation, "SHARD_ROWS", 700)
    monkeypatch.setattr(permutation, "BLOCK_ROWS", 30)
    rng = np.random.default_rng(3)
    data = rng.normal(size=(2000, 24)) * rng.uniform(0.5, 2, (2000, 1))  # lengths differ: not a distance search
    rows = [(i, np.float32(v).astype(float).tolist()) for i, v in enumerate(data)]
    want, got = brute_nearest(rows, 10), nearest(spark, rows, k=10)
    pairs = lambda found: {(q, i) for q, _, i, _ in found}
    assert len(pairs(want) & pairs(got)) >= 0.9 * len(want)
    assert nearest(spark, rows, k=10, share=1.0) == want


def test_the_index_scores_few_and_finds_nearly_all(spark):
    """The query's own parameters over the largest given table."""
    frame = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = sorted((r.vec_id, [float(x) for x in r.embedding]) for r in frame.collect())
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    is_query = F.col("vec_id") % 20 == 0
    scored = permutation.found(frame, is_query, 20).groupBy("query_id").agg(F.sum("scored").alias("n")).collect()
    assert len(scored) == 100 and max(r.n for r in scored) <= 0.055 * len(rows)  # 5 % and ties
    got = {(r.query_id, r.vec_id): r.score for r in permutation.search(frame, is_query).collect()}
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = (vectors * vectors[q]).sum(axis=1)
        score[q] = -np.inf
        best = {(ids[q], ids[i]) for i in np.lexsort((ids, -score))[:20]}
        hits += len(best & set(got))
        assert all(abs(got[ids[q], i] - score[np.searchsorted(ids, i)]) < 1e-12 for (at, i) in got if at == ids[q])
    assert hits >= 0.9 * 2000 and len(got) == 2000


# licenses


NAMES = "apache mit isc gnu gpl lgpl agpl mozilla mpl creative cc cc0 bsd unlicense".split()
LIMITS = "affero lesser endorse noncommercial nc sharealike sa noderivatives nd".split()


def brute_agrees(template, passage, before=()):
    """What names a license in the template is in the passage, and no other restriction or denial is."""
    telling = [w for w in template if w in NAMES + LIMITS or w.isdigit()]
    denials = [sum(w in ("not", "never", "no", "cannot", "isn") for w in x) for x in (template, [*before, *passage])]
    return set(telling) <= set(passage) and not (set(LIMITS) - set(telling)) & set(passage) and denials[1] <= denials[0]


def brute_cosine(own, other, model):
    weight = lambda bag: {w: (1 + math.log(n)) * model.idf.get(w, model.unknown) for w, n in bag.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    a, b = weight(Counter(own)), weight(Counter(other))
    return (sum(a[w] * b.get(w, 0) for w in a) / norm(a) / norm(b) if a else 0.0), norm(b)


def brute_license(text, model):
    """All passages against all templates: lines, short texts, windows of each template's length."""
    lines = [licenses.split_words(line) for line in text.split("\n")]
    own = [w for line in lines for w in line]
    ends = [sum(map(len, lines[: i + 1])) for i in range(len(lines))]
    first = []
    for sentence in re.split(r"(?<=[.!?;:])\s|\n\s*\n", text):
        first += [len(first)] * len(licenses.split_words(sentence))
    spans = [(end - len(line), end) for line, end in zip(lines, ends)] + [(0, len(own))] * (len(own) <= 60)
    found, nth = [], -1
    for name, texts in licenses.TEMPLATES.items():
        for other in map(licenses.split_words, texts):
            nth, width = nth + 1, min(len(other), len(own))
            for start, end in {*spans, *((at, at + width) for at in range(len(own) - width + 1))}:
                cosine, size = brute_cosine(own[start:end], other, model)
                if cosine < model.threshold:
                    continue
                if brute_agrees(other, own[start:end], own[max(first[start], start - 6) : start]):
                    found.append((-round(cosine * size, 9), nth, start, end, cosine, name))
    kept = []
    for match in sorted(found):
        if all(match[3] <= other[2] or match[2] >= other[3] for other in kept):
            kept.append(match)
    return min(((-round(m[4], 9), m[1], m[2], m[5]) for m in kept), default=(0, 0, 0, None))


def license_model():
    return licenses.build(1000, {w: 900 if len(w) < 4 else 3 for w in licenses.vocabulary()})


def test_cosines_cues_and_windows_are_those_of_the_definition():
    model, rng = license_model(), random.Random(9)
    known = licenses.vocabulary() + ["alpha", "beta", "gamma"]
    notices = [t for texts in licenses.TEMPLATES.values() for t in texts]
    hits = 0
    for _ in range(60):
        words = rng.choice([t for t in notices if len(t) < 400]).split()
        kept = rng.sample(words, max(1, len(words) - rng.randint(0, 3))) if rng.random() < 0.5 else words
        noise = [" ".join(rng.choices(known, k=rng.choice([0, 3, 40]))) for _ in range(2)]
        text = rng.choice([" ", "\n"]).join([noise[0], " ".join(kept), noise[1]])
        cosine, _, _, name = brute_license(text, model)
        got = model.find(text)
        assert got[0] == name and got[1] == pytest.approx(-cosine, abs=1e-8)
        hits += name is not None
    assert hits > 20


def test_every_template_is_its_own_license():
    model, filler = license_model(), " ".join(f"w{i}" for i in range(90))
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            assert model.find(f"{filler} {text} {filler}")[0] == name, text
            assert model.find("\n".join(text.split()))[::2] == (name, True), text


CONFUSABLE = {
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
    "later version.": "GPL-2.0",
    "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version.": "LGPL-3.0",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version.": "AGPL-3.0",
    "SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0",
    "SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause",
    "SPDX-License-Identifier: ISC": "ISC",
    "SPDX-License-Identifier: EPL-2.0": None,
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "This work is not dedicated to the public domain.": None,
    "This work is not licensed under the GNU General Public License, version 3.": None,
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.": "ISC",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "MPL-2.0",
}


def test_a_denial_counts_within_its_sentence():
    model = license_model()
    assert model.find("There is no warranty. Released under the MIT License.")[0] == "MIT"
    assert model.find("This work is not\nreleased under the MIT License.")[0] is None


@pytest.mark.parametrize("notice, name", CONFUSABLE.items())
@pytest.mark.parametrize("around", ["{}", "some words\n{}\nother words", "word " * 40 + "{}" + " text" * 40])
def test_relatives_are_told_apart(notice, name, around):
    assert license_model().find(around.format(notice))[0] == name


def test_license_files_of_the_bsd_family_and_short_files(spark, docs):
    two = f"Copyright (c) 2024\n\n{licenses.TEMPLATES['BSD-2-Clause'][-1]}"
    three = f"Copyright (c) 2024\n\n{licenses.TEMPLATES['BSD-3-Clause'][-1]} and so on " + "more " * 60
    model = license_model()
    assert model.find(two)[0] == "BSD-2-Clause" and model.find(three)[0] == "BSD-3-Clause"
    short = "A program that counts words and lines in many files of all kinds. Released under the MIT License."
    assert model.find(short)[0] == "MIT" and not model.find(short)[2] and model.find(short, "LICENSE.md")[2]
    frame = docs((1, two, "en", "a/LICENSE"), (2, "code " * 70, "en", "a/b/c.c"), (3, "code", "en", "d.c"))
    got = {r.path: r.final for r in licenses.scan(frame, F.col("source")).collect()}
    assert got == {"a/LICENSE": "BSD-2-Clause", "a/b/c.c": "BSD-2-Clause", "d.c": None}


def test_licenses_are_inherited_from_the_nearest_directory(spark, docs):
    apache, mit = licenses.TEMPLATES["Apache-2.0"][0], licenses.TEMPLATES["MIT"][0]
    files = {
        "LICENSE": apache, "a/LICENSE": mit, "a/b/c.py": "code " * 99, "a/d.py": "x " * 80 + "\n" + apache + "\n" + "y " * 80,
        "e.py": None, "f/g/h": "", None: "none " * 70, "a/b/c.py2": "code " * 99,
    }
    frame = docs(*[(i, text, "en", path) for i, (path, text) in enumerate(files.items())])
    frame = frame.union(frame.where("doc_id = 2"))
    got = {r.path: (r.license, r.final, r.inherited_from, r.is_file) for r in licenses.scan(frame, F.col("source")).collect()}
    assert got["LICENSE"] == ("Apache-2.0", "Apache-2.0", None, True)
    assert got["a/LICENSE"] == ("MIT", "MIT", None, True)
    assert got["a/b/c.py"] == got["a/b/c.py2"] == (None, "MIT", "a", False)
    assert got["a/d.py"] == ("Apache-2.0", "Apache-2.0", None, False)
    assert got["e.py"] == got["f/g/h"] == got[None] == (None, "Apache-2.0", "", False)
    assert licenses.scan(frame, F.col("source")).count() == len(files) + 1
    assert licenses.scan(docs(), F.col("source")).collect() == []


def test_notices_in_paragraphs_and_long_license_files(spark, docs):
    mit, apache = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0"]
    filler = " ".join(f"w{i}" for i in range(150))
    wrapped = "\n".join(apache[1].split())
    files = {
        "LICENSE": f"Copyright\n{mit[2]}\n{filler}", "a.py": "code " * 99, "p/q.txt": f"{filler} {mit[0]} {filler}",
        "p/r.txt": f"{filler}\n{wrapped}\n{filler}", "license.py": f"{filler} {mit[0]} {filler}", "q/COPYING.txt": filler,
        "q/b.py": "code " * 99, "z/1": f"{wrapped} " * 3, "z/2": "code " * 99,
    }
    frame = docs(*[(i, text, "en", path) for i, (path, text) in enumerate(files.items())])
    got = {r.path: (r.license, r.final, r.inherited_from, r.is_file) for r in licenses.scan(frame, F.col("source")).collect()}
    assert got["LICENSE"] == ("MIT", "MIT", None, True)
    assert got["a.py"] == (None, "MIT", "", False)
    assert got["p/q.txt"] == got["license.py"] == ("MIT", "MIT", None, False)
    assert got["p/r.txt"] == ("Apache-2.0", "Apache-2.0", None, False)
    assert got["q/COPYING.txt"] == got["q/b.py"] == (None, "MIT", "", False)
    assert got["z/1"] == ("Apache-2.0", "Apache-2.0", None, True) and got["z/2"] == (None, "Apache-2.0", "z", False)
