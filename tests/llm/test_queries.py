"""The registered queries and the pipeline."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline
from check import compare
from tests.conftest import SF
from tests.llm.test_jaccard import grams
from tests.llm.test_native import judged
from wattline.llm.common import table
from wattline.llm.queries import QUERIES
from wattline.llm.sql import SQL


@pytest.mark.parametrize("name", SQL)
def test_query_equals_its_sql(spark, duck, name):
    assert compare(spark, duck, SF, name) is None


def test_every_operator_has_its_query():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(SQL) <= set(QUERIES)


def test_extraction_query(spark, duck):
    import html
    import re

    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op2_extract_html"](spark, SF).collect()}
    for page_id, page in duck.execute("select page_id, html from pages").fetchall():
        inner = re.search("<article>(.*?)</article>", page, re.S)[1]
        text = " ".join(html.unescape(re.sub("<[^>]+>", "", re.sub(r"</?(p|h1|br)>", " ", inner))).split())
        assert got[page_id] == (text, len(text))


def test_search_query_against_brute_force(spark, duck):
    rows = duck.execute("select vec_id, embedding from embeddings order by vec_id").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in QUERIES["op5_permutation_index"](spark, SF).collect()}
    queries = np.flatnonzero(ids % 20 == 0)
    assert len(got) == 20 * len(queries)
    hits = 0
    for q in queries:
        score = (vectors * vectors[q]).sum(axis=1)
        score[q] = -np.inf
        own = [got[ids[q], rank] for rank in range(1, 21)]
        assert own == sorted(own, key=lambda r: (-r[1], r[0]))
        assert all(s == pytest.approx(score[np.searchsorted(ids, i)], abs=1e-12) for i, s in own)
        hits += len({i for i, _ in own} & set(ids[np.lexsort((ids, -score))[:20]].tolist()))
    assert hits >= 0.9 * len(got)


@pytest.mark.parametrize("name", ["op4_quality", "op7_toxicity", "op8_language_id", "op9_license_scan"])
def test_one_row_per_document(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in table(spark, SF, "documents").collect())


def test_pipeline_stages_against_brute_force(spark):
    """Each stage alone on its own input; the trained ones against their operators' decisions."""
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and "Jaccard" in names[2]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], SF).cache())
        if len(kept) < 6:
            assert kept[-1].columns == docs.columns
    rows = [{r.doc_id: r for r in frame.collect()} for frame in kept]
    assert all(set(b) <= set(a) for a, b in zip(rows, rows[1:]))
    clean = {r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()} & set(rows[0])
    assert len(clean & set(rows[1])) > 0.95 * len(clean)
    sets = {i: grams(r.text) for i, r in rows[2].items()}
    left = {}
    for i in sorted(sets):  # no two that stay are alike, and each that went is alike to one of its class that was there
        alike = [j for j in sets if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
        left[i] = alike
    for i in sets:
        if i in rows[3]:
            assert not set(left[i]) & set(rows[3])
        else:
            assert left[i]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert set(rows[4]) == {i for i, r in rows[3].items() if not judged(r.text, items)[3]}
    assert set(rows[5]) == set(rows[4])
    places = [(r.mix_slot, r.mix_pos) for r in rows[5].values()]
    assert len(set(places)) == len(places)


def test_run_is_the_stages_in_turn(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and {"doc_id", "text", "mix_slot", "mix_pos"} <= set(got.columns)


def test_pipeline_of_nothing(spark, scratch):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{scratch}/{name}.parquet")
    assert corpus_pipeline.run(spark, scratch).collect() == []


def test_pipeline_keeps_odd_rows(spark, scratch):
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "xx", "s", 0), (2, "a b", None, None, 3), (2, "a b", None, None, 3)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    odd.write.parquet(f"{scratch}/documents.parquet")
    for name in ("labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{scratch}/{name}.parquet")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.run(spark, scratch).collect()), key=repr)
    assert got == [(1, ""), (2, "a b"), (None, None)]
