"""Every operator and stage on a table that has columns of all the names the operators use themselves."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF
from wattline import llm
from wattline.llm import chat, collocations, decontaminate, extract, jaccard, langid, licenses, mixing, quality, repair, toxicity
from wattline.llm.common import table

#: What operators return under a name of their own replaces a column of that name.
OWN = set(mixing.OUT) | {"quality_evidence", "quality_site", "quality", "rejected", "toxicity", "toxic", "main_text"}
OWN |= {"lang_pred", "lang_score", "lang_accepted"}


@pytest.fixture(scope="module")
def names():
    """All words in quotes in the operators' modules that could be names of columns."""
    found = set()
    for path in Path(llm.__file__).parent.glob("*.py"):
        found |= set(re.findall(r"[\"'`]([a-z_][a-z0-9_]{0,20})[\"'`]", path.read_text()))
    return sorted(found - OWN - {"doc_id", "text", "lang", "source", "n_chars", "page_id", "url", "html"})


@pytest.fixture(scope="module")
def docs(spark, names):
    base = table(spark, SF, "documents")
    return base.select("*", *[F.lit(f"own {name}").alias(name) for name in names])


def kept_as_they_were(names, rows):
    assert rows
    for row in rows:
        assert all(row[name] == f"own {name}" for name in names if name in row)


@pytest.mark.parametrize("stage", range(5))
def test_stages(spark, docs, names, stage):
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SF)
    assert set(docs.columns) <= set(out.columns)
    kept_as_they_were(names, out.select(*names).limit(50).collect())


def test_operators_that_keep_rows(spark, docs, names):
    bench, labels = table(spark, SF, "benchmark"), table(spark, SF, "labels")
    outs = [
        decontaminate.remove_spans(docs, bench),
        langid.identify(docs, langid.fit(docs)),
        toxicity.judge(docs, toxicity.fit(docs, labels)),
        quality.posteriors(docs, quality.fit(docs, labels), *quality.document_site()),
        extract.extract(table(spark, SF, "pages").select("*", *[F.lit(f"own {name}").alias(name) for name in names])),
        mixing.mix(docs),
    ]
    for out in outs:
        kept_as_they_were(names, out.select(*names).limit(20).collect())


def test_operators_that_return_their_own_columns(spark, docs, names):
    turns = table(spark, SF, "conversations").select("*", *[F.lit("x").alias(name) for name in names if name not in ("conv_id", "turn", "role", "text")])
    for out in (
        decontaminate.contamination(docs, table(spark, SF, "benchmark")),
        jaccard.near_duplicates(docs),
        licenses.scan(docs, F.col("doc_id").cast("string")),
        chat.examples(turns),
        repair.audits(turns),
        collocations.collocations(docs),
    ):
        assert out.limit(5).count() > 0
