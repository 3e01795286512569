"""Plans and bounds that must hold at any size."""

from __future__ import annotations

import ast
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF, executed
from wattline.llm import decontaminate, mixing, quality
from wattline.llm.common import bind, cut, table

LLM = Path(__file__).resolve().parents[2] / "wattline" / "llm"


@pytest.mark.parametrize("path", [*LLM.glob("*.py"), LLM.parents[1] / "corpus_pipeline.py"], ids=lambda path: path.name)
def test_sources_avoid_what_does_not_scale(path):
    source = path.read_text()
    for word in ("localCheckpoint", "crossJoin", "toPandas(", ".rdd", ".sample(", "tempfile"):
        assert word not in source, word


def test_nothing_else_imports_the_subpackage():
    root = LLM.parents[1]
    for path in [*root.glob("wattline/**/*.py"), *root.glob("tests/*.py"), root / "bench.py", root / "check.py"]:
        if LLM in path.parents:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else []
            names += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(name.startswith(("wattline.llm", "corpus_pipeline")) for name in names), path


def test_native_operators_run_no_python(spark, docs):
    texts = docs("a b c", None)
    bench = spark.createDataFrame([(1, "b c")], "item_id bigint, text string")
    for frame in (
        decontaminate.contamination(texts, bench),
        decontaminate.drop_contaminated(texts, bench),
        decontaminate.remove_spans(texts, bench),
        mixing.mix(texts),
    ):
        assert not re.search("Python|Pandas|Arrow", executed(frame))


def test_windows_are_tested_where_the_text_is_read(spark):
    found = decontaminate.contamination(table(spark, SF, "documents"), table(spark, SF, "benchmark"))
    scan = executed(found).split("FileScan")[-2:]
    assert any("ReadSchema: struct<doc_id:bigint,text:string>" in part for part in scan)
    assert "CartesianProduct" not in executed(found) and "NestedLoop" not in executed(found)


def test_a_bound_value_is_computed_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("array<int>")
    def counted(n):
        calls.add(1)
        return list(range(n))

    value = bind(counted(F.lit(50)), lambda v: F.transform(v, lambda x: x + F.size(v)))
    cut(spark.range(1).select(F.size(value).alias("n"))).collect()
    assert calls.value <= 2


def test_evidence_is_computed_once_per_pass(spark, docs):
    frame = docs("a b", "c d")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    judged = quality.posteriors(frame, quality.fit(frame, none), *quality.document_site())
    assert executed(judged.where(~judged.rejected)).count("ArrowEvalPython") == 1
