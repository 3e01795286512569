from __future__ import annotations

import os
import tempfile

import duckdb
import pytest

from tests.conftest import SF  # noqa: F401


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


@pytest.fixture(scope="session")
def duck():
    db = duckdb.connect()
    for name in os.listdir(SF):
        db.execute(f"create view {name.removesuffix('.parquet')} as select * from '{SF}/{name}'")
    return db


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (id, text) or (id, text, lang, source) tuples."""

    def make(*rows):
        full = []
        for i, row in enumerate(rows):
            row = (i, row) if row is None or isinstance(row, str) else row
            full.append((*row, *("en", "s")[len(row) - 2 :], len(row[1] or "")))
        return spark.createDataFrame(full, DOCS)

    return make
