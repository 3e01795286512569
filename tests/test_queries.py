"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, oracle
from tests.conftest import SF
from wattline.plans import QUERIES


@pytest.fixture(scope="module")
def db():
    return oracle(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, db, name):
    assert name in queries() and name in oracle_sql()
    assert compare(spark, db, SF, name) is None


def test_entry(spark):
    rows = entry(spark)
    assert rows.count() == 24000
    assert rows.columns[:3] == ["receive_date", "receivetime", "device"]
