"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__
from tests.compare import differences, duckdb_over

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_over(FOLDER)


def test_every_query_has_its_sql():
    of_llm = set(__spark_entry__.llm.queries()) if __spark_entry__.llm else set()
    assert set(__spark_entry__.queries()) - of_llm == set(__spark_entry__.oracle_sql()) - of_llm


@pytest.mark.parametrize("name", __spark_entry__.oracle_sql())
def test_query(spark, con, name):
    assert differences(spark, con, name, FOLDER) == []


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
