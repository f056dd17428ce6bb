"""Every registered query against its SQL in a second engine."""

import pytest

import __spark_entry__
import compare
from tradeloom.verification.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def second_engine():
    return compare.connect(FOLDER)


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, second_engine, name):
    found = compare.differences(spark, second_engine, QUERIES[name], ORACLE[name], FOLDER)
    assert found is None, found


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert len(rows) == 10
    assert rows[0].revenue >= rows[-1].revenue
