"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from cohortloom.plans import catalogue
from tests import compare

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(ORACLES) & set(catalogue.QUERIES)))
def test_matches_sql(spark, con, name):
    assert compare.difference(QUERIES[name](spark, FOLDER), con, ORACLES[name]) is None


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "value", "cnt", "percent"]
    assert df.count() > 0


def test_queries_without_sql_are_few():
    assert sorted(set(catalogue.QUERIES) - set(ORACLES)) == ["random_sample"]
