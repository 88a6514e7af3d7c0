"""Every registered query against its DuckDB oracle on the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], ORACLE[name], SF)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "cms_no" and df.count() >= 0


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(E.queries())
