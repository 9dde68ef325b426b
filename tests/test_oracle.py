"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from rentyield.plans.views import QUERIES
from oracle_compare import compare, duck
from conftest import SF_ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_ORACLE, con)
    assert r["status"] == "match", r
