"""Plan shape: no Python evaluation, no cartesian product, pruned scans, broadcast index."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as E
from rentyield.plans.views import QUERIES
from conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "Python UDF"]


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_cartesian(spark, name):
    p = plan_of(E.queries()[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in p, f"{name}: {bad}"


def test_gold_plan(spark):
    p = plan_of(E.queries()["gold_compare"](spark, SF_SMALL))
    assert "BroadcastHashJoin LeftOuter" in p          # zone index, size-checked broadcast
    assert "SortMergeJoin FullOuter" in p or "ShuffledHashJoin FullOuter" in p
    assert "l_shipdate" not in p and "l_returnflag" not in p and "o_orderdate" not in p   # column pruning
    assert "part.parquet" not in p                    # zones come from their checkpoint, parsed once
    assert "kll_" not in p and "rand(" not in p
    # partial + final aggregation on both sides
    assert p.count("ObjectHashAggregate") + p.count("HashAggregate") >= 4


def test_zone_scans_are_pruned(spark):
    from rentyield.sources import demo
    p = plan_of(demo.zone_features(spark, SF_SMALL))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in p
    assert "ReadSchema: struct<s_suppkey:bigint,s_name:string>" in p


def test_top10_is_take_ordered(spark):
    p = plan_of(E.queries()["gold_top10"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and len(df.columns) == 15
