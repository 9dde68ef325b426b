"""AG07 on wide columns: the exact report from candidates and bucket totals."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from rentyield.operators.aggregates import frequency, top_values
from rentyield.sources import demo


def same(df, col, n, **options):
    got = [tuple(r) for r in top_values(df, col, n, **options).collect()]
    assert got == [tuple(r) for r in frequency(df, col, n).collect()]
    return got


@pytest.mark.parametrize("tracked,buckets", [(10_000, 1 << 16), (16, 1 << 16), (16, 8), (16, 1)])
def test_top_values_are_exact(spark, tracked, buckets):
    """Also where the summary tracks far fewer values than there are, so that candidates miss some of the report."""
    skewed = spark.range(40_000).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("v"), F.floor(F.pow(F.col("id") % 9973, 0.8)).cast("string"))).alias("a value"))
    assert len(same(skewed, "a value", 12, tracked=tracked, buckets=buckets)) == 12


@pytest.mark.parametrize("kind", ["string", "long", "double", "date", "decimal(12,2)"])
def test_top_values_of_types_ties_and_nulls(spark, kind):
    flat = spark.range(3_000).select(F.expr(f"CAST(CAST('2000-01-01' AS date) + CAST(id div 3 AS int) AS date)" if kind == "date" else f"CAST(id div 3 AS {kind})").alias("_v"), F.lit(1).alias("count"))
    same(flat, "_v", 5, tracked=16, buckets=64)                                   # every count is 3: ties go to the smaller value
    same(flat.filter("false"), "_v", 5)
    same(flat.select(F.nullif("_v", "_v").alias("_v")), "_v", 5)                  # nothing but NULL


def test_special_doubles(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (1.5,), (None,), (float("inf"),)], "x double")
    got = same(df.select(F.col("x").cast("string").alias("x")), "x", 3)
    assert len(got) == 3 and [r["count"] for r in top_values(df, "x", 2).collect()] == [2, 2]


def test_few_values_are_shuffled(spark):
    """The last count sees hot buckets only, and the plan holds no exchange of all values."""
    wide = demo.stays(spark, SF_ORACLE).select(F.when(F.col("line_no") == 1, F.lit("often")).otherwise(F.concat("listing_id", F.lit("-"), "line_no")).alias("v"))
    assert wide.distinct().count() > 30_000
    assert same(wide, "v", 1)[0][0] == "often"
    rest = top_values(wide, "v", 1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in rest and "LeftSemi" in rest
