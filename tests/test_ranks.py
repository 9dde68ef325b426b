"""Exact order statistics over ranges and digits, the type lattice, and summaries of several columns."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from rentyield.operators import ranks
from rentyield.operators.aggregates import area_measures
from rentyield.plans import profile as P
from test_plans import plan_of


def test_quantiles_equal_numpy_and_no_range_holds_all(spark):
    rng = random.Random(4)
    cols = {"a": [rng.gauss(0, 50) for _ in range(3000)], "b": [float(rng.randint(0, 5)) for _ in range(3000)],
            "c": [None if i % 2 else i / 7 for i in range(3000)], "d": [None] * 3000, "e": [4.5] + [None] * 2999}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(6)
    counts = ranks.value_counts(df, {c: F.col(c) for c in cols})
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {(r["column"], r["share"]): r["value"] for r in ranks.quantiles(counts, shares, parts=16).collect()}
    for name, values in cols.items():
        some = [v for v in values if v is not None]
        assert [(name, s) in got for s in shares] == [bool(some)] * len(shares)
        for s in shares if some else []:
            assert abs(got[name, s] - np.quantile(some, s)) < 1e-9
    dealt = counts.repartitionByRange(16, "column", "x").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert dealt < counts.count() / 4


def test_digit_medians_equal_a_sort(spark):
    rng = random.Random(6)
    rows = [("hot", rng.randint(-10 ** 15, 10 ** 15), rng.randint(0, 3)) for _ in range(4000)]             # distinct values
    rows += [(rng.choice(["a", "b", None]), rng.choice([None, 7, -7, 10 ** 17]), None) for _ in range(500)]
    rows += [("one", 5, None), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, v long, w long").repartition(5)
    for bits in (3, 10):
        got = {r["g"]: (r["v"], r["w"]) for r in ranks.digit_medians(df, "g", ["v", "w"], bits).collect()}
        want = {}
        for g in {r[0] for r in rows}:
            both = [sorted(r[i] for r in rows if r[0] == g and r[i] is not None) for i in (1, 2)]
            if any(both):
                want[g] = tuple(x[(len(x) - 1) // 2] if x else None for x in both)
        assert got == want
    assert ranks.digit_medians(df.filter("false"), "g", ["v", "w"]).collect() == []


def test_measures_by_digits_equal_the_histogram(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["1011", "1012", None]), rng.choice([None, rng.randint(100, 9_000_000) / 100]), rng.random()) for _ in range(2000)]
    df = spark.createDataFrame(rows, "pc4 string, price double, score double").repartition(4)
    price = F.col("price").cast("decimal(18,2)")
    args = (df, "pc4", price, (price * F.lit(9)).cast("decimal(24,6)"), F.col("score"))
    by_digits, by_histogram = (sorted(map(str, area_measures(*args, method=m).collect())) for m in ("digits", "histogram"))
    assert by_digits == by_histogram


def test_types_from_the_rows(spark):
    rows = [("1", "1", "2024-01-02", "x", None, "1", "2024-01-02", "12345678901234567890"), ("-2", "2.5", "2024-01-02 10:11:12", "1", "", "2024-01-01", "2024-02-30", "1"),
            (None, "1e3", None, None, None, None, None, None), ("", "", "", "", "", "", "", "")]
    df = spark.createDataFrame(rows, "i string, d string, t string, s string, v string, mixed string, baddate string, `big.one` string").repartition(3)
    got = {r["column"]: (r["type"], r["non_null"], r["nulls"]) for r in P.profile_schema(df).collect()}
    assert got == {"i": ("bigint", 2, 2), "d": ("double", 3, 1), "t": ("timestamp", 2, 2), "s": ("string", 2, 2), "v": ("void", 0, 4),
                   "mixed": ("string", 2, 2), "baddate": ("string", 2, 2), "big.one": ("double", 2, 2)}
    assert dict(P.typed(df).dtypes) == {"i": "bigint", "d": "double", "t": "timestamp", "s": "string", "v": "string", "mixed": "string", "baddate": "string", "big.one": "double"}
    assert [r["i"] for r in P.typed(df).filter("i IS NOT NULL").orderBy("i").collect()] == [-2, 1]
    assert {r["type"] for r in P.profile_schema(df.filter("false")).collect()} == {"void"}
    plan = plan_of(P.profile_schema(spark.createDataFrame(rows, df.schema)))
    assert plan.count(") Exchange") == 1                    # one row per task, one pass


def test_summaries_of_empty_and_missing_columns(spark):
    df = spark.createDataFrame([("1.5", "x"), ("2.5", None)], "a string, b string")
    got = {r["column"]: r for r in P.column_summaries(df, ["a", "b"], 2.0).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"]["q50"], got["a"]["above_bound"]) == (2, 2.0, 2.0, 1)
    assert (got["b"]["count"], got["b"]["mean"], got["b"]["q50"], got["b"]["above_bound"]) == (0, None, None, 0)


def test_later_digits_read_only_the_rows_that_agree(spark, monkeypatch):
    """Groups of very unlike spans: each one's first digit already parts its rows, and the passes after it read what is left."""
    rng = random.Random(5)
    rows = [("wide", rng.randint(-10**17, 10**17)) for _ in range(3000)] + [("narrow", 7 + rng.randint(0, 5000)) for _ in range(3000)] + [(None, 4)] * 7
    sizes, plain = [], ranks.written

    def kept(df):
        out = plain(df)
        if out[0].columns == ["g", "which", "v"]:
            sizes.append(out[0].count())
        return out

    monkeypatch.setattr(ranks, "written", kept)
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(3)
    got = {r["g"]: r["v"] for r in ranks.digit_medians(df, "g", ["v"]).collect()}
    for g in ("wide", "narrow", None):
        values = sorted(v for k, v in rows if k == g)
        assert got[g] == values[(len(values) - 1) // 2]
    assert sizes[0] == 6007 and len(sizes) > 1 and max(sizes[1:]) < 300, sizes


def test_measures_by_digits_make_their_rows_once(spark, tmp_path):
    """The sums do not read the source again: its plan (a spatial join, say) would run twice."""
    spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0)], "k string, p double").write.parquet(str(tmp_path / "source"))
    df = spark.read.parquet(str(tmp_path / "source"))
    price = F.col("p").try_cast("decimal(18,2)")
    out = area_measures(df, "k", price, price.try_cast("decimal(24,6)"), F.col("p"), "digits")
    assert not [f for f in out.inputFiles() if "/source/" in f]
    assert sorted((r["k"] or "", r["count"], r["median_price"], r["avg_other"]) for r in out.collect()) == [("", 1, 3.0, 3.0), ("a", 2, 1.0, 1.5)]
