"""ST01-ST07 on the parser cases of FIXTURES.md (reference cases and register cases)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from rentyield.functions import standardize as st

NBSP = " "

CASES = {
    "rent_amount": [
        ("€ 500,-", 500.0), ("€ 950,-  Utilities incl.", 950.0), ("€ 1.250,-", 1250.0), ("", None), (None, None),
        ("€ 1.250,50", None), ("€ 500", 500.0), ("Prijs op aanvraag", None), ("€ 950 Utilities incl.", None),
        (f"€{NBSP}700,-", 700.0), ("€ 1250.50,-", 125050.0), ("€ 500,-\nfoo", None), ("   ", None),
        ("€ 1_000,-", 1000.0), ("€ 1e3,-", 1000.0), ("€ 1__0,-", None), ("€ 500 .", 500.0),
        ("€ 500,- x\n", 500.0), ("€ -5,-", -5.0),
    ],
    "rent_utilities": [
        ("€ 500,-", False), ("€ 950,-  Utilities incl.", True), (None, False), ("UTILITIES INCLUDED", True), ("", False),
    ],
    "postal_pc4": [
        ("1053", "1053"), ("1016 AM", "1016"), ("1013HE", "1013"), ("1018AS", "1018"), ("0999", None), ("", None),
        (None, None), ("  1053", "1053"), ("\t1053", "1053"), ("10531", "1053"), ("AB1053", None), ("105", None),
        (f"{NBSP}1053", "1053"),
    ],
    "area_sqm": [
        ("14 m2", 14.0), (None, None), ("14,5 m2", 14.0), ("m2 14", 2.0), ("1.250 m2", 1.25), ("n/a", None), ("", None),
    ],
    "capacity": [
        ("1 person", 1), ("2 persons", 2), (None, None), ("> 5 persons", 5), ("", None), ("none", None),
        ("3000000000", None),
    ],
    "deposit_amount": [
        ("\n  € 500\n", 500.0), (None, None), ("€ 500,-", None), ("€ 1.250,50", 1250.5), ("€ 500,", 500.0),
        ("-", None), ("", None), ("€ ,5", 0.5),
    ],
}

PRICE_CASES = [(125.0, False), (5.0, True), (9000.0, True), (None, True), (10.0, False), (2000.0, False),
               (float("nan"), True)]


def _run(spark, rule, values, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    out = df.select("i", st.RULES[rule](F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in out]


@pytest.mark.parametrize("rule", list(CASES))
def test_parser_table(spark, rule):
    inputs = [c[0] for c in CASES[rule]]
    expected = [c[1] for c in CASES[rule]]
    assert _run(spark, rule, inputs, "string") == expected


def test_price_outlier(spark):
    got = _run(spark, "price_outlier", [c[0] for c in PRICE_CASES], "double")
    assert got == [c[1] for c in PRICE_CASES]


def test_float_specials(spark):
    got = _run(spark, "rent_amount", ["€ inf,-", "€ -Infinity,-", "€ nan,-", "€ 1e400,-"], "string")
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3] == math.inf


def test_standardize_observes_rejects(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([("€ 500,-",), ("garbage",), (None,), ("",)], "rent string")
    obs = Observation("rejects")
    out = st.standardize(df, {"amount": ("rent_amount", "rent"), "incl": ("rent_utilities", "rent")}, obs)
    assert [r["amount"] for r in out.collect()] == [500.0, None, None, None]
    assert obs.get == {"rejects_amount": 1, "rows": 4}
