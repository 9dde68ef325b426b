"""Property tests: standardisation never raises and PC4 output is always a valid area code."""

from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st_
from pyspark.sql import functions as F

from rentyield.functions import standardize as st

TEXT = st_.one_of(st_.none(), st_.text(max_size=30),
                  st_.from_regex(r"\s*€?\s*[0-9]{1,5}([.,][0-9]{0,3})?(,-)?\s*[A-Za-z ]{0,12}", fullmatch=True))


@settings(max_examples=10, deadline=None)
@given(st_.lists(TEXT, min_size=1, max_size=60))
def test_rules_never_raise(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    cols = [f(F.col("v")).alias(n) for n, f in st.RULES.items() if n != "price_outlier"]
    rows = df.select(*cols).collect()
    assert len(rows) == len(values)
    for r in rows:
        assert r["postal_pc4"] is None or re.fullmatch(r"[1-9][0-9]{3}", r["postal_pc4"])
        assert r["rent_utilities"] in (True, False)
