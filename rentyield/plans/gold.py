"""Gold comparison: revenue per listing → per-area measures → comparison.

Plan shape: two scans with pushed-down outlier filters and pruned columns, a
price histogram per side ((pc4, price, net), partially aggregated before the
shuffle, so a hot area is merged by many tasks) and its running counts per pc4,
a full outer join that reuses the pc4 hash partitioning, and the derived columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import not_flagged
from ..operators.aggregates import DEFAULT_METHOD, area_lets, area_stays
from ..operators.compare import compare
from ..operators.revenue import let_revenue, stay_revenue
from ..params import Assumptions, Labels


def stays_revenue(silver_stays: DataFrame, a: Assumptions = Assumptions()) -> DataFrame:
    """FI06 + PR11."""
    return stay_revenue(silver_stays.filter(not_flagged(F.col("is_price_outlier"))), a)


def lets_revenue(silver_lets: DataFrame, a: Assumptions = Assumptions()) -> DataFrame:
    """FI07 + PR12."""
    return let_revenue(silver_lets.filter(not_flagged(F.col("is_rent_outlier"))), a)


def gold(silver_stays: DataFrame, silver_lets: DataFrame, a: Assumptions = Assumptions(),
         labels: Labels = Labels(), method: str = DEFAULT_METHOD, drop_null_key: bool = False) -> DataFrame:
    """The per-area comparison table (1 key + 6 + 6 measures + 2 derived)."""
    s = area_stays(stays_revenue(silver_stays, a), method=method)
    k = area_lets(lets_revenue(silver_lets, a), method=method)
    return compare(s, k, labels=labels, drop_null_key=drop_null_key)
