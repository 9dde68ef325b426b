"""Area comparison (JO01, PR13-PR15, SO01, SO04, AG06, FI08).

Both per-area aggregates are hash-partitioned on ``pc4`` by their own final
aggregation, so the full outer join reuses that partitioning (no extra
exchange). NULL areas form a group on each side and never match (two rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import advantage, strategy
from ..functions.predicates import in_both_sources
from ..params import Labels

# The columns of the result view, in order.
RESULT_VIEW = [
    "pc4",
    "airbnb_listing_count",
    "kamernet_listing_count",
    "airbnb_median_annual_net_revenue",
    "kamernet_median_annual_net_revenue",
    "revenue_advantage",
    "recommended_strategy",
]


def compare(stays_agg: DataFrame, lets_agg: DataFrame, key: str = "pc4",
            labels: Labels = Labels(), drop_null_key: bool = False) -> DataFrame:
    """JO01 + PR13 + PR14: full outer join of the two aggregates, advantage, strategy."""
    if drop_null_key:
        stays_agg = stays_agg.filter(F.col(key).isNotNull())
        lets_agg = lets_agg.filter(F.col(key).isNotNull())
    s = F.col("airbnb_median_annual_net_revenue")
    k = F.col("kamernet_median_annual_net_revenue")
    adv = advantage(s, k)
    return (stays_agg.join(lets_agg, on=key, how="full_outer")
            .withColumn("revenue_advantage", adv)
            .withColumn("recommended_strategy", strategy(s, k, F.col("revenue_advantage"), labels)))


def ranked(gold: DataFrame) -> DataFrame:
    """SO01: advantage descending, NULLs last, ties by area."""
    return gold.orderBy(F.col("revenue_advantage").desc_nulls_last(), F.col("pc4").asc_nulls_last())


def top_areas(gold: DataFrame, n: int = 10) -> DataFrame:
    """SO04 + FI08 + PR15: top-n areas present in both sources (a top-k report)."""
    return (ranked(gold.filter(in_both_sources(F.col("revenue_advantage"))))
            .select(*RESULT_VIEW).limit(n))


def strategy_counts(gold: DataFrame) -> DataFrame:
    """AG06: number of areas per recommended strategy."""
    return (gold.groupBy("recommended_strategy").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("recommended_strategy")))
