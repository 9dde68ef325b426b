"""Casts and derived columns (PR01-PR08, PR13, PR14, PR16).

Every text conversion is a ``try_*`` form: under ANSI mode (Spark 4 default) a
plain cast of one malformed cell would fail the whole job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import Labels


def try_cast_columns(df: DataFrame, cols: Iterable[str], to: str) -> DataFrame:
    """PR01-PR03: cast text columns in place; malformed → NULL."""
    return df.withColumns({c: F.col(c).try_cast(to) for c in cols})


def trimmed(c: Column) -> Column:
    """PR04: Spark ``trim`` (space only), as the reference does for room type."""
    return F.trim(c)


def parse_timestamp(c: Column) -> Column:
    """PR05: text → timestamp; malformed → NULL."""
    return F.try_to_timestamp(c)


def outside(c: Column, lo: float, hi: float) -> Column:
    """PR06: strictly outside (lo, hi) → True; NULL stays NULL."""
    return (c < F.lit(lo)) | (c > F.lit(hi))


def filled(code: Column, lookup: Column) -> Column:
    """PR07: keep the parsed code, else the spatial lookup."""
    return F.coalesce(code, lookup)


def backfilled_flag(code: Column, lookup: Column) -> Column:
    """PR08: True exactly for rows whose code came from the lookup.

    Derived from the code *before* it is overwritten (the reference evaluated
    it after, so its flag was always false).
    """
    return code.isNull() & lookup.isNotNull()


def advantage(stay_median: Column, let_median: Column, digits: int = 2) -> Column:
    """PR13: rounded difference of the two medians; NULL when a side is absent."""
    return F.round(stay_median - let_median, digits)


def strategy(stay_median: Column, let_median: Column, adv: Column,
             labels: Labels = Labels()) -> Column:
    """PR14: four-way recommendation; a tie recommends the let."""
    return (F.when(stay_median.isNull(), F.lit(labels.no_stay))
            .when(let_median.isNull(), F.lit(labels.no_let))
            .when(adv > 0, F.lit(labels.stay))
            .otherwise(F.lit(labels.let)))
