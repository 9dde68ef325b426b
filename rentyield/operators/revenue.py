"""Revenue model (PR11, PR12), computed in exact decimal arithmetic.

Money enters as DOUBLE (the silver type) and is cast once to DECIMAL(18,2);
constants are exact decimal literals folded by Catalyst. Results stay decimal so
the per-area means are exact; views cast to DOUBLE only after rounding.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import Assumptions

MONEY = "decimal(18,2)"

# The ``annual_*`` column names below are fixed values of the published revenue model.


def money(c: Column) -> Column:
    """DOUBLE → DECIMAL(18,2); values that do not fit become NULL."""
    return c.try_cast(MONEY)


def _dec(v: Decimal | str | int) -> Column:
    return F.lit(Decimal(str(v)))


def stay_revenue(df: DataFrame, a: Assumptions = Assumptions(), price: str = "price") -> DataFrame:
    """PR11: gross = nights x price; fees = gross x fee; cleaning = turnovers x cost."""
    gross = money(F.col(price)) * _dec(a.occupied_nights())
    return df.withColumns({
        "annual_gross_revenue": gross,
        "annual_service_fees": gross * _dec(a.service_fee_pct),
        "annual_cleaning_costs": _dec(a.cleaning_per_year()),
    }).withColumn(
        "annual_net_revenue",
        F.col("annual_gross_revenue") - F.col("annual_service_fees") - F.col("annual_cleaning_costs"),
    )


def let_revenue(df: DataFrame, a: Assumptions = Assumptions(), rent: str = "rent_amount") -> DataFrame:
    """PR12: gross = rent x months; maintenance = gross x rate; net = gross - maintenance."""
    gross = money(F.col(rent)) * F.lit(int(a.months_occupied))
    return df.withColumns({
        "annual_gross_revenue": gross,
        "annual_maintenance_costs": gross * _dec(a.maintenance_pct),
    }).withColumn(
        "annual_net_revenue", F.col("annual_gross_revenue") - F.col("annual_maintenance_costs"),
    )
