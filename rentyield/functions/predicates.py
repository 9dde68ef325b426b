"""Row predicates (FI01-FI11) as Column expressions; filters stay pushable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three postal-code formats the profiling census counts.
POSTAL_FORMATS = {
    "four_digits": r"^[0-9]{4}$",          # '1053'
    "six_chars_no_space": r"^[0-9]{4}[A-Za-z]{2}$",   # '1013HE'
    "with_space": r"^[0-9]{4}\s[A-Za-z]{2}$",         # '1016 AM'
}


def has_position(lat: Column, lon: Column) -> Column:
    """FI01: latitude or longitude present (the backfill itself needs both)."""
    return lat.isNotNull() | lon.isNotNull()


def has_value(c: Column) -> Column:
    """FI02 / FI05: value present."""
    return c.isNotNull()


def needs_backfill(pc4: Column, lat: Column, lon: Column) -> Column:
    """FI03: no code but both coordinates."""
    return pc4.isNull() & lat.isNotNull() & lon.isNotNull()


def city_is(city: Column, name: str = "amsterdam") -> Column:
    """FI04: case-insensitive city match (spaces are not ignored)."""
    return F.lower(city) == F.lit(name.lower())


def not_flagged(flag: Column) -> Column:
    """FI06 / FI07: keep rows whose outlier flag is false (NULL flag drops)."""
    return flag == F.lit(False)


def in_both_sources(advantage: Column) -> Column:
    """FI08: areas present on both sides have an advantage."""
    return advantage.isNotNull()


def null_or_empty(c: Column) -> Column:
    """FI09."""
    return c.isNull() | (c == F.lit(""))


def matches(c: Column, regex: str) -> Column:
    """FI10: Java regex search (use anchors for a full match)."""
    return c.rlike(regex)
