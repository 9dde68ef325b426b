"""Silver cleaning jobs (PR01-PR10, FI01-FI05, ST01-ST07, JO02 backfill).

Each job is one lazy plan: standardisation, casts and filters fuse into a
single projection/filter stage after the scan; the spatial backfill adds one
broadcast (or salted shuffle) join. Reject and row counts are gathered with
``observe`` during the write, not by extra actions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import backfilled_flag, filled, outside, parse_timestamp, trimmed, try_cast_columns
from ..functions.predicates import city_is, has_position, has_value, needs_backfill
from ..functions.standardize import price_outlier, standardize
from ..operators.spatial import ZoneIndex, spatial_join
from ..params import Bounds

# Source columns cast to DOUBLE, and the let table's columns in order.
STAY_DOUBLES = ["price", "bedrooms", "latitude", "longitude", "review_scores_value"]

LET_COLUMNS = [
    "_id", "pc4", "postalCode", "latitude", "longitude", "rent_amount", "utilities_included",
    "deposit_amount", "propertyType", "area_sqm", "capacity", "furnish", "is_rent_outlier",
    "first_seen_at", "last_seen_at", "_source", "_ingested_at",
]


def clean_stays(bronze: DataFrame, bounds: Bounds = Bounds(),
                observation: Observation | None = None) -> DataFrame:
    """Typed short-stay rows before the backfill (bronze columns kept, new ones appended)."""
    price = F.col("price").try_cast("double")
    df = standardize(bronze, {"pc4": ("postal_pc4", "zipcode")}, observation)
    df = df.withColumns({
        "is_price_outlier": price_outlier(price, bounds.price_lo, bounds.price_hi),
        "room_type": trimmed(F.col("room_type")),
    })
    df = try_cast_columns(try_cast_columns(df, STAY_DOUBLES, "double"), ["accommodates"], "int")
    return df.filter(has_position(F.col("latitude"), F.col("longitude"))).filter(has_value(F.col("price")))


def backfill(stays: DataFrame, zones: DataFrame | ZoneIndex | None, **join_opts) -> DataFrame:
    """JO02 + PR07 + PR08: fill missing codes from the zones; flag recovered rows.

    ``zones=None`` means no zone file: the flag is false everywhere (the column
    is always present). Only rows without a code but with both coordinates meet
    the zone index.
    """
    if zones is None:
        return stays.withColumn("pc4_backfilled", F.lit(False))
    want = needs_backfill(F.col("pc4"), F.col("latitude"), F.col("longitude"))
    df = spatial_join(stays, zones, lon="longitude", lat="latitude", out="_pc4_lookup",
                      where=want, **join_opts)
    lookup = F.col("_pc4_lookup")
    return (df.withColumns({"pc4": filled(F.col("pc4"), lookup),
                            "pc4_backfilled": backfilled_flag(F.col("pc4"), lookup)})
            .drop("_pc4_lookup"))


def silver_stays(bronze: DataFrame, zones: DataFrame | ZoneIndex | None = None, bounds: Bounds = Bounds(),
                 observation: Observation | None = None, **join_opts) -> DataFrame:
    """Short-stay silver: clean, then backfill."""
    return backfill(clean_stays(bronze, bounds, observation), zones, **join_opts)


def silver_lets(bronze: DataFrame, city: str = "amsterdam", bounds: Bounds = Bounds(),
                observation: Observation | None = None) -> DataFrame:
    """Let silver: one city, parsed text fields, rent outlier flag, fixed projection."""
    df = bronze.filter(city_is(F.col("city"), city))
    df = standardize(df, {
        "rent_amount": ("rent_amount", "rent"),
        "utilities_included": ("rent_utilities", "rent"),
        "pc4": ("postal_pc4", "postalCode"),
        "area_sqm": ("area_sqm", "areaSqm"),
        "capacity": ("capacity", "matchCapacity"),
        "deposit_amount": ("deposit_amount", "deposit"),
    }, observation)
    df = df.withColumns({
        "latitude": F.col("latitude").try_cast("double"),
        "longitude": F.col("longitude").try_cast("double"),
    }).filter(has_value(F.col("rent_amount")))
    df = df.withColumns({
        "is_rent_outlier": outside(F.col("rent_amount"), bounds.rent_lo, bounds.rent_hi),
        "first_seen_at": parse_timestamp(F.col("firstSeenAt")),
        "last_seen_at": parse_timestamp(F.col("lastSeenAt")),
    })
    return df.select(*LET_COLUMNS)
