"""Registered queries over the driver tables (one per operator group of the survey).

Each takes (spark, sf_dir) and returns a DataFrame that reads the whole tables.
Output columns are aliased to match the oracle SQL; money and means are exact
decimals cast to DOUBLE after rounding; timestamps are rendered as text so both
engines compare the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import standardize as st
from ..functions.predicates import city_is, needs_backfill
from ..operators.aggregates import area_lets as _area_lets
from ..operators.aggregates import area_stays as _area_stays
from ..operators import quadtree
from ..operators.compare import strategy_counts as _strategy_counts
from ..operators.compare import top_areas
from ..operators.spatial import ZoneIndex, prepare, spatial_join
from ..params import Assumptions, Bounds
from ..sources import demo
from ..sources.files import unwrap_singletons
from ..sources.geojson import zones_from_features
from . import gold as G
from . import profile as P
from . import silver as S
from .file_views import FILE_QUERIES

A = Assumptions()


def _zones(spark: SparkSession, d: str) -> DataFrame:
    return zones_from_features(demo.zone_features(spark, d))


_PREPARED: dict[tuple[str, str], ZoneIndex] = {}


def _index(spark: SparkSession, d: str) -> ZoneIndex:
    """The zones of a data folder, prepared once per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _PREPARED:
        _PREPARED[key] = prepare(_zones(spark, d))
    return _PREPARED[key]


def _silver_stays(spark: SparkSession, d: str, bounds: Bounds = Bounds()) -> DataFrame:
    return S.silver_stays(demo.stays(spark, d), _index(spark, d), bounds)


def _silver_lets(spark: SparkSession, d: str, bounds: Bounds = Bounds()) -> DataFrame:
    """Lets with the lineage columns of the bronze layer, at a fixed time."""
    rows = demo.lets(spark, d).withColumns({"_source": F.lit("orders"), "_ingested_at": F.lit("2024-05-01 00:00:00").cast("timestamp")})
    return S.silver_lets(rows, bounds=bounds)


def _gold(spark: SparkSession, d: str) -> DataFrame:
    return G.gold(_silver_stays(spark, d), _silver_lets(spark, d), A)


# ---- ST01-ST07 -----------------------------------------------------------------

def rent_amount(spark, d):
    return demo.lets(spark, d).select("_id", "rent", st.rent_amount(F.col("rent")).alias("rent_amount"))


def rent_utilities(spark, d):
    return demo.lets(spark, d).select("_id", "rent", st.rent_utilities(F.col("rent")).alias("utilities_included"))


def postal_pc4(spark, d):
    return demo.stays(spark, d).select("listing_id", "line_no", "zipcode",
                                       st.postal_pc4(F.col("zipcode")).alias("pc4"))


def area_sqm(spark, d):
    return demo.lets(spark, d).select("_id", "areaSqm", st.area_sqm(F.col("areaSqm")).alias("area_sqm"))


def capacity(spark, d):
    return demo.lets(spark, d).select("_id", "matchCapacity",
                                      st.capacity(F.col("matchCapacity")).alias("capacity"))


def deposit_amount(spark, d):
    return demo.lets(spark, d).select("_id", "deposit",
                                      st.deposit_amount(F.col("deposit")).alias("deposit_amount"))


def price_outlier(spark, d):
    price = F.col("price").try_cast("double")
    return demo.stays(spark, d).select("listing_id", "line_no", price.alias("price"),
                                       st.price_outlier(price).alias("is_price_outlier"))


# ---- silver, spatial -----------------------------------------------------------

def silver_stays(spark, d):
    return _silver_stays(spark, d)


def silver_lets(spark, d):
    fmt = "yyyy-MM-dd HH:mm:ss"
    return _silver_lets(spark, d).withColumns({
        "first_seen_at": F.date_format("first_seen_at", fmt),
        "last_seen_at": F.date_format("last_seen_at", fmt),
        "_ingested_at": F.date_format("_ingested_at", fmt),
    })


def spatial_backfill(spark, d):
    """JO02 alone: the rows that need a code, with the zone found for each."""
    rows = S.clean_stays(demo.stays(spark, d))
    want = needs_backfill(F.col("pc4"), F.col("latitude"), F.col("longitude"))
    joined = spatial_join(rows.filter(want), _index(spark, d), "longitude", "latitude", "zone_code")
    return joined.select("listing_id", "line_no", "longitude", "latitude", "zone_code")


def spatial_backfill_salted(spark, d):
    """JO02 through its shuffle path: a quadtree of edges instead of a broadcast index, cells over 200 positions salted."""
    rows = S.clean_stays(demo.stays(spark, d))
    want = needs_backfill(F.col("pc4"), F.col("latitude"), F.col("longitude"))
    joined = spatial_join(rows.filter(want), _index(spark, d), "longitude", "latitude", "zone_code",
                          broadcast_limit=0, rows_per_task=200)
    return joined.select("listing_id", "line_no", "longitude", "latitude", "zone_code")


def zone_positions(spark: SparkSession, d: str) -> DataFrame:
    """The zones as a row per position, as a source of zones of any size would give them."""
    rings = _zones(spark, d).select("fid", "code", F.posexplode("rings").alias("ring", "r"))
    return rings.select("fid", "code", "ring", F.posexplode("r").alias("pos", "p")).select("fid", "code", "ring", "pos", F.get("p", 0).alias("x"), F.get("p", 1).alias("y"))


def spatial_backfill_edges(spark, d):
    """JO02 on zones given by positions, in cells of three edges at most: most zones are split over several levels."""
    rows = S.clean_stays(demo.stays(spark, d))
    want = needs_backfill(F.col("pc4"), F.col("latitude"), F.col("longitude"))
    index = quadtree.build(quadtree.edges_of_positions(zone_positions(spark, d)), max_edges=3)
    joined = quadtree.lookup(rows.filter(want), index, "longitude", "latitude", "zone_code", rows_per_task=200)
    return joined.select("listing_id", "line_no", "longitude", "latitude", "zone_code")


def gold_compare_approx(spark, d):
    """The comparison with one-level percentile_approx medians, as the reference computes them."""
    return G.gold(_silver_stays(spark, d), _silver_lets(spark, d), A, method="approx")


def backfill_flag_counts(spark, d):
    return (_silver_stays(spark, d).groupBy("pc4", "pc4_backfilled")
            .agg(F.count(F.lit(1)).alias("listings")))


def zones_parsed(spark, d):
    """IO04-IO06 on GeoJSON-shaped features: code property, rings per zone."""
    z = _zones(spark, d)
    return z.select("fid", "code", F.size("rings").alias("rings"),
                    F.expr("aggregate(rings, 0, (acc, r) -> acc + size(r))").alias("positions"))


# ---- revenue, aggregates, comparison --------------------------------------------

def stay_revenue(spark, d):
    r = G.stays_revenue(_silver_stays(spark, d), A)
    return r.select("listing_id", "line_no", "pc4", "price",
                    *[F.col(c).cast("double").alias(c) for c in
                      ("annual_gross_revenue", "annual_service_fees", "annual_cleaning_costs",
                       "annual_net_revenue")])


def let_revenue(spark, d):
    r = G.lets_revenue(_silver_lets(spark, d), A)
    return r.select("_id", "pc4", "rent_amount",
                    *[F.col(c).cast("double").alias(c) for c in
                      ("annual_gross_revenue", "annual_maintenance_costs", "annual_net_revenue")])


def area_stays(spark, d):
    return _area_stays(G.stays_revenue(_silver_stays(spark, d), A))


def area_lets(spark, d):
    return _area_lets(G.lets_revenue(_silver_lets(spark, d), A))


def area_stays_unbounded(spark, d):
    """AG01 with the outlier bounds wide open, so prices may be of any number: medians digit by digit."""
    return _area_stays(G.stays_revenue(_silver_stays(spark, d, Bounds(price_lo=-1e300, price_hi=1e300)), A), method="digits")


def gold_compare(spark, d):
    return _gold(spark, d)


def gold_other_parameters(spark, d):
    """The comparison under other assumptions and outlier bounds than the defaults."""
    a = Assumptions(occupancy_rate="0.55", service_fee_pct="0.08", cleaning_cost="21.5", avg_stay_nights="2.5",
                    months_occupied=9, maintenance_pct="0.125")
    bounds = Bounds(price_lo=20.0, price_hi=900.0, rent_lo=300.0, rent_hi=2500.0)
    return G.gold(_silver_stays(spark, d, bounds), _silver_lets(spark, d, bounds), a)


def gold_top10(spark, d):
    return top_areas(_gold(spark, d), 10)


def strategy_counts(spark, d):
    return _strategy_counts(_gold(spark, d))


# ---- profiling --------------------------------------------------------------------

def profile_shape(spark, d):
    return P.profile_shape(demo.stays(spark, d))


def profile_schema(spark, d):
    return P.profile_schema(demo.stays(spark, d))


def profile_schema_lets(spark, d):
    return P.profile_schema(demo.lets(spark, d))


def profile_columns(spark, d):
    """QA03 for several columns in one pass."""
    return P.column_summaries(demo.stays(spark, d), ["price", "bedrooms", "review_scores_value", "latitude"]).drop("above_bound")


def profile_missing(spark, d):
    return P.profile_missing(demo.stays(spark, d), ["zipcode", "bedrooms", "review_scores_value"])


def profile_formats(spark, d):
    return P.profile_formats(demo.stays(spark, d), "zipcode")


def profile_frequency(spark, d):
    return P.profile_frequency(demo.stays(spark, d), "room_type")


def city_frequency(spark, d):
    return P.profile_frequency(demo.lets(spark, d), "city", top=10)


def zipcode_top(spark, d):
    """QA05 / AG07 on a wide column: the most frequent raw postal texts."""
    return P.profile_top(demo.stays(spark, d), "zipcode", 20)


def price_top(spark, d):
    """QA05 / AG07 on a wide column in which hardly any value stands out."""
    return P.profile_top(demo.stays(spark, d), "price", 15)


def property_frequency(spark, d):
    return P.profile_frequency(demo.lets(spark, d).filter(city_is(F.col("city"))), "propertyType")


def profile_summary(spark, d):
    return P.profile_numeric(demo.stays(spark, d), "price", 2000.0)


def issue_report(spark, d):
    return P.issue_report(demo.stays(spark, d), demo.lets(spark, d), demo.singletons(spark, d))


def unwrap(spark, d):
    return unwrap_singletons(demo.singletons(spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rent_amount": rent_amount,
    "rent_utilities": rent_utilities,
    "postal_pc4": postal_pc4,
    "area_sqm": area_sqm,
    "capacity": capacity,
    "deposit_amount": deposit_amount,
    "price_outlier": price_outlier,
    "silver_stays": silver_stays,
    "silver_lets": silver_lets,
    "spatial_backfill": spatial_backfill,
    "spatial_backfill_salted": spatial_backfill_salted,
    "spatial_backfill_edges": spatial_backfill_edges,
    "backfill_flag_counts": backfill_flag_counts,
    "zones_parsed": zones_parsed,
    "stay_revenue": stay_revenue,
    "let_revenue": let_revenue,
    "area_stays": area_stays,
    "area_lets": area_lets,
    "area_stays_unbounded": area_stays_unbounded,
    "gold_compare": gold_compare,
    "gold_compare_approx": gold_compare_approx,
    "gold_other_parameters": gold_other_parameters,
    "gold_top10": gold_top10,
    "strategy_counts": strategy_counts,
    "profile_shape": profile_shape,
    "profile_schema": profile_schema,
    "profile_schema_lets": profile_schema_lets,
    "profile_columns": profile_columns,
    "profile_missing": profile_missing,
    "profile_formats": profile_formats,
    "profile_frequency": profile_frequency,
    "city_frequency": city_frequency,
    "zipcode_top": zipcode_top,
    "price_top": price_top,
    "property_frequency": property_frequency,
    "profile_summary": profile_summary,
    "issue_report": issue_report,
    "unwrap_singletons": unwrap,
} | FILE_QUERIES
