"""Command line: run the layers and print the audit and the two result views.

    python -m rentyield --raw /data/raw --tables /data/tables [--start silver]
        [--database db] [--city amsterdam] [--occupancy-rate 0.70] [--service-fee-pct 0.03]
        [--cleaning-cost 30.0] [--avg-stay-nights 3.0] [--months-occupied 11]
        [--maintenance-pct 0.10] [--rentals-per-line] [--zones-per-line] [--master local[*]]

    python -m rentyield --raw /data/raw --profile

The parameters are the ones the reference exposes per run. The result views
(strategy counts, top-10 areas) are read back from the saved gold table.
``--profile`` writes nothing: it reads the raw listing and rental files and
prints the data-quality reports (shape, missing values, postal formats, price
summary, category frequencies, issue table).
"""

from __future__ import annotations

import argparse
import json

from .functions.predicates import city_is
from .operators.compare import strategy_counts, top_areas
from .params import Assumptions, Paths
from .plans import profile as P
from .plans.run import LAYERS, run, target
from .sources.files import read_listings, read_rentals
from .sources.tables import load


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="rentyield", description=__doc__.splitlines()[0])
    p.add_argument("--raw", required=True, help="folder with the raw listing, rental and zone files")
    p.add_argument("--tables", default="", help="folder for the layer tables (parquet)")
    p.add_argument("--database", default=None, help="save layer tables to this catalog database instead")
    p.add_argument("--start", default="bronze", choices=LAYERS, help="first layer to (re)build")
    p.add_argument("--city", default="amsterdam")
    d = Assumptions()
    p.add_argument("--occupancy-rate", default=d.occupancy_rate)
    p.add_argument("--service-fee-pct", default=d.service_fee_pct)
    p.add_argument("--cleaning-cost", default=d.cleaning_cost)
    p.add_argument("--avg-stay-nights", default=d.avg_stay_nights)
    p.add_argument("--months-occupied", default=d.months_occupied, type=int)
    p.add_argument("--maintenance-pct", default=d.maintenance_pct)
    p.add_argument("--master", default=None, help="Spark master when no session is running")
    p.add_argument("--top", default=10, type=int, choices=range(1, 1001), metavar="1..1000")
    p.add_argument("--rentals-per-line", action="store_true", help="rentals are JSON lines; the read splits")
    p.add_argument("--zones-per-line", action="store_true", help="zones are one GeoJSON feature per line; the read splits")
    p.add_argument("--profile", action="store_true", help="only report data quality of the raw files")
    args = p.parse_args(argv)
    if not args.profile and not args.tables and not args.database:
        p.error("one of --tables or --database is required")
    return args


def main(argv: list[str] | None = None) -> dict:
    args = parse_args(argv)
    from pyspark.sql import SparkSession

    from .session import build_session
    spark = SparkSession.getActiveSession() or build_session(args.master or "local[*]")
    if args.profile:
        return profile_raw(spark, args)
    paths = Paths(raw=args.raw, tables=args.tables, database=args.database, city=args.city,
                  rentals_multiline=not args.rentals_per_line, zones_per_line=args.zones_per_line)
    a = Assumptions(args.occupancy_rate, args.service_fee_pct, args.cleaning_cost, args.avg_stay_nights,
                    args.months_occupied, args.maintenance_pct)
    audit = run(spark, paths, args.start, a)
    gold = load(spark, target(paths, "gold"))
    out = {
        "audit": audit.counts,
        "strategy_counts": [r.asDict() for r in strategy_counts(gold).collect()],
        "top_areas": [r.asDict() for r in top_areas(gold, args.top).collect()],
    }
    print(json.dumps(out, indent=2, default=str))
    return out


def profile_raw(spark, args) -> dict:
    """The exploratory reports over the raw files; each report is one aggregate pass."""
    paths = Paths(raw=args.raw, tables="", city=args.city)
    raw = paths.raw.rstrip("/")
    listings = read_listings(spark, f"{raw}/{paths.listings_file}")
    rentals = read_rentals(spark, f"{raw}/{paths.rentals_file}", multiline=not args.rentals_per_line)
    in_city = rentals.filter(city_is(rentals["city"], args.city))
    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  (small report rows only)
    out = {
        "listings_shape": rows(P.profile_shape(listings)),
        "rentals_shape": rows(P.profile_shape(rentals)),
        "missing": rows(P.profile_missing(listings, ["zipcode", "bedrooms", "review_scores_value"])),
        "postal_formats": rows(P.profile_formats(listings, "zipcode")),
        "price": rows(P.profile_numeric(listings, "price", 2000.0)),
        "price_summary": rows(P.summary(listings, "price")),          # with approximate quartiles
        "room_types": rows(P.profile_frequency(listings, "room_type", top=args.top)),
        "cities": rows(P.profile_frequency(rentals, "city", top=args.top)),
        "property_types": rows(P.profile_frequency(in_city, "propertyType", top=args.top)),
        "issues": rows(P.issue_report(listings, rentals, rentals, args.city)),
    }
    print(json.dumps(out, indent=2, default=str))
    return out


if __name__ == "__main__":
    main()
