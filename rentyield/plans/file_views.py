"""Registered queries over raw files (IO01-IO03, IO07, IO08, IO10, IO13-IO15).

The driver tables, shaped into the three sources, are written once per application as the raw files a drop would
hold (CSV listings, JSON-lines rentals with singleton arrays, GeoJSON zones) into the session's checkpoint folder; the
queries read them through the readers, the bronze jobs and the ordered run, like a user's files.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import Paths
from ..session import ensure_checkpoint_dir
from ..sources import demo
from ..sources.geojson import split_features, zones_from_features
from ..sources.files import read_listings, read_rentals, unwrap_singletons
from ..sources.tables import load, preview, release
from .refresh import refresh
from .run import audit_rows, reconcile, run, target, verify

# raw files are packed, and not too large for one task each, as a packed file cannot be split
PACKED = {"compression": "gzip", "maxRecordsPerFile": 500_000}

_WRITTEN: dict[tuple[str, str], Paths] = {}
_RUN: dict[tuple[str, str], Paths] = {}
_DOCUMENT: dict[tuple[str, str], str] = {}


def raw_files(spark: SparkSession, d: str) -> Paths:
    """The three raw files of a data folder, written once per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _WRITTEN:
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/drop-{uuid.uuid4().hex}"
        paths = Paths(raw=f"{folder}/raw", tables=f"{folder}/tables", rentals_multiline=False, zones_per_line=True)
        keep_blanks = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        demo.stays(spark, d).write.options(**keep_blanks, **PACKED).csv(f"{paths.raw}/{paths.listings_file}")
        lets = demo.lets(spark, d).withColumns({c: F.array(c) for c in ("_id", "firstSeenAt", "lastSeenAt")})
        lets.write.options(**PACKED).json(f"{paths.raw}/{paths.rentals_file}")
        # one file in feature order, as a zone file is: the order decides where zones overlap; only sorting and writing are one task's
        _feature_lines(spark, d).repartition(1).sortWithinPartitions("fid").select("value") \
            .write.text(f"{paths.raw}/{paths.zones_file}")
        release(spark)
        _WRITTEN[key] = paths
    return _WRITTEN[key]


def changed_drop(spark: SparkSession, paths: Paths, which: Column, drop: bool = False) -> Paths:
    """A later rentals file beside the first one, in which the rows ``which`` holds for have another rent, or are gone."""
    later = replace(paths, rentals_file=f"rentals-{uuid.uuid4().hex}.json")
    rentals, hit = spark.read.json(f"{paths.raw}/{paths.rentals_file}"), F.coalesce(which, F.lit(False))
    rentals = rentals.filter(~hit) if drop else rentals.withColumn("rent", F.when(hit, F.concat(F.lit("1"), "rent")).otherwise(F.col("rent")))
    rentals.write.options(**PACKED).json(f"{later.raw}/{later.rentals_file}")
    return later


def _feature_lines(spark: SparkSession, d: str) -> DataFrame:
    """(fid, value): each zone feature as one JSON text."""
    geometry = F.concat(F.lit('{"type":"'), F.col("geometry.type"), F.lit('","coordinates":'), F.col("geometry.coordinates"), F.lit("}"))
    line = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json("properties"), F.lit(',"geometry":'), geometry, F.lit("}"))
    return demo.zone_features(spark, d).select("fid", line.alias("value"))


def zone_document(spark: SparkSession, d: str) -> str:
    """The zones as one FeatureCollection document, in feature order, written once per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _DOCUMENT:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/drop-{uuid.uuid4().hex}/zones.geojson"
        lines = _feature_lines(spark, d)
        first = lines.agg(F.min("fid")).first()[0]
        parts = lines.select(F.lit(1).alias("part"), "fid", F.concat(F.when(F.col("fid") == first, "").otherwise(","), "value").alias("value"))
        frame = spark.sql("""SELECT 0 AS part, 0L AS fid, '{"type":"FeatureCollection","features":[' AS value UNION ALL SELECT 2, 0L, ']}'""")
        frame.unionByName(parts).repartition(1).sortWithinPartitions("part", "fid").select("value").write.text(path)
        _DOCUMENT[key] = path
    return _DOCUMENT[key]


def _layers(spark: SparkSession, d: str) -> Paths:
    """The layer tables of the raw files: one ordered run per application."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _RUN:
        paths = raw_files(spark, d)
        run(spark, paths)
        _RUN[key] = paths
    return _RUN[key]


def file_listings(spark, d):
    """IO01: every cell of the CSV as text; an empty cell is NULL, as Spark reads it by default."""
    paths = raw_files(spark, d)
    return read_listings(spark, f"{paths.raw}/{paths.listings_file}").select("listing_id", "line_no", "zipcode", "price", "latitude")


def file_listings_inferred(spark, d):
    """IO02: the CSV with types inferred from its cells."""
    paths = raw_files(spark, d)
    return read_listings(spark, f"{paths.raw}/{paths.listings_file}", infer=True).select("listing_id", "line_no", "price", "bedrooms", "longitude")


def file_rentals(spark, d):
    """IO03, IO11: rentals from JSON with a pinned schema, singleton arrays unwrapped."""
    paths = raw_files(spark, d)
    rows = unwrap_singletons(read_rentals(spark, f"{paths.raw}/{paths.rentals_file}", multiline=False))
    return rows.select("_id", "city", "rent", "areaSqm", "deposit", "firstSeenAt")


def file_zones(spark, d):
    """IO04-IO06: zones of one GeoJSON document, read in splits at its features."""
    zones = zones_from_features(split_features(spark, zone_document(spark, d)))
    return zones.select("code", F.size("rings").alias("rings"), F.expr("aggregate(rings, 0, (acc, r) -> acc + size(r))").alias("positions"))


def file_bronze(spark, d):
    """IO07, IO08, IO10: a bronze table as it was saved, with its lineage columns."""
    paths = _layers(spark, d)
    return load(spark, target(paths, "bronze_rentals")).select("_id", "city", "postalCode", "_source", "_source_file",
                                                               F.col("_ingested_at").isNotNull().alias("stamped"))


def file_gold(spark, d):
    """IO13: raw files through bronze, silver and gold in one ordered run."""
    return load(spark, target(_layers(spark, d), "gold"))


def file_replay(spark, d):
    """IO13: the run again from the saved silver tables, into the same gold table."""
    paths = _layers(spark, d)
    run(spark, paths, start="gold")
    return load(spark, target(paths, "gold"))


def file_refresh(spark, d):
    """IO13: partitions written and kept by three refreshes: of new tables, of unchanged files, and with one city's rents changed."""
    paths = raw_files(spark, d)
    paths = replace(paths, tables=f"{ensure_checkpoint_dir(spark).rstrip('/')}/drop-{uuid.uuid4().hex}/tables")
    first = refresh(spark, paths).withColumn("refresh", F.lit("first"))
    again = refresh(spark, paths).withColumn("refresh", F.lit("unchanged"))
    city = load(spark, target(paths, "bronze_rentals")).filter("lower(city) <> 'amsterdam'").agg(F.min(F.lower("city"))).first()[0]
    later = refresh(spark, changed_drop(spark, paths, F.lower("city") == city)).withColumn("refresh", F.lit("one city"))
    return first.unionByName(again).unionByName(later).select("refresh", "step", "partitions_written", "partitions_kept")


def file_audit(spark, d):
    """IO14: the counts of the run's bronze and silver tables, as rows written beside the tables."""
    tables = ["bronze_listings", "bronze_rentals", "silver_listings", "silver_rentals"]
    rows = audit_rows(spark, _layers(spark, d)).filter(F.col("step").isin(tables) & (F.col("metric") != "fingerprint"))
    return rows.select("step", "metric", F.col("value").cast("long").alias("value"))


def file_verify(spark, d):
    """IO14: every saved table has the rows and the fingerprint that the run's audit wrote."""
    return verify(spark, _layers(spark, d)).select("step", "rows_written", "rows_read", "same")


def file_reconcile(spark, d):
    """IO14: bronze rows are the silver rows and those rejected, by reason."""
    return reconcile(spark, _layers(spark, d))


def preview_lets(spark, d):
    """IO15: the first rows in a stated order."""
    return preview(demo.lets(spark, d).orderBy("_id").select("_id", "city", "rent"), 5)


FILE_QUERIES = {
    "file_listings": file_listings,
    "file_listings_inferred": file_listings_inferred,
    "file_rentals": file_rentals,
    "file_zones": file_zones,
    "file_bronze": file_bronze,
    "file_gold": file_gold,
    "file_replay": file_replay,
    "file_refresh": file_refresh,
    "file_audit": file_audit,
    "file_verify": file_verify,
    "file_reconcile": file_reconcile,
    "preview_lets": preview_lets,
}
