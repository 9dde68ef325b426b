"""Ordered bronze → silver → gold run with restart from any saved layer (IO13, IO14).

Each layer reads the tables the previous layer wrote (a written table also cuts
the lineage, so a lost executor never replays an earlier layer) and evaluates
its plan once, in the write. Row counts and an order-free fingerprint (the sum of the rows' hashes) are
gathered with ``observe`` during that write: no extra ``count()`` jobs. They are saved as a table of
their own, which ``verify`` holds against the saved layers; ``reconcile`` accounts for every bronze row.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import city_is
from ..functions.standardize import rent_amount
from ..operators.spatial import ZoneIndex, prepare
from ..params import Assumptions, Bounds, Labels, Paths
from ..sources.geojson import read_zones
from ..sources.tables import ensure_namespace, load, passing, release, save, spread
from .bronze import bronze_listings, bronze_rentals
from .gold import gold
from .silver import silver_lets, silver_stays

LAYERS = ("bronze", "silver", "gold")

# Layer table names.
TABLES = {
    "bronze_listings": "bronze_listings",
    "bronze_rentals": "bronze_rentals",
    "silver_listings": "silver_listings",
    "silver_rentals": "silver_rentals",
    "gold": "gold_area_revenue",
    "audit": "run_audit",
}
LAYER_TABLES = [t for t in TABLES if t != "audit"]


def fingerprint(df: DataFrame) -> Column:
    """Sum of the rows' hashes (columns by name): equal for equal rows in any order, and for no rows 0."""
    return F.coalesce(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")


@dataclass
class Audit:
    """Counts per written table, filled by ``observe`` during the writes."""

    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    fingerprints: dict[str, int] = field(default_factory=dict)

    def record(self, name: str, obs: Observation) -> None:
        self.counts[name] = {k: int(v) for k, v in obs.get.items() if k != "fingerprint"}
        if "fingerprint" in obs.get:
            self.fingerprints[name] = int(obs.get["fingerprint"])


def target(paths: Paths, key: str) -> str:
    name = TABLES[key]
    return f"{paths.database}.{name}" if paths.database else f"{paths.tables.rstrip('/')}/{name}"


def _write(audit: Audit, key: str, df: DataFrame, paths: Paths, partition_by: list[str] | None = None,
           **conds) -> None:
    obs = Observation(key)
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"), fingerprint(df).alias("fingerprint"), *[F.count_if(c).alias(k) for k, c in conds.items()])
    save(df, target(paths, key), partition_by)
    audit.record(key, obs)
    release(df.sparkSession)                  # else the shuffle files of all layers stay until the run ends


def _zones(spark: SparkSession, paths: Paths, observation: Observation) -> ZoneIndex | None:
    """Zones prepared for the join, or None when no zone file exists (then no backfill). Other errors surface."""
    try:
        return prepare(read_zones(spark, f"{paths.raw.rstrip('/')}/{paths.zones_file}", per_line=paths.zones_per_line,
                                  observation=observation, split=paths.zones_split))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


# Bronze rentals are partitioned by this column: the city in lower case behind a fixed prefix, so that it
# is text for Spark whatever the city looks like. The city itself stays in the files as it came.
PART = "city_part"


def city_part(city: Column) -> Column:
    return F.coalesce(F.concat(F.lit("city "), F.lower(city)), F.lit("none"))


def run_bronze(spark: SparkSession, paths: Paths, audit: Audit) -> None:
    raw = paths.raw.rstrip("/")
    _write(audit, "bronze_listings",
           bronze_listings(spark, f"{raw}/{paths.listings_file}", source_file=paths.listings_file), paths)
    rentals = bronze_rentals(spark, f"{raw}/{paths.rentals_file}", source_file=paths.rentals_file,
                             multiline=paths.rentals_multiline)
    if paths.partition_rentals_by_city:
        # gathered by city before the write (large cities in several tasks), not a file per task and city
        rentals = rentals.withColumn(PART, city_part(F.col("city"))).hint("rebalance", F.col(PART))
    _write(audit, "bronze_rentals", rentals, paths, [PART] if paths.partition_rentals_by_city else None)


def silver_listings_step(spark: SparkSession, paths: Paths, audit: Audit, bounds: Bounds) -> None:
    # parser rejects (text given, value NULL) are observed inside the same write
    stay_rejects, zone_counts = Observation("listing_rejects"), Observation("zones")
    with passing(spark):
        zones = _zones(spark, paths, zone_counts)
        if zones is not None:
            audit.record("zones", zone_counts)
        stays = silver_stays(spread(load(spark, target(paths, "bronze_listings")), parallel_filters=True),
                             zones, bounds, stay_rejects, in_steps=True)
        zones = None                          # a quadtree of them has been met: its checkpoints and shuffle files go
        release(spark)
        _write(audit, "silver_listings", stays, paths,
               missing_pc4=F.col("pc4").isNull(), backfilled=F.col("pc4_backfilled"),
               price_outliers=F.col("is_price_outlier"))
    audit.record("silver_listings_rejects", stay_rejects)


def silver_rentals_step(spark: SparkSession, paths: Paths, audit: Audit, bounds: Bounds) -> None:
    let_rejects = Observation("rental_rejects")
    # the city filter goes below the spread so it still prunes the city partitions
    rentals = load(spark, target(paths, "bronze_rentals"))
    if PART in rentals.columns:
        rentals = rentals.filter(F.col(PART) == city_part(F.lit(paths.city))).drop(PART)
    rentals = rentals.filter(city_is(F.col("city"), paths.city))
    lets = silver_lets(spread(rentals, parallel_filters=True), paths.city, bounds, let_rejects)
    _write(audit, "silver_rentals", lets.drop("_source_file"), paths,
           rent_outliers=F.col("is_rent_outlier"), utilities_included=F.col("utilities_included"))
    audit.record("silver_rentals_rejects", let_rejects)


def run_silver(spark: SparkSession, paths: Paths, audit: Audit, bounds: Bounds) -> None:
    silver_listings_step(spark, paths, audit, bounds)
    silver_rentals_step(spark, paths, audit, bounds)


def run_gold(spark: SparkSession, paths: Paths, audit: Audit, a: Assumptions, labels: Labels) -> None:
    g = gold(load(spark, target(paths, "silver_listings")), load(spark, target(paths, "silver_rentals")), a, labels)
    _write(audit, "gold", g, paths, both_sources=F.col("revenue_advantage").isNotNull())


def run(spark: SparkSession, paths: Paths, start: str = "bronze", a: Assumptions = Assumptions(),
        bounds: Bounds = Bounds(), labels: Labels = Labels()) -> Audit:
    """Run the layers from ``start`` on; earlier layers are read from their saved tables."""
    if start not in LAYERS:
        raise ValueError(f"start must be one of {LAYERS}")
    if paths.database:
        ensure_namespace(spark, paths.database)
    audit = Audit()
    todo = LAYERS[LAYERS.index(start):]
    if "bronze" in todo:
        run_bronze(spark, paths, audit)
    if "silver" in todo:
        run_silver(spark, paths, audit, bounds)
    if "gold" in todo:
        run_gold(spark, paths, audit, a, labels)
    _save_audit(spark, paths, audit, start)
    return audit


_AUDIT = "step string, metric string, value decimal(38,0)"


def _save_audit(spark: SparkSession, paths: Paths, audit: Audit, start: str) -> None:
    """The run's counts as a table (a few rows); a run from a later layer on keeps the earlier layers' rows."""
    rows = [(step, metric, Decimal(v)) for step, metrics in audit.counts.items() for metric, v in metrics.items()]
    rows += [(step, "fingerprint", Decimal(v)) for step, v in audit.fingerprints.items()]
    if start != "bronze":
        try:
            rows += [tuple(r) for r in load(spark, target(paths, "audit")).collect() if r["step"] not in audit.counts]
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "TABLE_OR_VIEW_NOT_FOUND" not in str(e):
                raise
    save(spark.createDataFrame(rows, _AUDIT).coalesce(1), target(paths, "audit"))


def audit_rows(spark: SparkSession, paths: Paths) -> DataFrame:
    """IO14: (step, metric, value) of the last run: per table its rows and fingerprint, and the counts taken with them."""
    return load(spark, target(paths, "audit"))


def verify(spark: SparkSession, paths: Paths) -> DataFrame:
    """A row per saved table: rows written (audit) and read back, and whether count and fingerprint agree."""
    read = None
    for step in LAYER_TABLES:
        table = load(spark, target(paths, step))
        one = table.agg(F.lit(step).alias("_step"), F.count(F.lit(1)).alias("rows_read"), fingerprint(table).alias("_print"))
        read = one if read is None else read.unionByName(one)
    written = audit_rows(spark, paths).groupBy("step").agg(
        F.max(F.when(F.col("metric") == "rows", F.col("value"))).cast("long").alias("rows_written"),
        F.max(F.when(F.col("metric") == "fingerprint", F.col("value"))).alias("_wrote"))
    same = F.coalesce((F.col("rows_written") == F.col("rows_read")) & (F.col("_wrote") == F.col("_print")), F.lit(False))
    return read.join(written, F.col("_step") == F.col("step"), "left").select(F.col("_step").alias("step"), "rows_written", "rows_read", same.alias("same"))


def reconcile(spark: SparkSession, paths: Paths) -> DataFrame:
    """Per source: bronze rows, rows without each thing silver asks for (first reason counts), silver rows, and whether they add up."""
    def double(c: str) -> Column:
        return F.col(c).try_cast("double")

    listings, rentals = load(spark, target(paths, "bronze_listings")), load(spark, target(paths, "bronze_rentals"))
    no_position = double("latitude").isNull() & double("longitude").isNull()
    other = ~F.coalesce(city_is(F.col("city"), paths.city), F.lit(False))
    parts = []
    for source, bronze, silver, first, second, names in (
            ("listings", listings, "silver_listings", no_position, double("price").isNull(), ("no position", "no price")),
            ("rentals", rentals, "silver_rentals", other, rent_amount(F.col("rent")).isNull(), ("other city", "no rent"))):
        counts = bronze.agg(F.count(F.lit(1)).alias("bronze"), F.count_if(first).alias("first"), F.count_if(~first & second).alias("second"))
        kept = load(spark, target(paths, silver)).agg(F.count(F.lit(1)).alias("silver"))
        label = [F.lit(source).alias("source"), F.lit(names[0]).alias("first_reason"), F.lit(names[1]).alias("second_reason")]
        parts += [counts.select(*label, "bronze", "first", "second", F.lit(0).cast("long").alias("silver")),
                  kept.select(*label, *[F.lit(0).cast("long").alias(c) for c in ("bronze", "first", "second")], "silver")]
    rows = reduce(DataFrame.unionByName, parts).groupBy("source", "first_reason", "second_reason").agg(
        *[F.sum(c).alias(c) for c in ("bronze", "first", "second", "silver")])
    return rows.withColumn("balanced", F.col("bronze") == F.col("first") + F.col("second") + F.col("silver"))
