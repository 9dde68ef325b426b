"""A run again by what changed (IO13): only partitions and layers whose inputs differ from the last run's are written.

Every input has a row count and an order-free fingerprint (``run.fingerprint``) per part, taken without the lineage
columns: listings and zones as one part each, rentals by city as bronze stores them. The prints are saved beside the
tables. The next refresh takes them anew in one scan of the raw files, joins both tables of prints, and

* rewrites only the changed or new partitions of the bronze rentals (dynamic partition overwrite); if a partition has
  gone the table is written whole, so that none is left over;
* rewrites a silver table only if its own inputs changed (for the rentals: the partition of the city in question) or
  its bounds did; gold if a silver table or the assumptions did.

Prints are saved after the tables: a run that breaks off is simply done again. A column that comes or goes changes
every print. Tables that nobody printed (an ordered ``run``) are written whole once.
"""

from __future__ import annotations

import zlib
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import Assumptions, Bounds, Labels, Paths
from ..session import ensure_checkpoint_dir
from ..sources.geojson import read_features
from ..sources.tables import ensure_namespace, load, release, save
from . import run as R
from .bronze import bronze_listings, bronze_rentals

PRINTS = "run_prints"
_PRINTS = "input string, part string, rows long, print decimal(38,0)"
_WHOLE = "all"


def _missing(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "TABLE_OR_VIEW_NOT_FOUND" in str(e)


def _target(paths: Paths) -> str:
    return f"{paths.database}.{PRINTS}" if paths.database else f"{paths.tables.rstrip('/')}/{PRINTS}"


def prints_of(df: DataFrame, name: str, part: str | None = None) -> DataFrame:
    """(input, part, rows, print) of a table, a row per part. A table without rows still has its row, if it has no parts."""
    data = df.drop("_ingested_at", "_source_file", *([part] if part else []))
    measures = [F.count(F.lit(1)).alias("rows"), R.fingerprint(data).alias("print")]
    # the names and types too: a table with other columns is another table
    schema = F.lit(Decimal(zlib.crc32(repr(sorted(data.dtypes)).encode())))
    one = df.groupBy(F.col(part).alias("part")).agg(*measures) if part else df.agg(*measures).withColumn("part", F.lit(_WHOLE))
    return one.select(F.lit(name).alias("input"), "part", "rows", (F.col("print") + schema).cast("decimal(38,0)").alias("print"))


def _parameters(spark: SparkSession, **values) -> DataFrame:
    rows = [(name, _WHOLE, 0, Decimal(zlib.crc32(repr(v).encode()))) for name, v in values.items()]
    return spark.createDataFrame(rows, _PRINTS)


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(input, part, status): same, changed, new or gone."""
    a, b = old.alias("a"), new.alias("b")
    status = (F.when(F.col("a.input").isNull(), "new").when(F.col("b.input").isNull(), "gone")
              .when((F.col("a.rows") == F.col("b.rows")) & (F.col("a.print") == F.col("b.print")), "same").otherwise("changed"))
    on = (F.col("a.input") == F.col("b.input")) & (F.col("a.part") == F.col("b.part"))
    return a.join(b, on, "full_outer").select(F.coalesce("a.input", "b.input").alias("input"), F.coalesce("a.part", "b.part").alias("part"), status.alias("status"))


def _old_prints(spark: SparkSession, paths: Paths) -> DataFrame:
    none = spark.createDataFrame([], _PRINTS)
    try:
        R.audit_rows(spark, paths)
        return load(spark, _target(paths))
    except AnalysisException as e:
        if _missing(e):
            return none
        raise


def _overwrite_parts(df: DataFrame, target: str, part: str) -> None:
    """Write the partitions that the rows belong to; the table's others stay as they are."""
    if "/" not in target:       # a catalog table is filled by position
        df = df.select(*df.sparkSession.table(target).columns)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if "/" in target:
        w.partitionBy(part).parquet(target)
    else:
        w.insertInto(target)


def refresh(spark: SparkSession, paths: Paths, a: Assumptions = Assumptions(), bounds: Bounds = Bounds(), labels: Labels = Labels()) -> DataFrame:
    """Bring the layer tables up to the raw files; returns (step, partitions_written, partitions_kept) per table.

    The tables equal those of a whole ``run`` over the same files, but for ``_ingested_at`` and ``_source_file`` of
    parts that were kept: they say when and in which file their rows came in.
    """
    if paths.database:
        ensure_namespace(spark, paths.database)
    ensure_checkpoint_dir(spark)
    raw = paths.raw.rstrip("/")
    listings = bronze_listings(spark, f"{raw}/{paths.listings_file}", source_file=paths.listings_file)
    rentals = bronze_rentals(spark, f"{raw}/{paths.rentals_file}", source_file=paths.rentals_file, multiline=paths.rentals_multiline)
    part = R.PART if paths.partition_rentals_by_city else None
    if part:
        rentals = rentals.withColumn(part, R.city_part(F.col("city")))
    new = prints_of(listings, "listings").unionByName(prints_of(rentals, "rentals", part)).unionByName(
        _parameters(spark, layout=(part,), bounds=(bounds, paths.city), model=(a, labels)))
    try:
        features = read_features(spark, f"{raw}/{paths.zones_file}", per_line=paths.zones_per_line, split=paths.zones_split)
        # map columns have no hash; the position decides where zones overlap, so it counts
        place = "fid" if not paths.zones_per_line else F.lit(0).alias("fid")
        new = new.unionByName(prints_of(features.select(place, F.to_json("properties").alias("properties"), F.to_json("geometry").alias("geometry")), "zones"))
    except AnalysisException as e:
        if not _missing(e):
            raise
    new = new.checkpoint()                    # a row per part: one scan of the raw files
    old = _old_prints(spark, paths).checkpoint()
    found = changes(old, new).checkpoint()
    counts = {(r["input"], r["status"]): r["count"] for r in found.groupBy("input", "status").count().collect()}
    own = R.city_part(F.lit(paths.city)) if part else F.lit(_WHOLE)
    city = found.filter((F.col("input") == "rentals") & (F.col("part") == own) & (F.col("status") != "same")).count() > 0

    def differs(name: str) -> bool:
        return any(counts.get((name, s), 0) for s in ("new", "changed", "gone"))

    audit, written = R.Audit(), {}
    if differs("listings"):
        R._write(audit, "bronze_listings", listings, paths)
    written["bronze_listings"] = (int(differs("listings")), int(not differs("listings")))
    total = new.filter("input = 'rentals'").count()
    fresh = counts.get(("rentals", "new"), 0) + counts.get(("rentals", "changed"), 0)
    # a first run has no table to change; a partition that went has to be dropped; another layout is another table
    anew = differs("layout") or counts.get(("rentals", "gone"), 0) > 0 or not part
    if anew and (differs("rentals") or differs("layout")):
        R._write(audit, "bronze_rentals", rentals.hint("rebalance", F.col(part)) if part else rentals, paths, [part] if part else None)
        written["bronze_rentals"] = (total, 0)
    elif differs("rentals"):
        which = found.filter((F.col("input") == "rentals") & (F.col("status") != "same")).select(F.col("part").alias("_p"))
        some = rentals.join(F.broadcast(which), F.col(part) == F.col("_p"), "left_semi").hint("rebalance", F.col(part))
        target = R.target(paths, "bronze_rentals")
        _overwrite_parts(some, target, part)
        release(spark)
        if paths.database:
            spark.catalog.refreshTable(target)
        table = load(spark, target)
        row = table.agg(F.count(F.lit(1)).alias("rows"), R.fingerprint(table).alias("print")).first()
        audit.counts["bronze_rentals"], audit.fingerprints["bronze_rentals"] = {"rows": row["rows"]}, int(row["print"])
        written["bronze_rentals"] = (fresh, total - fresh)
    else:
        written["bronze_rentals"] = (0, total)
    stays = differs("listings") or differs("zones") or differs("bounds")
    lets = city or differs("bounds") or differs("layout")
    if stays:
        R.silver_listings_step(spark, paths, audit, bounds)
    if lets:
        R.silver_rentals_step(spark, paths, audit, bounds)
    gold = stays or lets or differs("model")
    if gold:
        R.run_gold(spark, paths, audit, a, labels)
    for step, yes in (("silver_listings", stays), ("silver_rentals", lets), ("gold", gold)):
        written[step] = (int(yes), int(not yes))
    if audit.counts:
        R._save_audit(spark, paths, audit, "silver" if counts.get(("layout", "same")) else "bronze")
        save(new.coalesce(1), _target(paths))
    rows = [(step, *written[step]) for step in R.LAYER_TABLES]
    return spark.createDataFrame(rows, "step string, partitions_written long, partitions_kept long")
