"""GeoJSON zones (IO04-IO06), read by Spark rather than on the driver.

Features are exploded into rows; ``properties`` is read as a map of text (an
integer code arrives as text) and ``geometry.coordinates`` as raw JSON text,
parsed per geometry type with ``from_json``. Polygon and MultiPolygon both
become a flat list of rings (the even-odd rule needs no part structure).
Features with a missing or unparsable geometry, or an empty code, are dropped.

A FeatureCollection is one JSON document, yet it need not go through one task: a text scan that
ends a record at each ``"Feature"`` splits it, wherever its lines end (``split_features``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rings import well_formed
from ..session import ensure_checkpoint_dir

# Property names tried, in order, for the zone code.
CODE_PROPERTIES = ["pc4", "PC4", "postcode4", "postcode"]

RINGS = "array<array<array<double>>>"
MULTI = "array<array<array<array<double>>>>"

FEATURE = T.StructType([
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
])
COLLECTION = T.StructType([T.StructField("features", T.ArrayType(FEATURE))])


def code_property(props: Column) -> Column:
    """IO05: the first known name present, else the first key holding 4 digits."""
    known = [F.when(F.map_contains_key(props, F.lit(k)), F.lit(k)) for k in CODE_PROPERTIES]
    fallback = F.get(F.filter(F.map_keys(props), lambda k: props[k].rlike(r"\A[0-9]{4}\z")), 0)
    return F.coalesce(*known, fallback)


def rings_of(geometry: Column) -> Column:
    """Polygon / MultiPolygon coordinates text → array of rings; anything else NULL."""
    gtype, coords = geometry.getField("type"), geometry.getField("coordinates")
    return (F.when(gtype == "Polygon", F.from_json(coords, RINGS))
            .when(gtype == "MultiPolygon", F.flatten(F.from_json(coords, MULTI))))


def zones_from_features(features: DataFrame, code_key: str | None = None,
                        observation: Observation | None = None) -> DataFrame:
    """(fid, properties, geometry) → (fid, code, rings) with IO05/IO06 applied.

    A feature without a code, or with a missing, unparsable or broken geometry, is skipped whole;
    ``observation`` counts features and those skipped.

    Without ``code_key`` the key is detected on the first feature (lowest fid),
    as one small aggregate: no feature list passes through the driver.
    """
    if code_key is None:
        first = features.agg(F.min_by("properties", "fid").alias("p")).select(
            code_property(F.col("p")).alias("k")).first()
        code_key = first["k"] if first is not None else None
    if code_key is None:
        return features.sparkSession.createDataFrame(
            [], "fid bigint, code string, rings array<array<array<double>>>")
    # exploded from one array: checks of the rings stay above their parsing, which then runs once, in the tasks the rows were dealt to
    z = features.select(F.explode(F.array(F.struct(
        F.col("fid").cast("bigint").alias("fid"),
        F.col("properties")[code_key].alias("code"),
        rings_of(F.col("geometry")).alias("rings"),
    ))).alias("_z")).select("_z.*")
    usable = well_formed() & F.col("code").isNotNull() & (F.col("code") != "")
    if observation is not None:
        z = z.observe(observation, F.count(F.lit(1)).alias("features"), F.count_if(~F.coalesce(usable, F.lit(False))).alias("skipped"))
    return z.filter(usable)


# The value of every feature's member "type". As a JSON string of its own it never lies inside another
# string (there its quotes would be escaped), so a record neither begins nor ends inside a string.
_MARK = '"Feature"'


def _depth(text: Column) -> Column:
    """Braces opened less braces closed outside strings; NULL where the text ends inside a string."""
    bare = F.regexp_replace(F.regexp_replace(text, r"\\.", ""), '"[^"]*"', "")
    net = F.length(F.replace(bare, F.lit("}"), F.lit(""))) - F.length(F.replace(bare, F.lit("{"), F.lit("")))
    return F.when(~F.contains(bare, F.lit('"')), net)


def _cut(pieces: DataFrame) -> DataFrame:
    """Each piece with ``tail`` (the rest of its own feature), ``head`` (the next feature up to its mark) and ``kind``.

    The feature ends at the first closing brace that brings the depth to -1. Kinds: first (before any feature), mid,
    last, and bad: a piece that is none of these, so its mark was no feature's type or a feature is broken.
    """
    parts = F.split("value", r"\}")

    def upto(k: Column) -> Column:
        return F.concat(F.array_join(F.slice(parts, 1, k), "}"), F.lit("}"))

    closing = F.when(F.size(parts) > 1, F.get(F.filter(F.sequence(F.lit(1), F.size(parts) - 1), lambda k: F.coalesce(_depth(upto(k)) == -1, F.lit(False))), 0))
    cut = pieces.withColumn("tail", upto(closing))
    rest = F.expr("substring(value, length(tail) + 1)")
    head = F.when(F.col("tail").isNull(), F.regexp_extract("value", r'(?s)"features"\s*:\s*\[\s*(\{.*)\z', 1)) \
        .otherwise(F.regexp_extract(rest, r"(?s)\A\s*,\s*(\{.*)\z", 1))
    cut = cut.withColumn("head", F.nullif(head, F.lit("")))
    opens = F.coalesce((_depth(F.col("head")) == 1) & F.col("head").rlike(r'"type"\s*:\s*\z'), F.lit(False))
    kind = (F.when(F.col("tail").isNull() & opens, F.lit("first")).when(opens, F.lit("mid"))
            .when(F.col("tail").isNotNull() & rest.rlike(r"\A\s*\]"), F.lit("last")).otherwise(F.lit("bad")))
    return cut.withColumn("kind", kind).drop("value")


def split_features(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame | None:
    """IO04: (fid, properties, geometry) of a FeatureCollection, read in as many tasks as the file has splits.

    Records end at each feature's ``"Feature"``, so one holds the rest of a feature and the beginning of the next one;
    both are cut apart by brace depth and joined to features by their number in the file. ``fid`` is the feature's
    position, as in the document; coordinates are JSON text without the document's blanks. None if the document cannot be cut so (a property with the value "Feature", a broken
    document): every record is checked before. An empty list of features gives no rows; a file without any mark is left
    to the plain reader, which tells an empty list from another document. The cost per feature grows
    with its closing braces times its length: a feature has three, and one for each object in its properties.
    """
    ensure_checkpoint_dir(spark)
    records = spark.read.option("lineSep", _MARK).text(path)
    pieces = records.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                            F.monotonically_increasing_id().alias("id"), "value")
    cut = _cut(pieces)

    def number_of(kind: str) -> Column:
        return F.count_if(F.col("kind") == kind)

    # a row per split of the file
    blocks = cut.groupBy("file", "block").agg(
        F.min("id").alias("least"), F.count("*").alias("n"), number_of("first").alias("firsts"), number_of("last").alias("lasts"),
        number_of("bad").alias("bads"), F.max_by("kind", "id").alias("end"), F.min_by("kind", "id").alias("begin")).checkpoint()
    whole = blocks.groupBy("file").agg(
        (F.sum("firsts") == 1) & (F.sum("lasts") == 1) & (F.sum("bads") == 0) & (F.sum("n") > 1)
        & (F.min_by("begin", "block") == "first") & (F.max_by("end", "block") == "last"))
    files = whole.collect()
    if not files or not all(r[1] for r in files):
        return None
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = blocks.select(F.col("file").alias("_f"), F.col("block").alias("_b"), (before - F.col("least")).alias("shift"))
    placed = cut.join(F.broadcast(start), (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b"))) \
        .withColumn("at", F.col("id") + F.col("shift"))
    halves = F.array(F.struct(F.col("at").alias("at"), F.col("tail"), F.lit(None).cast("string").alias("head")),
                     F.struct((F.col("at") + 1).alias("at"), F.lit(None).cast("string").alias("tail"), F.col("head")))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = placed.select("file", F.explode(halves).alias("h")).select("file", "h.*").filter("tail IS NOT NULL OR head IS NOT NULL")
    joined = rows.repartition(n, "file", "at").groupBy("file", "at").agg(F.max("head").alias("head"), F.max("tail").alias("tail"))
    feature = F.from_json(F.concat("head", F.lit(_MARK), "tail"), FEATURE).alias("f")
    return joined.select((F.col("at") - 1).alias("fid"), feature).select("fid", "f.properties", "f.geometry")


def read_features(spark: SparkSession, path: str, per_line: bool = False,
                  partitions: int | None = None, split: bool = False) -> DataFrame:
    """IO04: (fid, properties, geometry) in file order.

    A FeatureCollection file is one JSON document, read by one task; features are
    then spread over ``partitions`` (default: shuffle partitions). With ``split=True``
    the document is read in splits where it can be (``split_features``). With
    ``per_line=True`` (one Feature per line) the read itself splits.
    """
    if split and not per_line:
        feats = split_features(spark, path, partitions)
        if feats is not None:
            return feats
    if per_line:
        df = spark.read.schema(FEATURE).json(path)
        feats = df.select(F.monotonically_increasing_id().alias("fid"), "properties", "geometry")
    else:
        df = spark.read.schema(COLLECTION).option("multiLine", True).json(path)
        feats = df.select(F.posexplode("features").alias("fid", "f")).select(
            "fid", "f.properties", "f.geometry")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # dealt by row id: filters on parsed rings stay above, in as many tasks (see tables.spread)
    return feats.repartition(n, F.monotonically_increasing_id())


def read_zones(spark: SparkSession, path: str, code_key: str | None = None,
               per_line: bool = False, observation: Observation | None = None, split: bool = False) -> DataFrame:
    """IO04-IO06: GeoJSON → (fid, code, rings)."""
    return zones_from_features(read_features(spark, path, per_line, split=split), code_key, observation)
