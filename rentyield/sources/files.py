"""Flat-file sources (IO01-IO03), lineage stamp (IO10), singleton unwrap (IO11)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rentals fields the scraper stored as one-element arrays.
SINGLETON_FIELDS = ["_id", "crawledAt", "firstSeenAt", "lastSeenAt", "detailsCrawledAt"]

# Rentals fields the silver job reads. Every one is pinned to text
# (a field that infers as a number would otherwise reach the text parsers as a
# number); singleton fields are arrays of text.
RENTAL_TEXT_FIELDS = ["city", "rent", "postalCode", "areaSqm", "matchCapacity", "deposit",
                      "latitude", "longitude", "propertyType", "furnish"]

RENTALS_SCHEMA = T.StructType(
    [T.StructField(f, T.ArrayType(T.StringType())) for f in SINGLETON_FIELDS]
    + [T.StructField(f, T.StringType()) for f in RENTAL_TEXT_FIELDS]
)


def read_listings(spark: SparkSession, path: str, infer: bool = False, multiline: bool = False,
                  escape: str | None = None) -> DataFrame:
    """IO01 / IO02: CSV with header. Default: every column text, no inference pass.

    Other options are Spark's defaults, as in the reference. ``multiline=True``
    keeps quoted fields with line breaks intact but reads each file in one task;
    ``escape='"'`` reads RFC 4180 doubled quotes.
    """
    r = spark.read.option("header", True).option("inferSchema", infer).option("multiLine", multiline)
    if escape is not None:
        r = r.option("escape", escape)
    return r.csv(path)


def read_rentals(spark: SparkSession, path: str, schema: T.StructType | None = RENTALS_SCHEMA,
                 multiline: bool = True) -> DataFrame:
    """IO03: JSON array file(s) with an explicit schema (no inference scan).

    A multi-line JSON file is read by one task; pass ``multiline=False`` for
    JSON-lines input, which splits. ``schema=None`` infers (profiling only).
    """
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def stamp(df: DataFrame, source: str, source_file: str | None = None) -> DataFrame:
    """IO10: lineage columns. Without a given name the file name comes from the scan."""
    file_col = F.lit(source_file) if source_file is not None else F.col("_metadata.file_name")
    return df.withColumns({
        "_source": F.lit(source),
        "_ingested_at": F.current_timestamp(),
        "_source_file": file_col,
    })


def unwrap_singletons(df: DataFrame, cols: Iterable[str] = SINGLETON_FIELDS) -> DataFrame:
    """IO11: replace one-element arrays by their element, in one projection.

    Only columns that exist *and* are arrays are touched (a scalar column is left
    as is); an empty or NULL array gives NULL instead of failing under ANSI.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    todo = {c: F.try_element_at(F.col(c), F.lit(1)) for c in cols
            if isinstance(types.get(c), T.ArrayType)}
    return df.withColumns(todo) if todo else df
