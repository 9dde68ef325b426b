"""Bronze ingest: raw files → text tables with lineage columns (IO01, IO03, IO10, IO11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import read_listings, read_rentals, stamp, unwrap_singletons


def bronze_listings(spark: SparkSession, path: str, source: str = "airbnb",
                    source_file: str | None = None) -> DataFrame:
    """CSV, every column text, plus lineage."""
    return stamp(read_listings(spark, path), source, source_file)


def bronze_rentals(spark: SparkSession, path: str, source: str = "kamernet",
                   source_file: str | None = None, multiline: bool = True) -> DataFrame:
    """JSON with a pinned text schema, singleton arrays unwrapped, plus lineage."""
    return stamp(unwrap_singletons(read_rentals(spark, path, multiline=multiline)), source, source_file)
