"""Data-quality profiling (QA01-QA06).

Every report is one aggregate pass (``count_if`` per rule inside a single
``agg``), turned into rows afterwards with ``explode`` of a small literal-sized
array; nothing is counted by a separate job per rule. Percentages are computed
in integer arithmetic (tenths, half-up) so they are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import POSTAL_FORMATS, city_is, matches, null_or_empty
from ..functions.standardize import rent_utilities
from ..operators.aggregates import conditional_counts, frequency, rounded_mean, shape, top_values
from ..operators.ranks import quantiles, value_counts


def _pct(part: str, whole: str) -> Column:
    return F.expr(f"CASE WHEN {whole} > 0 THEN (({part} * 2000 + {whole}) div (2 * {whole})) / 10.0 END") \
        .cast("double")


def _rows(agg: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """One-row aggregate → one row per name (label, value)."""
    items = F.array(*[F.struct(F.lit(n).alias(label), F.col(n).alias(value)) for n in names])
    return agg.select(F.col("rows"), F.explode(items).alias("_r")).select("rows", f"_r.{label}", f"_r.{value}")


def profile_shape(df: DataFrame) -> DataFrame:
    """QA01 / AG08: rows x columns."""
    return shape(df)


#: Classes of a cell's text, from the bottom of the type lattice: numbers join to double, all else joins to string.
_CLASSES = {
    "bigint": r"\A[+-]?[0-9]{1,18}\z",
    "double": r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,2})?\z",
    "timestamp": r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?\z",
}


def _cell_class(c: Column) -> Column:
    """Least type of one cell: NULL (missing or empty), bigint, double, timestamp or string."""
    text = c.cast("string")
    whole, number, stamp = (text.rlike(p) for p in _CLASSES.values())
    return (F.when(null_or_empty(text), F.lit(None)).when(whole, F.lit("bigint")).when(number, F.lit("double"))
            .when(stamp & text.try_cast("timestamp").isNotNull(), F.lit("timestamp")).otherwise(F.lit("string")))


def profile_schema(df: DataFrame) -> DataFrame:
    """QA01 / IO02: a row per column with the least type that holds all its cells, and its non-NULL and NULL cells.

    The type is the join of the cells' types in the lattice null < bigint < double < string, null < timestamp <
    string. Which types occur is a count per type and column, so partial results merge by addition: one pass, one
    row per task. A column of empty or missing cells only has type ``void``.
    """
    kinds = [*_CLASSES, "string"]
    cells = df.select(*[_cell_class(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    one = cells.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"_{i}") == k).alias(f"_{i}_{k}")
                                                       for i in range(len(df.columns)) for k in kinds])

    def report(i: int, name: str) -> Column:
        n = {k: F.col(f"_{i}_{k}") for k in kinds}
        numbers, stamps, some = n["bigint"] + n["double"] > 0, n["timestamp"] > 0, sum(n.values())
        kind = (F.when(some == 0, F.lit("void")).when((n["string"] > 0) | (numbers & stamps), F.lit("string"))
                .when(stamps, F.lit("timestamp")).when(n["double"] > 0, F.lit("double")).otherwise(F.lit("bigint")))
        return F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"), kind.alias("type"),
                        some.alias("non_null"), (F.col("rows") - some).alias("nulls"))

    return one.select(F.explode(F.array(*[report(i, c) for i, c in enumerate(df.columns)])).alias("_r")).select("_r.*")


def typed(df: DataFrame) -> DataFrame:
    """IO02: text columns cast to the types their own cells have (one pass to find them; a row per column reaches the driver)."""
    kinds = {r["column"]: r["type"] for r in profile_schema(df).collect()}
    return df.select(*[F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).try_cast(kinds[c]).alias(c)
                       if kinds[c] in _CLASSES else F.col(f"`{c}`") for c in df.columns])


def profile_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """QA02: per column, rows missing (NULL or empty text) and the percentage."""
    agg = conditional_counts(df, {c: null_or_empty(F.col(c).cast("string")) for c in cols})
    out = _rows(agg, cols, "column", "missing")
    return out.select("column", "missing", F.col("rows").alias("total"), _pct("missing", "rows").alias("pct"))


def profile_formats(df: DataFrame, col: str, patterns: dict[str, str] = POSTAL_FORMATS) -> DataFrame:
    """QA04: rows per text format (regex) among non-NULL values."""
    agg = conditional_counts(df.filter(F.col(col).isNotNull()),
                             {name: matches(F.col(col), rx) for name, rx in patterns.items()})
    return _rows(agg, list(patterns), "format", "matching").select(
        "format", "matching", F.col("rows").alias("non_null"))


def profile_frequency(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """QA05: category frequencies, most frequent first; ``top`` keeps a top-n report."""
    return frequency(df, col, top)


def profile_top(df: DataFrame, col: str, top: int) -> DataFrame:
    """QA05 for a column of very many distinct values: the same top-n report, most values never shuffled."""
    return top_values(df, col, top)


def profile_numeric(df: DataFrame, col: str, bound: float) -> DataFrame:
    """QA03 / AG10: count, mean, stddev, min, quartiles, max and rows above ``bound`` (FI11)."""
    return column_summaries(df, [col], bound).drop("column")


def column_summaries(df: DataFrame, cols: list[str], bound: float | None = None) -> DataFrame:
    """QA03 / AG10 for several columns in one pass: a row per column, as ``profile_numeric``.

    All are taken from the counts of the distinct values. Quartiles are exact (interpolated, as ``percentile``) and
    come from range-partitioned values, so no task holds all of a column's values (``operators.ranks``).
    """
    n, x = F.col("n"), F.col("x")
    counts = value_counts(df, {c: F.col(f"`{c}`").try_cast("double") for c in cols}).checkpoint()
    units = (x.try_cast("decimal(22,4)") * 10_000).cast("decimal(22,0)")
    above = F.sum(F.when(x > F.lit(bound), n).otherwise(0)) if bound is not None else F.lit(None).cast("long")
    sums = counts.groupBy("column").agg(
        F.sum(n).alias("count"), F.sum(units * n).cast("decimal(38,0)").alias("_sum"), F.sum(x * n).alias("_x"), F.sum(x * x * n).alias("_xx"),
        F.min(x).alias("min"), F.max(x).alias("max"), above.alias("above_bound"))
    at = quantiles(counts, [0.25, 0.5, 0.75]).groupBy(F.col("column").alias("_q")).agg(
        *[F.round(F.max(F.when(F.col("share") == s, F.col("value"))), 4).alias(name) for s, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string").withColumnRenamed("column", "_c")
    one = (every.join(sums, F.col("_c") == F.col("column"), "left").drop("column").join(at, F.col("_c") == F.col("_q"), "left")
           .withColumn("count", F.coalesce("count", F.lit(0))))
    if bound is not None:
        one = one.withColumn("above_bound", F.coalesce("above_bound", F.lit(0)))
    spread = F.when(F.col("count") > 1, F.sqrt(F.greatest(F.col("_xx") - F.col("_x") * F.col("_x") / F.col("count"), F.lit(0.0)) / (F.col("count") - 1)))
    return one.select(F.col("_c").alias("column"), "count", rounded_mean("_sum", "count", 4, 4).alias("mean"), F.round(spread, 4).alias("stddev"),
                      "min", "q25", "q50", "q75", "max", "above_bound")


def summary(df: DataFrame, *cols: str) -> DataFrame:
    """AG10: Spark's column summary (count, mean, stddev, min, quartiles, max)."""
    return df.select(*[F.col(c).try_cast("double").alias(c) for c in cols]).summary()


# The issue table's rows, by dataset.
LISTING_ISSUES = ["missing_postal_codes", "non_standard_postal_formats", "price_outliers", "missing_bedrooms", "missing_review_scores"]
RENTAL_ISSUES = ["other_city_records", "rent_text_needs_parsing", "utilities_included"]
ARRAY_ISSUES = ["single_element_arrays"]


def issue_report(listings: DataFrame, rentals: DataFrame, singletons: DataFrame,
                 city: str = "amsterdam", price_lo: float = 10.0, price_hi: float = 2000.0) -> DataFrame:
    """QA06: the issue table, counted from the data (one pass per source)."""
    price = F.col("price").try_cast("double")
    zc = F.col("zipcode")
    s = conditional_counts(listings, {
        "missing_postal_codes": null_or_empty(zc),
        "non_standard_postal_formats": ~null_or_empty(zc) & ~zc.rlike(r"^[0-9]{4}$"),
        "price_outliers": (price < F.lit(price_lo)) | (price > F.lit(price_hi)),
        "missing_bedrooms": null_or_empty(F.col("bedrooms")),
        "missing_review_scores": null_or_empty(F.col("review_scores_value")),
    })
    in_city = F.coalesce(city_is(F.col("city"), city), F.lit(False))
    r = conditional_counts(rentals, {
        "other_city_records": ~in_city,
        "rent_text_needs_parsing": in_city & F.col("rent").isNotNull() & ~F.col("rent").rlike(r"^[0-9]+$"),
        "utilities_included": in_city & rent_utilities(F.col("rent")),
    })
    g = conditional_counts(singletons, {"single_element_arrays": F.size(F.col("crawledAt")) == 1})
    parts = [(s, "listings", LISTING_ISSUES), (r, "rentals", RENTAL_ISSUES), (g, "rentals", ARRAY_ISSUES)]
    out = None
    for agg, dataset, names in parts:
        items = F.array(*[F.struct(F.lit(i).alias("issue"), F.lit(dataset).alias("dataset"), F.col(i).alias("count")) for i in names])
        part = agg.select(F.explode(items).alias("_r")).select("_r.*")
        out = part if out is None else out.unionByName(part)
    return out
