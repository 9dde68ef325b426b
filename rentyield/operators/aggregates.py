"""Per-area measures (AG01-AG05) and profiling aggregates (AG06-AG10).

The per-area measures come from one price histogram per side: rows are counted by
(area, price, net), with a partial aggregate before the shuffle, so an area holding a
third of all rows costs each input task at most one row per distinct price and is
spread over the tasks by price. A running count over an area's distinct prices then
gives exact lower medians, and sums of whole units give means that are rounded once.
The outlier bounds limit an area to some 200,000 distinct prices. Results do not
depend on the order of rows or tasks.

``method="digits"`` finds the medians digit by digit instead (``operators.ranks``): for areas
of any number of distinct prices, as when the outlier bounds are wide open.

``method="approx"`` takes medians from ``percentile_approx`` instead, as the
reference does, and ``method="exact"`` from ``percentile_disc``, which buffers a whole
group in one task and is only meant for tests and small data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import drop_written, written
from .ranks import digit_medians
from .revenue import money

DEFAULT_ACCURACY = 10000
DEFAULT_METHOD = "histogram"
MONEY_SCALE = 2
NET_SCALE = 6
OTHER_SCALE = 12        # review scores and areas keep their decimals


def rounded_mean(units: str, count: str, scale: int, digits: int = 2) -> Column:
    """AG04: sum of whole units (10^-scale each) over a count, rounded half away from zero once, as DOUBLE."""
    d = f"(CAST({10 ** (scale - digits)} AS DECIMAL(20,0)) * CAST({count} AS DECIMAL(18,0)))"
    rounded = f"(2 * abs({units}) + {d}) div (2 * {d})"
    return F.expr(f"CASE WHEN {count} > 0 THEN sign({units}) * CAST({rounded} AS DOUBLE) / {10 ** digits} END").cast("double")


def _units(c: Column, scale: int) -> Column:
    """Whole units of 10^-scale; values that do not fit become NULL."""
    return (c.try_cast(f"decimal({26 + scale},{scale})") * F.lit(10 ** scale).cast("decimal(13,0)")).try_cast("decimal(38,0)")


def mean2(c: Column, scale: int = OTHER_SCALE, digits: int = 2) -> list[Column]:
    """The two aggregates ``rounded_mean`` needs: sum of whole units, and count."""
    u = _units(c, scale)
    return [F.sum(u).try_cast("decimal(38,0)"), F.count(u)]


def median2(col: str, exact: bool = False, accuracy: int = DEFAULT_ACCURACY, digits: int = 2) -> Column:
    """AG05: lower median (no interpolation) of column ``col``, rounded, as DOUBLE."""
    if exact:
        m = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{col}`)")
    else:
        m = F.percentile_approx(F.col(col), 0.5, accuracy)
    return F.round(m, digits).cast("double")


def _lower_median(value: str, upto: str, total: str) -> Column:
    reached = F.when(F.col(value).isNotNull() & (2 * F.col(upto) >= F.col(total)), F.col(value))
    return F.round(F.min(reached), 2).cast("double")


def area_measures(df: DataFrame, key: str, price: Column, net: Column, other: Column,
                  method: str = DEFAULT_METHOD, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """(key, count, avg_price, median_price, avg_net, median_net, avg_other) per area.

    Count and price measures are over non-NULL prices, the others over their own non-NULL values.
    """
    rows = df.select(F.col(key).alias(key), price.alias("_p"), net.alias("_n"), other.alias("_o"))
    means = [F.col(key), F.col("_count").alias("count"), rounded_mean("_ps", "_count", MONEY_SCALE).alias("avg_price"), F.col("median_price"),
             rounded_mean("_ns", "_nc", NET_SCALE).alias("avg_net"), F.col("median_net"),
             rounded_mean("_os", "_oc", OTHER_SCALE).alias("avg_other")]
    if method in ("approx", "exact"):
        (ps, pc), (ns, nc), (os_, oc) = mean2(F.col("_p"), MONEY_SCALE), mean2(F.col("_n"), NET_SCALE), mean2(F.col("_o"))
        return rows.groupBy(key).agg(
            pc.alias("_count"), ps.alias("_ps"), ns.alias("_ns"), nc.alias("_nc"), os_.alias("_os"), oc.alias("_oc"),
            median2("_p", method == "exact", accuracy).alias("median_price"),
            median2("_n", method == "exact", accuracy).alias("median_net")).select(*means)

    if method == "digits":
        return _measures_by_digits(rows, key).select(*means)

    os_, oc = mean2(F.col("_o"))
    hist = rows.groupBy(key, "_p", "_n").agg(F.count(F.lit(1)).alias("_c"), os_.alias("_os"), oc.alias("_oc"))
    area = Window.partitionBy(key)
    for value, name in (("_p", "p"), ("_n", "n")):      # NULLs weigh nothing
        hist = hist.withColumn(f"_{name}w", F.when(F.col(value).isNotNull(), F.col("_c")).otherwise(F.lit(0)))
        upto = area.orderBy(value).rangeBetween(Window.unboundedPreceding, 0)
        hist = hist.withColumns({f"_{name}upto": F.sum(f"_{name}w").over(upto), f"_{name}total": F.sum(f"_{name}w").over(area)})
    out = hist.groupBy(key).agg(
        F.sum("_pw").alias("_count"), F.sum(_units(F.col("_p"), MONEY_SCALE) * F.col("_pw")).try_cast("decimal(38,0)").alias("_ps"),
        _lower_median("_p", "_pupto", "_ptotal").alias("median_price"),
        F.sum("_nw").alias("_nc"), F.sum(_units(F.col("_n"), NET_SCALE) * F.col("_nw")).try_cast("decimal(38,0)").alias("_ns"),
        _lower_median("_n", "_nupto", "_ntotal").alias("median_net"),
        F.sum("_os").try_cast("decimal(38,0)").alias("_os"), F.sum("_oc").alias("_oc"))
    return out.select(*means)


def _measures_by_digits(rows: DataFrame, key: str) -> DataFrame:
    """Sums, counts and medians from partial aggregates only; prices and nets beyond 10^12 count as missing in the medians."""
    units = {"_pu": _units(F.col("_p"), MONEY_SCALE), "_nu": _units(F.col("_n"), NET_SCALE)}
    limit = F.lit(10 ** 18).cast("decimal(38,0)")
    rows, path = written(rows)          # made once for the medians and the sums
    whole = rows.select(key, *[F.when(F.abs(u) <= limit, u).cast("long").alias(name) for name, u in units.items()])
    found = digit_medians(whole, key, list(units)).withColumnRenamed(key, "_key")
    (ps, pc), (ns, nc), (os_, oc) = mean2(F.col("_p"), MONEY_SCALE), mean2(F.col("_n"), NET_SCALE), mean2(F.col("_o"))
    sums = rows.groupBy(key).agg(pc.alias("_count"), ps.alias("_ps"), ns.alias("_ns"), nc.alias("_nc"), os_.alias("_os"), oc.alias("_oc"))
    sums, _ = written(sums)
    drop_written(rows.sparkSession, [path])
    as_money = [F.round((F.col(u).cast("decimal(24,6)") / F.lit(10 ** scale).cast("decimal(8,0)")).cast("decimal(24,6)"), 2).cast("double").alias(name)
                for u, scale, name in (("_pu", MONEY_SCALE, "median_price"), ("_nu", NET_SCALE, "median_net"))]
    return sums.join(found.select("_key", *as_money), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def area_stays(rev: DataFrame, key: str = "pc4", method: str = DEFAULT_METHOD,
               accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """AG01: per-area short-stay measures (count, mean/median price and net, mean score)."""
    m = area_measures(rev, key, money(F.col("price")), F.col("annual_net_revenue").try_cast("decimal(24,6)"),
                      F.col("review_scores_value"), method, accuracy)
    # The gold table's column names.
    return m.select(
        key,
        F.col("count").alias("airbnb_listing_count"),
        F.col("avg_price").alias("airbnb_avg_nightly_price"),
        F.col("median_price").alias("airbnb_median_nightly_price"),
        F.col("avg_net").alias("airbnb_avg_annual_net_revenue"),
        F.col("median_net").alias("airbnb_median_annual_net_revenue"),
        F.col("avg_other").alias("airbnb_avg_review_score"),
    )


def area_lets(rev: DataFrame, key: str = "pc4", method: str = DEFAULT_METHOD,
              accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """AG02: per-area let measures (count, mean/median rent and net, mean area)."""
    m = area_measures(rev, key, money(F.col("rent_amount")), F.col("annual_net_revenue").try_cast("decimal(24,6)"),
                      F.col("area_sqm"), method, accuracy)
    # The gold table's column names.
    return m.select(
        key,
        F.col("count").alias("kamernet_listing_count"),
        F.col("avg_price").alias("kamernet_avg_monthly_rent"),
        F.col("median_price").alias("kamernet_median_monthly_rent"),
        F.col("avg_net").alias("kamernet_avg_annual_net_revenue"),
        F.col("median_net").alias("kamernet_median_annual_net_revenue"),
        F.col("avg_other").alias("kamernet_avg_area_sqm"),
    )


def frequency(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """AG07 + SO02/SO03: category counts, most frequent first (ties by value); ``top_values`` for a short report of a wide column."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc_nulls_first(col))
    return out if top is None else out.limit(top)


def top_values(df: DataFrame, col: str, n: int, tracked: int = 10_000, buckets: int = 1 << 16) -> DataFrame:
    """AG07 + SO02/SO03 + FI08: ``frequency(df, col, n)``, exactly, for a column of very many distinct values.

    A frequent-items summary (merged from one per task, at most ``tracked`` values each) proposes candidates. One
    aggregate counts these exactly, and all other rows by a hash of their value in ``buckets`` buckets: a bucket's
    total bounds the count of every value in it. Values outside the candidates are counted only in buckets whose total
    reaches the n-th largest candidate count, so a value is left out only if it is proven not to be in the report.
    Where few values stand out few buckets are left; where counts are flat all are, and the report costs what
    ``frequency`` costs. NULL is a value as any other; an empty table gives no rows; ties go to the smaller value.
    The column is of a type that ``approx_top_k`` takes (text, numbers, dates, times, booleans).
    """
    ensure_checkpoint_dir(df.sparkSession)
    one = df.select(F.col(f"`{col}`").alias("_v"))
    items = F.expr(f"approx_top_k(_v, {int(n)}, {max(int(tracked), int(n))})")
    proposed = one.filter("_v IS NOT NULL").agg(items.alias("_top")).select(F.explode("_top.item").alias("_c"))
    # at most n + 1 rows, by construction
    proposed = proposed.unionByName(df.sparkSession.range(1).select(F.lit(None).cast(one.schema["_v"].dataType).alias("_c"))).withColumn("_is", F.lit(True)).checkpoint()
    told = one.join(F.broadcast(proposed), F.col("_v").eqNullSafe(F.col("_c")), "left").select(
        "_v", F.coalesce("_is", F.lit(False)).alias("_is"), F.pmod(F.xxhash64("_v"), F.lit(buckets)).alias("_b"))
    # n + 1 + buckets rows at most, also from each task
    counts = told.groupBy(F.when(F.col("_is"), F.col("_v")).alias("_v"), "_is", F.when(~F.col("_is"), F.col("_b")).alias("_b")) \
        .agg(F.count(F.lit(1)).alias("count")).checkpoint()
    exact = counts.filter("_is").select("_v", "count")
    best = [r["count"] for r in exact.orderBy(F.desc("count")).limit(n).select("count").collect()]
    floor = best[-1] if len(best) == n and n else 0
    hot = counts.filter(~F.col("_is") & (F.col("count") >= floor)).select(F.col("_b").alias("_hot"))
    rest = told.filter(~F.col("_is")).join(F.broadcast(hot), F.col("_b") == F.col("_hot"), "left_semi") \
        .groupBy("_v").agg(F.count(F.lit(1)).alias("count"))
    return exact.unionByName(rest).withColumnRenamed("_v", col).orderBy(F.desc("count"), F.asc_nulls_first(f"`{col}`")).limit(n)


def conditional_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """AG09: one pass, one row: total rows plus a count per named condition."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(cond).alias(name) for name, cond in rules.items()])


def shape(df: DataFrame) -> DataFrame:
    """AG08: rows x columns as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("cols", F.lit(len(df.columns)))
