"""Exact order statistics without one task that holds all values.

``quantiles`` (AG10): the distinct values of all columns are counted, range-partitioned by (column, value) and numbered by
range; the ranges' counts tell which of them hold the wanted ranks, and only within these a running count finds the
values. A task sees one range; the table of ranges has a row per range and column.

``digit_medians`` (AG05): the lower median of every group by refining it digit by digit. Each pass counts the rows
that agree with the digits found so far, which it keeps for the next one, by their next digit (2^bits counters a group and task at most), so a
group that holds a third of all rows, or millions of distinct values, costs no task more than its counters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import drop_written, written

#: Most groups whose digits found so far are broadcast to the rows of a pass.
BROADCAST_GROUPS = 500_000


def value_counts(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """(column, x, n): how often each non-NULL value occurs, of several DOUBLE columns in one pass."""
    items = F.array(*[F.struct(F.lit(name).alias("column"), c.cast("double").alias("x")) for name, c in cols.items()])
    long = df.select(F.explode(items).alias("_i")).select("_i.column", "_i.x").filter(F.col("x").isNotNull())
    return long.groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))


def quantiles(counts: DataFrame, shares: list[float], parts: int | None = None) -> DataFrame:
    """(column, share, value): exact quantiles, interpolated between neighbours, from (column, x, n) counts.

    NaN counts as the largest value. A column without values has no rows.
    """
    spark = counts.sparkSession
    ensure_checkpoint_dir(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the number of its range is kept with each value: later steps need not deal the rows alike
    dealt = counts.repartitionByRange(parts, "column", "x").withColumn("part", F.spark_partition_id()).checkpoint()
    ranges = dealt.groupBy("column", "part").agg(F.sum("n").alias("held"))
    before = F.sum("held").over(Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("held").over(Window.partitionBy("column"))
    ranges = ranges.select("column", "part", "held", F.coalesce(before, F.lit(0)).alias("begin"), total.alias("total"))
    place = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    wanted = ranges.select("column", "part", "held", "begin", "total", place)
    at = (F.col("total") - 1) * F.col("share")
    ranks = F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))).alias("rank")
    # a row per range that holds a wanted rank: two per column and share at most
    wanted = wanted.select("column", "part", "begin", "share", at.alias("at"), ranks).filter(
        (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("begin") + F.col("held")))
    wanted = wanted.select(F.col("column").alias("_c"), F.col("part").alias("_p"), "begin", "share", "at", "rank").checkpoint()
    needed = wanted.select("_c", "_p").distinct()
    inside = dealt.join(F.broadcast(needed), (F.col("column") == F.col("_c")) & (F.col("part") == F.col("_p")), "left_semi")
    upto = F.sum("n").over(Window.partitionBy("column", "part").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    hits = (inside.withColumn("upto", upto)
            .join(F.broadcast(wanted), (F.col("column") == F.col("_c")) & (F.col("part") == F.col("_p"))
                  & (F.col("rank") < F.col("begin") + F.col("upto")) & (F.col("rank") >= F.col("begin") + F.col("upto") - F.col("n"))))
    low, high = F.min("x"), F.max("x")
    share_up = F.max(F.col("at") - F.floor("at"))
    return hits.groupBy("column", "share").agg(F.when(low == high, low).otherwise(low + (high - low) * share_up).alias("value"))


def digit_medians(df: DataFrame, key: str, values: list[str], bits: int = 10) -> DataFrame:
    """(key, *values): the lower median of each whole-number column per group; NULLs do not count, a NULL key is a group.

    Values span less than 2^62. A group without values in any column has no row.
    """
    spark = df.sparkSession
    items = F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).cast("long").alias("v")) for i, c in enumerate(values)])
    rows = df.select(F.col(key).alias("g"), F.explode(items).alias("_i")).select("g", "_i.which", "_i.v").filter(F.col("v").isNotNull())
    rows, path = written(rows)
    passing = []
    state, last = written(rows.groupBy("g", "which").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n"))
                          .select("g", "which", "low", F.length(F.bin(F.col("high") - F.col("low"))).alias("len"),
                                  F.expr("(n + 1) div 2").alias("rank"), F.lit(0).cast("long").alias("prefix")))
    passing.append(last)
    top = state.agg(F.max("len"), F.count(F.lit(1))).first()
    passes = max(1, -(-int(top[0] or 0) // bits))
    for p in range(passes):
        held = state.select(F.col("g").alias("_g"), F.col("which").alias("_w"), "low", "len", "rank", "prefix")
        held = F.broadcast(held) if top[1] <= BROADCAST_GROUPS else held
        same = F.col("g").eqNullSafe(F.col("_g")) & (F.col("which") == F.col("_w"))
        # each group's digits begin at the first bit of its own span
        done, shift = (F.greatest(F.col("len") - bits * q, F.lit(0)) for q in (p, p + 1))
        agree = rows.join(held, same)
        if p:       # the rows that agree so far, a small share after the first digit, are all that the later passes read
            agree = agree.filter(F.call_function("shiftright", F.col("v") - F.col("low"), done) == F.col("prefix"))
            rows, less = written(agree.select("g", "which", "v"))
            drop_written(spark, [path])
            path = less
            agree = rows.join(held, same)
        agree = agree.withColumn("d", F.call_function("shiftright", F.col("v") - F.col("low"), shift))
        counted = agree.groupBy("g", "which", "d").agg(F.count(F.lit(1)).alias("c"), *[F.max(c).alias(c) for c in ("rank", "low", "len")])
        upto = F.sum("c").over(Window.partitionBy("g", "which").orderBy("d").rowsBetween(Window.unboundedPreceding, 0))
        counted = counted.withColumn("upto", upto).filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
        state, last = written(counted.select("g", "which", "low", "len", (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"), F.col("d").alias("prefix")))
        passing.append(last)
    found = state.select("g", "which", (F.col("low") + F.col("prefix")).alias("v"))
    drop_written(spark, [path, *passing[:-1]])
    return found.groupBy(F.col("g").alias(key)).agg(*[F.max(F.when(F.col("which") == i, F.col("v"))).alias(c) for i, c in enumerate(values)])
