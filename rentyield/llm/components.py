"""Connected components of a link table, as Spark joins and aggregates.

Alternating large-star and small-star steps (map-reduce components): every step replaces links by
links to the smallest neighbour, keeps the components, and ends when nothing changes. Each step
aggregates with a map-side minimum before it shuffles; the joins that bring the minimum back to the
links leave a vertex with very many links to Spark's skew join. Steps are cut by reliable checkpoints; only the number of rows and a
checksum of a step reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentyield.llm.tables import durable


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component): the smallest vertex reachable, for every vertex that has a link.

    Self links and repeated links are allowed; a row with a null end is no link.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    edges = durable(edges)
    before = None
    while True:
        # large star: the larger neighbours of a vertex are linked to its smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = (both.join(least, F.col("u") == F.col("w")).filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: the smaller neighbours of a vertex, and itself, are linked to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        edges = durable(small.filter(F.col("u") != F.col("v")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # every link now leads from a vertex to the smallest of its component
    return (edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()))
