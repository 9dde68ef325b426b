"""IO14: the audit table, its fingerprints and the account of every bronze row."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rentyield.plans import file_views
from rentyield.plans.run import audit_rows, fingerprint, reconcile, run, target, verify
from rentyield.sources.tables import load, save


def test_fingerprint_is_of_the_rows_in_any_order(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "c")], "i int, t string")

    def value(x):
        return x.agg(fingerprint(x)).first()[0]

    assert value(df) == value(df.orderBy(F.desc("i")).repartition(3).select("t", "i"))
    assert value(df) != value(df.distinct()) and value(df) != value(df.withColumn("i", F.col("i") + 1))
    assert value(df.filter("false")) == 0


def test_verify_finds_a_changed_table_and_reconcile_a_lost_row(spark):
    paths = file_views.raw_files(spark, SF_SMALL)
    run(spark, paths)
    assert all(r["same"] for r in verify(spark, paths).collect())
    assert all(r["balanced"] for r in reconcile(spark, paths).collect())
    before = {(r["step"], r["metric"]): r["value"] for r in audit_rows(spark, paths).collect()}
    run(spark, paths, start="gold")                         # keeps the rows of the earlier layers
    after = {(r["step"], r["metric"]): r["value"] for r in audit_rows(spark, paths).collect()}
    assert after == before
    silver = load(spark, target(paths, "silver_listings"))
    one = silver.limit(1).checkpoint()
    save(silver.exceptAll(one).unionByName(one.withColumn("price", F.col("price") + 1)).checkpoint(), target(paths, "silver_listings"))
    got = {r["step"]: (r["rows_written"] == r["rows_read"], r["same"]) for r in verify(spark, paths).collect()}
    assert got["silver_listings"] == (True, False) and got["silver_rentals"] == (True, True)
    save(load(spark, target(paths, "silver_listings")).exceptAll(load(spark, target(paths, "silver_listings")).limit(1)).checkpoint(), target(paths, "silver_listings"))
    assert {r["source"]: r["balanced"] for r in reconcile(spark, paths).collect()} == {"listings": False, "rentals": True}
    run(spark, paths, start="silver")                       # a replay mends them
    assert all(r["same"] for r in verify(spark, paths).collect()) and all(r["balanced"] for r in reconcile(spark, paths).collect())
