"""IO02, IO09 catalog mode, partition pruning, hot-key aggregates, summary, preview."""

from __future__ import annotations

import contextlib
import io
import json
import os
import tempfile

from pyspark.sql import functions as F

from rentyield.functions.predicates import city_is
from rentyield.operators.aggregates import area_measures, frequency
from rentyield.params import Paths
from rentyield.plans.profile import summary
from rentyield.plans.run import PART, Audit, city_part, run, run_bronze, target
from rentyield.sources.files import read_listings
from rentyield.sources.tables import load, preview, save


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_csv_infer_schema(spark):
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("zipcode,price,room_type\n1053,140,Private room\n,9000.5,Entire home/apt\n")
    text = read_listings(spark, os.path.join(d, "a.csv"))
    typed = read_listings(spark, os.path.join(d, "a.csv"), infer=True)
    assert dict(text.dtypes) == {"zipcode": "string", "price": "string", "room_type": "string"}
    assert dict(typed.dtypes)["price"] == "double" and dict(typed.dtypes)["zipcode"] == "int"
    assert preview(typed, 1).count() == 1


def test_catalog_mode_and_partition_pruning(spark):
    from test_layers import _write_raw
    d = tempfile.mkdtemp(prefix="rentyield-cat-", dir="/tmp")
    _write_raw(d)
    paths = Paths(raw=d, tables="", database="ry_test")
    audit = run(spark, paths)
    assert spark.catalog.databaseExists("ry_test")
    assert audit.counts["gold"]["rows"] == load(spark, target(paths, "gold")).count()
    bronze = load(spark, target(paths, "bronze_rentals"))
    p = _plan(bronze.filter(F.col(PART) == city_part(F.lit("Amsterdam"))).filter(city_is(F.col("city"))))
    assert f"PartitionFilters: [isnotnull({PART}" in p and f"({PART}" in p.split("PartitionFilters")[1].split("\n")[0]


def _hot_data(spark):
    # one key holds a third of all rows; decimals with a half-cent to round
    rows = [("hot", float(i % 997) + 0.005) for i in range(3000)]
    rows += [(f"k{i % 40}", float(i) / 8) for i in range(6000)]
    rows += [(None, 1.0), ("nulls", None)]
    return spark.createDataFrame(rows, "k string, x double").repartition(16)


def _measures(df, method="histogram"):
    rows = area_measures(df, "k", F.col("x").try_cast("decimal(18,2)"), F.col("x").try_cast("decimal(24,6)"), F.col("x"), method)
    return {r["k"]: tuple(r)[1:] for r in rows.collect()}


def test_hot_key_measures_match_exact(spark):
    df = _hot_data(spark)
    exact, got = _measures(df, "exact"), _measures(df)
    assert got == exact
    assert exact["hot"][0] == 3000 and exact["nulls"] == (0, None, None, None, None, None)


def test_large_area_is_exact_and_repeats(spark):
    """More rows in one area than any sketch holds: equal to percentile_disc, twice the same."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
                                    ((F.col("id") * 7919) % 40_009 / 100).alias("x")).repartition(16)
    first = _measures(df)
    assert first == _measures(df, "exact") and first == _measures(df.repartition(5))
    assert "kll_" not in _plan(area_measures(df, "k", F.col("x").cast("decimal(18,2)"), F.col("x").cast("decimal(24,6)"), F.col("x")))


def test_mean_is_rounded_once(spark):
    """A mean just below half a cent rounds to zero, not over an intermediate half cent."""
    df = spark.range(10_000).select(F.lit("a").alias("k"), F.when(F.col("id") == 0, 0.005996).otherwise(0.0049999).cast("decimal(24,6)").alias("x"))
    df = df.withColumn("x", F.when(F.col("x") == F.lit(0.005).cast("decimal(24,6)"), F.lit(0.004999).cast("decimal(24,6)")).otherwise(F.col("x")))
    row = area_measures(df, "k", F.lit(1).cast("decimal(18,2)"), F.col("x"), F.lit(None).cast("double")).first()
    assert row["avg_net"] == 0.0 and row["avg_price"] == 1.0 and row["avg_other"] is None


def test_bronze_rentals_reload_unchanged(spark):
    """Cities that are empty, missing, numeric-looking or odd come back as the same text."""
    d = tempfile.mkdtemp(prefix="rentyield-city-", dir="/tmp")
    cities = ["", None, "0123", "0007", "1e3", "Amsterdam", "AMSTERDAM", " Amsterdam", "a/b=c%", "2024-01-01", "__HIVE_DEFAULT_PARTITION__"]
    with open(os.path.join(d, "rentals.json"), "w") as f:
        for i, c in enumerate(cities):
            f.write(json.dumps({"_id": [str(i)], "city": c, "rent": "€ 500,-"}) + "\n")
    with open(os.path.join(d, "airbnb.csv"), "w") as f:
        f.write("zipcode,price\n1053,100\n")
    paths = Paths(raw=d, tables=f"{d}/t", rentals_multiline=False)
    run_bronze(spark, paths, Audit())
    back = load(spark, target(paths, "bronze_rentals"))
    assert dict(back.dtypes)["city"] == "string"
    assert {int(r["_id"]): r["city"] for r in back.collect()} == dict(enumerate(cities))


def test_top_zero_is_no_rows(spark):
    assert frequency(spark.range(5), "id", 0).count() == 0


def test_summary(spark):
    df = spark.createDataFrame([(str(v),) for v in [1, 2, 3, 4, 100]], "price string")
    s = {r["summary"]: r["price"] for r in summary(df, "price").collect()}
    assert s["count"] == "5" and s["min"] == "1.0" and s["max"] == "100.0" and s["50%"] == "3.0"


def test_save_overwrites_schema(spark):
    d = tempfile.mkdtemp(prefix="save-", dir="/tmp")
    t = os.path.join(d, "t")
    save(spark.createDataFrame([(1, "a")], "a int, b string"), t)
    save(spark.createDataFrame([(2.5,)], "c double"), t)
    assert load(spark, t).columns == ["c"]


def test_json_lines_rentals(spark):
    import json
    from rentyield.plans.bronze import bronze_rentals
    d = tempfile.mkdtemp(prefix="jsonl-", dir="/tmp")
    with open(os.path.join(d, "r.json"), "w") as f:
        f.write(json.dumps({"_id": ["a"], "city": "Amsterdam", "rent": "€ 500,-", "latitude": 52.37}) + "\n")
        f.write(json.dumps({"_id": [], "city": "Utrecht", "rent": 700}) + "\n")
    rows = bronze_rentals(spark, os.path.join(d, "r.json"), multiline=False).orderBy("city").collect()
    assert [(r["_id"], r["rent"], r["latitude"]) for r in rows] == [("a", "€ 500,-", "52.37"), (None, "700", None)]
    assert rows[0]["_source"] == "kamernet" and rows[0]["_source_file"] == "r.json"
