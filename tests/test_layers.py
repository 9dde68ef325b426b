"""Bronze → silver → gold on raw files in a scratch folder; semantics register cases."""

from __future__ import annotations

import csv
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rentyield.operators.aggregates import median2
from rentyield.operators.compare import compare, strategy_counts, top_areas
from rentyield.params import Paths
from rentyield.plans.run import run, target
from rentyield.plans.silver import LET_COLUMNS, backfill

# Published result rows: (pc4, price, rent, short-stay net, let net, advantage), euro per year, +-1.
GOLDEN = [
    ("1071", 140, 810, 32142, 8019, 24123),
    ("1016", 149, 1095, 34372, 10841, 23531),
    ("1181", 179, 2100, 41807, 20790, 21017),
    ("1012", 139, 1125, 31894, 11138, 20757),
    ("1015", 140, 1250, 32142, 12375, 19767),
]

LISTING_COLS = ["id", "zipcode", "price", "bedrooms", "accommodates", "latitude", "longitude",
                "review_scores_value", "room_type", "extra"]


def _rent_text(r: int) -> str:
    return f"€ {r // 1000}.{r % 1000:03d},-  Utilities incl." if r >= 1000 else f"€ {r},-"


def _write_raw(d: str) -> None:
    rows, rentals, n = [], [], 0
    for k, (pc4, price, rent, *_rest) in enumerate(GOLDEN):
        for j, fmt in enumerate([pc4, f"{pc4} AM", f"{pc4}HE"]):
            n += 1
            rows.append([n, fmt, str(price), "1", "2", "52.3", "4.9", "9", "Entire home/apt ", "x"])
        for j in range(2):
            rentals.append({"_id": [f"{pc4}-{j}"], "crawledAt": ["2019-07-14T12:00:00Z"],
                            "firstSeenAt": ["2019-07-01T00:00:00Z"], "lastSeenAt": ["2019-07-30T00:00:00Z"],
                            "detailsCrawledAt": [], "city": "Amsterdam" if j else "AMSTERDAM",
                            "rent": _rent_text(rent), "postalCode": f"{pc4}AB", "areaSqm": "14 m2",
                            "matchCapacity": "1 person", "deposit": "\n  € 500\n", "latitude": 52.37,
                            "longitude": "4.89", "propertyType": "Room", "furnish": "Furnished"})
    # missing code, inside the 1071 zone polygon → backfilled
    rows.append([100, "", "140", "", "2", "0.5", "0.5", "", "Private room", "y"])
    # missing code, outside every zone → stays NULL
    rows.append([101, "", "140", "", "2", "9.5", "9.5", "", "Private room", "y"])
    # price outlier, no price, no position
    rows.append([102, "1071", "9000", "1", "2", "52.3", "4.9", "9", "Private room", "y"])
    rows.append([103, "1071", "", "1", "2", "52.3", "4.9", "9", "Private room", "y"])
    rows.append([104, "1071", "150", "1", "2", "", "", "9", "Private room", "y"])
    rentals.append({"_id": ["u"], "city": "Utrecht", "rent": "€ 700,-", "postalCode": "3511AB"})
    rentals.append({"_id": ["p"], "city": "Amsterdam", "rent": "Prijs op aanvraag", "postalCode": "1071AB"})
    with open(os.path.join(d, "airbnb.csv"), "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(LISTING_COLS)
        w.writerows(rows)
    with open(os.path.join(d, "rentals.json"), "w") as f:
        json.dump(rentals, f, indent=2)
    os.makedirs(os.path.join(d, "geo"))
    zone = {"type": "Feature", "properties": {"gid": 7, "PC4": 1071},
            "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}}
    with open(os.path.join(d, "geo", "post_codes.geojson"), "w") as f:
        json.dump({"type": "FeatureCollection", "features": [zone]}, f)


@pytest.fixture(scope="module")
def pipeline(spark):
    d = tempfile.mkdtemp(prefix="rentyield-raw-", dir="/tmp")
    _write_raw(d)
    paths = Paths(raw=d, tables=os.path.join(d, "tables"))
    audit = run(spark, paths)
    return spark, paths, audit


def test_golden_rows(pipeline):
    spark, paths, _ = pipeline
    g = {r["pc4"]: r for r in spark.read.parquet(target(paths, "gold")).collect()}
    for pc4, _p, _r, stay_net, let_net, adv in GOLDEN:
        row = g[pc4]
        assert abs(row["airbnb_median_annual_net_revenue"] - stay_net) <= 1
        assert abs(row["kamernet_median_annual_net_revenue"] - let_net) <= 1
        assert abs(row["revenue_advantage"] - adv) <= 1
        assert row["recommended_strategy"] == "Airbnb"


def test_layer_schemas(pipeline):
    spark, paths, _ = pipeline
    silver_l = spark.read.parquet(target(paths, "silver_rentals"))
    assert silver_l.columns == LET_COLUMNS
    silver_s = spark.read.parquet(target(paths, "silver_listings"))
    assert silver_s.columns[-3:] == ["pc4", "is_price_outlier", "pc4_backfilled"]
    assert dict(silver_s.dtypes)["price"] == "double" and dict(silver_s.dtypes)["accommodates"] == "int"
    bronze_r = spark.read.parquet(target(paths, "bronze_rentals"))
    assert dict(bronze_r.dtypes)["_id"] == "string" and dict(bronze_r.dtypes)["detailsCrawledAt"] == "string"
    assert {"_source", "_ingested_at", "_source_file"} <= set(bronze_r.columns)
    gold = spark.read.parquet(target(paths, "gold"))
    assert len(gold.columns) == 15


def test_backfill_flag_and_audit(pipeline):
    spark, paths, audit = pipeline
    s = spark.read.parquet(target(paths, "silver_listings"))
    rec = {r["id"]: r for r in s.collect()}
    assert rec["100"]["pc4"] == "1071" and rec["100"]["pc4_backfilled"] is True      # D01: true when recovered
    assert rec["101"]["pc4"] is None and rec["101"]["pc4_backfilled"] is False
    assert rec["1"]["pc4_backfilled"] is False
    assert "103" not in rec and "104" not in rec                                       # no price / no position
    assert rec["102"]["is_price_outlier"] is True
    c = audit.counts
    assert c["silver_listings"] == {"rows": 18, "missing_pc4": 1, "backfilled": 1, "price_outliers": 1}
    assert c["bronze_listings"]["rows"] == 20 and c["bronze_rentals"]["rows"] == 12
    assert c["silver_rentals"]["rows"] == 10
    # zipcode '' is not counted (missing, not malformed); rentals: 'Prijs op aanvraag' fails to parse
    assert c["silver_listings_rejects"] == {"rejects_pc4": 0, "rows": 20}
    assert c["silver_rentals_rejects"]["rejects_rent_amount"] == 1
    assert c["silver_rentals_rejects"]["rows"] == 11


def test_replay_from_silver_is_idempotent(pipeline):
    spark, paths, _ = pipeline
    before = sorted(repr(tuple(r)) for r in spark.read.parquet(target(paths, "gold")).collect())
    audit = run(spark, paths, start="gold")
    after = sorted(repr(tuple(r)) for r in spark.read.parquet(target(paths, "gold")).collect())
    assert before == after and set(audit.counts) == {"gold"}
    run(spark, paths, start="silver")
    again = sorted(repr(tuple(r)) for r in spark.read.parquet(target(paths, "gold")).collect())
    assert again == before


def test_strategy_cases(spark):
    s = spark.createDataFrame([("a", 100.0), ("b", 40.0), ("c", 50.0), ("e", 50.0), (None, 1.0)],
                              "pc4 string, airbnb_median_annual_net_revenue double")
    k = spark.createDataFrame([("a", 40.0), ("b", 100.0), ("c", 50.0), ("d", 50.0), (None, 2.0)],
                              "pc4 string, kamernet_median_annual_net_revenue double")
    out = compare(s, k).collect()
    got = {r["pc4"]: (r["revenue_advantage"], r["recommended_strategy"]) for r in out if r["pc4"] is not None}
    assert got == {"a": (60.0, "Airbnb"), "b": (-60.0, "Kamernet"), "c": (0.0, "Kamernet"),
                   "d": (None, "Kamernet (no Airbnb data)"), "e": (None, "Airbnb (no Kamernet data)")}
    assert sum(r["pc4"] is None for r in out) == 2                                        # D19
    assert compare(s, k, drop_null_key=True).filter(F.col("pc4").isNull()).count() == 0
    counts = {r["recommended_strategy"]: r["count"] for r in strategy_counts(compare(s, k)).collect()}
    assert counts == {"Airbnb": 1, "Kamernet": 2, "Kamernet (no Airbnb data)": 2, "Airbnb (no Kamernet data)": 2}


def test_top_areas_tie_break(spark):
    g = spark.createDataFrame(
        [(f"{1000 + i}", 1, 1, 1.0, 1.0, float(i // 3), "Airbnb") for i in range(15)] + [("9999", 1, 1, 1.0, None, None, "x")],
        "pc4 string, airbnb_listing_count int, kamernet_listing_count int, airbnb_median_annual_net_revenue double, "
        "kamernet_median_annual_net_revenue double, revenue_advantage double, recommended_strategy string")
    top = [r["pc4"] for r in top_areas(g, 4).collect()]
    assert top == ["1012", "1013", "1014", "1009"]


@pytest.mark.parametrize("values,expected", [([1, 2], 1.0), ([1, 2, 3, 4], 2.0), ([1, 2, 3], 2.0), ([5], 5.0)])
@pytest.mark.parametrize("exact", [False, True])
def test_lower_median(spark, values, expected, exact):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    assert df.agg(median2("x", exact=exact).alias("m")).first()["m"] == expected


def test_no_zone_file_means_flag_false(spark):
    df = spark.createDataFrame([("1053", 1.0, 1.0), (None, 1.0, 1.0)], "pc4 string, latitude double, longitude double")
    out = backfill(df, None).collect()
    assert [r["pc4_backfilled"] for r in out] == [False, False]


def test_command_line(spark, capsys):
    from rentyield.__main__ import main
    d = tempfile.mkdtemp(prefix="rentyield-cli-", dir="/tmp")
    _write_raw(d)
    out = main(["--raw", d, "--tables", os.path.join(d, "t"), "--top", "3", "--occupancy-rate", "0.80"])
    assert [r["pc4"] for r in out["top_areas"]] == ["1071", "1016", "1181"]
    # 365 x 0.80 = 292 nights: 140 x 292 x 0.97 - 292 / 3 x 30 = 39653.6 - 2920 = 36733.6
    assert out["top_areas"][0]["airbnb_median_annual_net_revenue"] == 36733.6
    assert sum(r["count"] for r in out["strategy_counts"]) == out["audit"]["gold"]["rows"]
    assert '"audit"' in capsys.readouterr().out


def test_gold_reads_silver_with_pushdown(pipeline):
    import contextlib
    import io
    from rentyield.plans.gold import gold
    spark, paths, _ = pipeline
    g = gold(spark.read.parquet(target(paths, "silver_listings")), spark.read.parquet(target(paths, "silver_rentals")))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        g.explain(mode="formatted")
    p = buf.getvalue()
    assert "PushedFilters: [IsNotNull(is_price_outlier), Not(EqualTo(is_price_outlier,true))]" in p
    assert "PushedFilters: [IsNotNull(is_rent_outlier), Not(EqualTo(is_rent_outlier,true))]" in p
    assert "ReadSchema: struct<price:double,review_scores_value:double,pc4:string,is_price_outlier:boolean>" in p
    assert "room_type" not in p and "_ingested_at" not in p


def test_command_line_profile(spark, capsys):
    from rentyield.__main__ import main
    d = tempfile.mkdtemp(prefix="rentyield-prof-", dir="/tmp")
    _write_raw(d)
    out = main(["--raw", d, "--profile"])
    assert out["listings_shape"] == [{"rows": 20, "cols": 10}]
    missing = {r["column"]: r["missing"] for r in out["missing"]}
    assert missing == {"zipcode": 2, "bedrooms": 2, "review_scores_value": 2}
    formats = {r["format"]: r["matching"] for r in out["postal_formats"]}
    assert formats == {"four_digits": 8, "six_chars_no_space": 5, "with_space": 5}
    assert out["price"][0]["above_bound"] == 1
    assert [r["summary"] for r in out["price_summary"]] == ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
    assert {r["city"]: r["count"] for r in out["cities"]} == {"Amsterdam": 6, "AMSTERDAM": 5, "Utrecht": 1}
    issues = {r["issue"]: r["count"] for r in out["issues"]}
    assert issues["other_city_records"] == 1 and issues["utilities_included"] == 8   # 4 rents >= 1000, 2 rentals each
    assert not os.path.exists(os.path.join(d, "tables"))             # profiling writes nothing
    assert '"issues"' in capsys.readouterr().out
