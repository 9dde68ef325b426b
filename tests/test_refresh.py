"""IO13: a refresh writes what changed, and its tables equal those of a whole run."""

from __future__ import annotations

import dataclasses
import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rentyield.params import Assumptions, Bounds
from rentyield.plans import file_views
from rentyield.plans.refresh import refresh
from rentyield.plans.run import LAYER_TABLES, run, target, verify
from rentyield.sources.tables import load


def report(spark, paths, **options):
    return {r["step"]: (r["partitions_written"], r["partitions_kept"]) for r in refresh(spark, paths, **options).collect()}


def files(folder: str) -> dict:
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


def assert_equals_run(spark, paths, **options):
    other = dataclasses.replace(paths, tables=tempfile.mkdtemp(prefix="rentyield-whole-", dir="/tmp"), database=None)
    run(spark, other, **options)
    for step in LAYER_TABLES:
        a, b = (load(spark, target(p, step)).drop("_ingested_at", "_source_file") for p in (paths, other))
        cols = sorted(a.columns)
        assert cols == sorted(b.columns)
        assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0 and b.select(*cols).exceptAll(a.select(*cols)).count() == 0
    assert all(r["same"] for r in verify(spark, paths).collect())


@pytest.mark.parametrize("database", [None, "refreshed"])
def test_only_changed_parts_are_written(spark, database):
    first = file_views.raw_files(spark, SF_SMALL)
    folder = tempfile.mkdtemp(prefix="rentyield-refresh-", dir="/tmp")
    paths = dataclasses.replace(first, tables=folder, database=database)
    got = report(spark, paths)
    n = got["bronze_rentals"][0]
    assert n >= 3 and all(kept == 0 for _, kept in got.values())
    before = files(folder)
    nothing = {step: (0, n if step == "bronze_rentals" else 1) for step in LAYER_TABLES}
    assert report(spark, paths) == nothing
    assert files(folder) == before                                         # not a file was touched
    # one city other than the one compared: one partition, no later layer
    city = load(spark, target(paths, "bronze_rentals")).filter("lower(city) <> 'amsterdam'").select("city").first()[0]
    changed = file_views.changed_drop(spark, paths, F.col("city") == city)
    assert report(spark, changed) == nothing | {"bronze_rentals": (1, n - 1)}
    if database is None:
        moved = {f for f, t in files(folder).items() if "bronze_rentals" in f and before.get(f) != t}
        assert len({os.path.dirname(f) for f in moved}) == 1
        assert_equals_run(spark, changed)
    # the city compared: its partition, its silver table and gold
    own = file_views.changed_drop(spark, paths, F.lower("city") == "amsterdam")
    two = report(spark, own)
    assert two["bronze_rentals"] == (2, n - 2) and two["silver_rentals"] == two["gold"] == (1, 0) and two["silver_listings"] == (0, 1)
    assert report(spark, own) == nothing


def test_parameters_gone_cities_and_listings(spark):
    first = file_views.raw_files(spark, SF_SMALL)
    folder = tempfile.mkdtemp(prefix="rentyield-refresh-", dir="/tmp")
    paths = dataclasses.replace(first, tables=folder)
    n = report(spark, paths)["bronze_rentals"][0]
    other = {"a": Assumptions(occupancy_rate="0.55")}
    nothing = {step: (0, n if step == "bronze_rentals" else 1) for step in LAYER_TABLES}
    assert report(spark, paths, **other) == nothing | {"gold": (1, 0)}
    got = report(spark, paths, bounds=Bounds(price_hi=500.0), **other)
    assert got == nothing | {"silver_listings": (1, 0), "silver_rentals": (1, 0), "gold": (1, 0)}
    assert report(spark, paths, bounds=Bounds(price_hi=500.0), **other) == nothing
    # a city that went takes its partition along
    city = load(spark, target(paths, "bronze_rentals")).filter("lower(city) <> 'amsterdam'").select("city").first()[0]
    fewer = file_views.changed_drop(spark, paths, F.col("city") == city, drop=True)
    assert report(spark, fewer)["bronze_rentals"][1] == 0
    assert load(spark, target(fewer, "bronze_rentals")).filter(F.col("city") == city).count() == 0
    assert_equals_run(spark, fewer)
