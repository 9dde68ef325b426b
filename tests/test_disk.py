"""What a run holds on disk: packed raw files, no shuffle file of an earlier layer, no table that only a step needed."""

from __future__ import annotations

import contextlib
import dataclasses
import functools
import io
import math
import os
import tempfile
import time
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rentyield.operators import quadtree
from rentyield.operators.spatial import prepare
from rentyield.plans import file_views, refresh as refreshing, run as running
from rentyield.sources import demo
from rentyield.sources.tables import load, passing, written


def data_files(folder: str) -> list[str]:
    return [f for _, _, names in os.walk(folder) for f in names if f.startswith("part-")]


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def there(path: str) -> bool:
    return os.path.isdir(path.removeprefix("file:"))


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_raw_files_are_packed_and_whole(spark):
    paths = file_views.raw_files(spark, SF_SMALL)
    later = file_views.changed_drop(spark, paths, F.lower("city") == "utrecht")
    for name in (paths.listings_file, paths.rentals_file, later.rentals_file):
        files = data_files(f"{paths.raw}/{name}")
        assert files and all(f.endswith(".gz") for f in files)
    assert file_views.file_listings(spark, SF_SMALL).count() == demo.stays(spark, SF_SMALL).count()
    assert file_views.file_rentals(spark, SF_SMALL).count() == demo.lets(spark, SF_SMALL).count() == spark.read.json(f"{later.raw}/{later.rentals_file}").count()


def test_a_run_lets_go_of_each_step(spark, monkeypatch):
    paths = dataclasses.replace(file_views.raw_files(spark, SF_SMALL), tables=tempfile.mkdtemp(prefix="rentyield-disk-", dir="/tmp"))
    monkeypatch.setattr(running, "silver_stays", functools.partial(running.silver_stays, broadcast_limit=0))
    files, tables, held, save = shuffle_files(spark), [], {}, running.save

    def writing(df):
        table, path = written(df)
        tables.append(path)
        return table, path

    def saving(df, target, partition_by=None):
        held[os.path.basename(target)] = sum(there(t) for t in tables)
        save(df, target, partition_by)

    monkeypatch.setattr(quadtree, "written", writing)
    monkeypatch.setattr(running, "save", saving)
    running.run(spark, paths)
    until = time.time() + 20            # the cleaner works beside the run
    while shuffle_files(spark) - files and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - files
    # the zones as a quadtree and the positions found are there for the one write, and gone after it
    assert held["silver_listings"] >= 2 and held["silver_rentals"] == held["gold_area_revenue"] == 0
    assert tables and not any(there(t) for t in tables)


def test_tables_of_a_step_go_when_it_fails(spark):
    path = None
    with contextlib.suppress(ZeroDivisionError), passing(spark):
        table, path = written(spark.range(3).toDF("a"))
        assert table.count() == 3 and there(path)
        raise ZeroDivisionError
    assert not there(path)
    assert there(written(spark.range(1).toDF("a"))[1])


def test_lookup_in_steps_keeps_every_row(spark):
    ring = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
    far = [[x + 10.0, y] for x, y in ring]
    zones = spark.createDataFrame([(1, "a", [ring]), (2, "b", [far])], "fid long, code string, rings array<array<array<double>>>")
    index = quadtree.build_zones(prepare(zones).edges)
    at = [(1.0, 1.0), (1.0, 1.0), (11.0, 3.0), (-0.0, 1.0), (50.0, 50.0), (math.nan, 1.0), (None, 1.0), (1.0, None), (None, None), (2.0, 3.0)]
    rows = [(x, y, i % 2 == 0 if i < 9 else None, f"t{i // 2}") for i, (x, y) in enumerate(at)] * 2
    points = spark.createDataFrame(rows, "lon double, lat double, wanted boolean, `some text` string")

    def result(**options) -> Counter:
        found = quadtree.lookup(points, index, "lon", "lat", "code", **options)
        assert found.columns == [*points.columns, "code"]
        return Counter(str(tuple(r)) for r in found.collect())

    for where in (None, F.col("wanted")):
        with passing(spark):
            assert result(where=where, in_steps=True) == result(where=where)
    with passing(spark):
        plan = plan_of(quadtree.lookup(points, index, "lon", "lat", "code", F.col("wanted"), in_steps=True))
    # one shuffle for the rows that look something up, one for what was found; the other rows have none
    assert plan.count(") Exchange") == 2 and "Union" in plan


def test_changed_parts_are_picked_without_a_shuffle_of_all(spark, monkeypatch):
    paths = dataclasses.replace(file_views.raw_files(spark, SF_SMALL), tables=tempfile.mkdtemp(prefix="rentyield-disk-", dir="/tmp"))
    refreshing.refresh(spark, paths)
    city = load(spark, running.target(paths, "bronze_rentals")).filter("lower(city) <> 'amsterdam'").select("city").first()[0]
    plans, write = [], refreshing._overwrite_parts
    monkeypatch.setattr(refreshing, "_overwrite_parts", lambda df, *rest: (plans.append(plan_of(df)), write(df, *rest)))
    refreshing.refresh(spark, file_views.changed_drop(spark, paths, F.col("city") == city))
    assert len(plans) == 1 and "BroadcastHashJoin LeftSemi" in plans[0] and "SortMergeJoin" not in plans[0]
