"""JO02 on the quadtree of edges: against a plain crossing count, hot cells, zones of very many edges, plan shape."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentyield.operators import quadtree
from rentyield.operators.rings import zone_edges
from rentyield.operators.spatial import prepare, spatial_join
from rentyield.sources.geojson import zones_from_features
from rentyield.sources.tables import spread
from test_plans import plan_of

ZONE = "fid bigint, code string, rings array<array<array<double>>>"


def _star(cx, cy, inner, outer, spikes, turn=0.0):
    ring = [[cx + (outer if k % 2 else inner) * math.cos(turn + math.pi * k / spikes), cy + (outer if k % 2 else inner) * math.sin(turn + math.pi * k / spikes)]
            for k in range(2 * spikes)]
    return ring + [ring[0]]


def _square(x, y, s):
    return [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]


ROWS = [(0, "star", [_star(3.1, 2.2, 1.0, 3.0, 40)]), (1, "holed", [_square(0.0, 0.0, 8.0), _square(2.0, 2.0, 4.0)]),
        (2, "far", [_star(900.0, -700.0, 30, 90, 7, 0.3), _star(1000.0, -500.0, 3, 9, 25)]), (3, "wide", [_square(-5000.0, -5000.0, 6000.0)]),
        (4, "open", [_star(3.0, 3.0, 0.01, 0.02, 9)[:-1]]), (5, "broken", [[[0.0, 0.0], [1.0], [1.0, 1.0]]])]


def _plain(x, y):
    """First zone by crossing count; on an edge: no zone."""
    for fid, code, rings in ROWS[:5]:
        odd, on = False, False
        for ring in rings:
            closed = ring if ring[0] == ring[-1] else ring + [ring[0]]
            for (x1, y1), (x2, y2) in zip(closed, closed[1:]):
                if (y1, x1) > (y2, x2):
                    x1, y1, x2, y2 = x2, y2, x1, y1
                if y1 <= y <= y2 and min(x1, x2) <= x <= max(x1, x2) and (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1):
                    on = True
                if y1 <= y < y2 and x1 + (y - y1) * ((x2 - x1) / (y2 - y1)) > x:
                    odd = not odd
        if odd and not on:
            return code
    return None


@pytest.mark.parametrize("max_edges", [2, 12, 256])
def test_points_equal_a_plain_crossing_count(spark, max_edges):
    rng = random.Random(max_edges)
    pts = [(rng.uniform(-1, 9), rng.uniform(-1, 9)) for _ in range(1500)] + [(rng.uniform(800, 1020), rng.uniform(-800, -480)) for _ in range(700)]
    pts += [(rng.randint(-4, 36) / 4, rng.randint(-4, 36) / 4) for _ in range(500)]                      # on edges, vertices and cell borders
    pts += [(rng.uniform(-6000, 1100), rng.uniform(-6000, 1100)) for _ in range(200)] + [(-5000.0, -5000.0), (1000.0, 1000.0), (3.0, 3.0)]
    index = quadtree.build(quadtree.edges_of_zones(spark.createDataFrame(ROWS, ZONE)), max_edges)
    assert index.widest <= max(max_edges, 18)           # 18 edges of the small star fit no smaller cell for the coordinates' size
    assert (len(index.depths) > 3) or max_edges == 256
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "i int, x double, y double").repartition(5)
    got = {r["i"]: r["zone_code"] for r in quadtree.lookup(df, index, "x", "y", rows_per_task=100).collect()}
    assert len(got) == len(pts)
    assert [got[i] for i in range(len(pts))] == [_plain(*p) for p in pts]
    assert {"star", "holed", "far", "wide"} <= set(got.values())


def test_cell_numbers_are_hierarchical(spark):
    rng = random.Random(1)
    cells = [(rng.randrange(4 ** 15), rng.randrange(4 ** 15)) for _ in range(200)] + [(0, 0), (4 ** 15 - 1, 4 ** 15 - 1)]
    df = spark.createDataFrame(cells, "cx long, cy long")
    own = quadtree.cell_number(F.col("cx"), F.col("cy"), F.lit(15))
    parent = quadtree.cell_number(F.shiftright("cx", 2), F.shiftright("cy", 2), F.lit(14))
    rows = df.select(own.alias("own"), F.shiftright(own, 4).alias("up"), parent.alias("parent")).collect()
    assert all(r["up"] == r["parent"] for r in rows) and len({r["own"] for r in rows}) == len(set(cells))


def test_zone_of_very_many_edges_has_no_wide_row(spark):
    """A wavy ring of 120,000 edges, given by positions: no row of more than 256 edges, results by its radius."""
    n = 120_000
    angle = F.col("id") * (2 * math.pi / n)
    radius = 100 + F.sin(angle * 50) * 20
    positions = spark.range(n).select(F.lit(7).alias("fid"), F.lit("1007").alias("code"), F.lit(0).alias("ring"), F.col("id").alias("pos"),
                                      (radius * F.cos(angle)).alias("x"), (radius * F.sin(angle)).alias("y")).repartition(6)
    index = quadtree.build(quadtree.edges_of_positions(positions))
    assert index.widest <= 256
    widest = index.pairs.agg(F.max(F.length(F.to_json("edges")))).first()[0]
    assert widest < 1 << 20
    rng = np.random.default_rng(4)
    a, r = rng.uniform(0, 2 * math.pi, 4000), rng.uniform(60, 140, 4000)
    limit = 100 + np.sin(a * 50) * 20
    clear = np.abs(r - limit) > 0.01
    pts = [(float(x), float(y), bool(i)) for x, y, i in zip((r * np.cos(a))[clear], (r * np.sin(a))[clear], (r < limit)[clear])]
    got = quadtree.lookup(spark.createDataFrame(pts, "x double, y double, inside boolean"), index, "x", "y").collect()
    assert len(got) == len(pts) and all((g["zone_code"] == "1007") == g["inside"] for g in got)


def test_positions_with_faults_drop_the_zone_whole(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    rows = [(1, "a", 0, i, x, y) for i, (x, y) in enumerate(square)]                                  # open ring
    rows += [(2, "b", 0, i, x + 10, None if i == 2 else y) for i, (x, y) in enumerate(square)]
    rows += [(3, "c", 0, i, x + 20, y) for i, (x, y) in enumerate(square)] + [(3, "c", 1, 0, 20.5, 0.5), (3, "c", 1, 1, 20.6, 0.6)]
    edges = quadtree.edges_of_positions(spark.createDataFrame(rows, "fid int, code string, ring int, pos int, x double, y double"))
    assert {r["fid"] for r in edges.collect()} == {1} and edges.count() == 4
    index = quadtree.build(edges)
    pts = spark.createDataFrame([(1.0, 1.0), (11.0, 1.0), (21.0, 1.0)], "x double, y double")
    assert [r["zone_code"] for r in quadtree.lookup(pts, index, "x", "y").orderBy("x").collect()] == ["a", None, None]


def test_hot_cells_are_salted_and_every_row_is_kept(spark):
    zones = spark.createDataFrame([(0, "1001", [_square(0.0, 0.0, 4.0)])], ZONE)
    hot = [(i, 1.5, 1.5, {"k": 1}) for i in range(300)]                                                # one position, a third of all rows
    near = [(300 + i, 1 + i / 1000, 1 + i / 977, None) for i in range(400)]                            # one cell, many positions
    rest = [(700 + i, None, 1.0, None) for i in range(100)] + [(800, float("nan"), 1.0, None), (801, 1e300, 1.0, None), (802, 1.0, 1.0, None), (802, 1.0, 1.0, None)]
    pts = spark.createDataFrame(hot + near + rest, "i int, x double, y double, code map<string,int>").repartition(4)
    index = quadtree.build(quadtree.edges_of_zones(zones))
    out = quadtree.lookup(pts, index, "x", "y", "zone", rows_per_task=50)
    assert out.columns == pts.columns + ["zone"]
    rows = out.collect()
    assert len(rows) == len(hot + near + rest)
    assert all((r["zone"] == "1001") == (r["i"] < 700 or r["i"] == 802) for r in rows)
    assert "rand(" not in plan_of(out)
    # the same through the join that picks the way by the index's size
    same = spatial_join(pts, zones, "x", "y", "zone", broadcast_limit=0, rows_per_task=50).collect()
    assert sorted((r["i"], r["zone"] or "") for r in same) == sorted((r["i"], r["zone"] or "") for r in rows)


def test_one_exchange_of_the_points_whatever_the_number_of_levels(spark):
    index = quadtree.build(quadtree.edges_of_zones(spark.createDataFrame(ROWS, ZONE)), 2)
    assert len(index.depths) >= 4
    pts = spark.createDataFrame([(1.0, 1.0, "p")], "x double, y double, payload string").repartition(2).checkpoint()
    plan = plan_of(quadtree.lookup(pts, index, "x", "y"))
    blocks = [b for b in plan.split("\n\n") if ") Exchange" in b and "payload" in b]
    assert len(blocks) == 1, plan


def test_no_zones(spark):
    none = quadtree.build(quadtree.edges_of_zones(spark.createDataFrame([], ZONE)))
    pts = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    assert [r["zone_code"] for r in quadtree.lookup(pts, none, "x", "y").collect()] == [None]


@pytest.mark.parametrize("max_edges,limit", [(256, 0), (256, 1 << 20), (12, 1500), (2, 1 << 20)])
def test_zones_of_few_edges_need_no_edge_rows(spark, max_edges, limit):
    """The tree made where the zones' rows are, with levels broadcast or not, finds what a plain crossing count finds."""
    rng = random.Random(limit)
    pts = [(rng.uniform(-1, 9), rng.uniform(-1, 9)) for _ in range(600)] + [(rng.uniform(800, 1020), rng.uniform(-800, -480)) for _ in range(300)]
    pts += [(rng.randint(-4, 36) / 4, rng.randint(-4, 36) / 4) for _ in range(300)] + [(-5000.0, -5000.0), (1000.0, 1000.0), (3.0, 3.0)]
    index = quadtree.build_zones(zone_edges(spark.createDataFrame(ROWS, ZONE)), max_edges)
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "i int, x double, y double").repartition(3)
    got = {r["i"]: r["zone_code"] for r in quadtree.lookup(df, index, "x", "y", rows_per_task=100, broadcast_limit=limit).collect()}
    assert [got[i] for i in range(len(pts))] == [_plain(*p) for p in pts]


def test_small_levels_are_broadcast_and_the_tree_is_built_once(spark):
    index = prepare(spark.createDataFrame(ROWS, ZONE))
    assert index.quad is index.quad
    pts = spark.createDataFrame([(1.0, 1.0)], "x double, y double")
    found = quadtree.positions_found(pts.selectExpr("x AS _px", "y AS _py"), index.quad, 100, 100, broadcast_limit=1 << 20)
    assert "SortMergeJoin" not in plan_of(found) and "BroadcastHashJoin" in plan_of(found)
    shuffled = quadtree.positions_found(pts.selectExpr("x AS _px", "y AS _py"), index.quad, 100, 100)
    assert [r["code"] for r in found.collect()] == [r["code"] for r in shuffled.collect()] != []


def test_a_filter_on_the_position_does_not_repeat_its_parsing(spark):
    """Coordinates parsed from text: the rows that look up are parsed by a bounded number of casts, not once per comparison."""
    seen = []
    zones = quadtree.build_zones(zone_edges(spark.createDataFrame(ROWS, ZONE)))
    pts = spark.createDataFrame([("1.0", "1.0")], "x string, y string").selectExpr("try_cast(x AS double) AS x", "try_cast(y AS double) AS y")
    plain = quadtree.positions_found
    try:
        quadtree.positions_found = lambda positions, *a: (seen.append(positions), plain(positions, *a))[1]
        quadtree.lookup(pts, zones, "x", "y").collect()
    finally:
        quadtree.positions_found = plain
    kept = seen[0].filter("_px >= 0 AND _px < 5 AND NOT isnan(_px) AND _py >= 0 AND _py < 5 AND NOT isnan(_py)")
    plan = plan_of(kept)
    assert plan.count("cast(x#") <= 6, plan


def test_rows_of_one_fid_are_one_zone(spark):
    """Two rows with the same fid have their edges together, whichever way the tree is made: where both hold a point, none does."""
    rows = ROWS[:2] + [ROWS[1], (3, "wide", [_square(-50.0, -50.0, 60.0)]), (None, "none", [_square(-50.0, -50.0, 60.0)])]
    zones = spark.createDataFrame(rows, ZONE)
    df = spark.createDataFrame([(7.5, 0.5), (4.0, 4.0), (-3.0, 2.0), (30.0, 3.0)], "x double, y double")
    got = [[r["zone_code"] for r in quadtree.lookup(df, index, "x", "y").orderBy("x").collect()]
           for index in (quadtree.build(quadtree.edges_of_zones(zones)), quadtree.build_zones(zone_edges(zones)))]
    assert got[0] == got[1] and got[1][0] == "wide" and got[1][2] == "wide" and got[1][3] is None


def test_zone_checks_do_not_parse_the_rings_again(spark):
    """IO06 checks run above the parsing, in the tasks the features were dealt to, not below in the one that reads them."""
    text = spark.createDataFrame([(0, "1001", "[[[0,0],[1,0],[1,1]]]"), (1, "1002", '[[["x",0],[1,0],[1,1]]]')], "fid bigint, code string, c string")
    features = spread(text, 16, parallel_filters=True).selectExpr("fid", "map('pc4', code) AS properties", "named_struct('type', 'Polygon', 'coordinates', c) AS geometry")
    zones = zone_edges(zones_from_features(features))
    filters = [b for b in plan_of(zones).split("\n\n") if ") Filter" in b.split("\n")[0]]
    assert filters and not any("from_json" in b for b in filters)
    assert [r["code"] for r in zones.collect()] == ["1001"]


def test_small_zones_are_split_where_their_row_is(spark, monkeypatch):
    """The same pairs as by edge rows, which zones of few edges do not go through; rows of one fid with two codes do."""
    zones = [(1, "holed", [_square(0.0, 0.0, 8.0), _square(2.0, 2.0, 4.0)]), (2, "wide", [_square(-9.0, -9.0, 14.0)])]
    edges = quadtree.edges_of_zones(spark.createDataFrame(zones, ZONE)).coalesce(1)
    columns = ["cell", "depth", "fid", "code", "minx", "maxx", "miny", "maxy", "xr", "yr", "par"]

    def held(index):
        return {(*(r[c] for c in columns), tuple(sorted((e.x1, e.y1, e.x2, e.y2) for e in r["edges"]))) for r in index.pairs.collect()}

    by_rows = held(quadtree.build(edges, 3, in_row=0))
    assert len({r[1] for r in by_rows}) > 1
    gone = []
    split = quadtree._split
    monkeypatch.setattr(quadtree, "_split", lambda rows, *a: gone.append({r[0] for r in rows.select("fid").collect()}) or split(rows, *a))
    assert held(quadtree.build(edges, 3)) == by_rows and not gone
    twice = edges.unionByName(edges.filter("fid = 1").withColumn("code", F.lit("other")))
    quadtree.build(twice, 3)
    assert gone == [{1}]
