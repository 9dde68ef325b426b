"""JO02 point-in-polygon join and IO04-IO06 GeoJSON zones."""

from __future__ import annotations

import json
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentyield.operators.spatial import spatial_join
from rentyield.sources.geojson import read_zones, zones_from_features

SQUARE_WITH_HOLE = [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]], [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]]
TRIANGLE = [[[10, 0], [20, 0], [15, 10], [10, 0]]]
OVERLAP = [[[0, 0], [3, 0], [3, 3], [0, 3], [0, 0]]]
MULTI = [[[[50, 50], [51, 50], [51, 51], [50, 51], [50, 50]]], [[[60, 60], [61, 60], [61, 61], [60, 61]]]]


def _f(rings):
    return [[[float(v) for v in p] for p in ring] for ring in rings]


def _zones(spark):
    rows = [
        (0, "1001", _f(SQUARE_WITH_HOLE)),
        (1, "1002", _f(TRIANGLE)),
        (2, "1003", _f(OVERLAP)),
        (3, "1004", _f([r for poly in MULTI for r in poly])),
    ]
    return spark.createDataFrame(rows, "fid bigint, code string, rings array<array<array<double>>>")


POINTS = [
    (2.0, 2.0, "1001"), (1.0, 4.0, "1001"), (15.0, 5.0, "1002"),
    (5.0, 5.0, None), (4.0, 5.0, None), (10.0, 5.0, None), (0.0, 0.0, None), (30.0, 30.0, None),
    (50.5, 50.5, "1004"), (60.5, 60.5, "1004"), (55.0, 55.0, None),
    (3.0, 1.0, "1001"),     # on the overlapping zone's edge, inside the first zone
    (None, 5.0, None),
]


@pytest.mark.parametrize("mode", ["broadcast", "salted"])
def test_fixture_points(spark, mode):
    pts = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(POINTS)], "i int, x double, y double")
    opts = {} if mode == "broadcast" else {"broadcast_limit": 0, "rows_per_task": 1, "max_hot_cells": 4}
    out = spatial_join(pts, _zones(spark), "x", "y", "code", cell=2.5, **opts).orderBy("i").collect()
    assert [r["code"] for r in out] == [p[2] for p in POINTS]
    assert out[0].asDict().keys() == {"i", "x", "y", "code"}


def test_where_limits_lookup(spark):
    pts = spark.createDataFrame([(1, 2.0, 2.0, True), (2, 2.0, 2.0, False), (3, 2.0, 2.0, None)],
                                "i int, x double, y double, want boolean")
    out = spatial_join(pts, _zones(spark), "x", "y", "code", where=F.col("want")).orderBy("i").collect()
    assert [r["code"] for r in out] == ["1001", None, None]


def _numpy_inside(px, py, rings):
    """Plain crossing count over all rings; on-edge points count as outside."""
    inside = np.zeros(len(px), dtype=bool)
    on = np.zeros(len(px), dtype=bool)
    for ring in rings:
        r = np.asarray(ring, dtype=float)
        if not np.array_equal(r[0], r[-1]):
            r = np.vstack([r, r[:1]])
        for (x1, y1), (x2, y2) in zip(r[:-1], r[1:]):
            straddle = (y1 > py) != (y2 > py)
            with np.errstate(divide="ignore", invalid="ignore"):
                xc = x1 + (py - y1) * (x2 - x1) / (y2 - y1)
            inside ^= straddle & (px < xc)
            col = (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1)
            on |= col & (px >= min(x1, x2)) & (px <= max(x1, x2)) & (py >= min(y1, y2)) & (py <= max(y1, y2))
    return inside & ~on


def _star(rng, cx, cy, n, r0, r1):
    ang = np.sort(rng.uniform(0, 2 * np.pi, n))
    rad = rng.uniform(r0, r1, n)
    pts = np.c_[cx + rad * np.cos(ang), cy + rad * np.sin(ang)]
    pts = np.round(pts * 8) / 8          # coarse lattice: many exact on-edge and vertex hits
    return [pts.tolist() + [pts[0].tolist()]]


@pytest.mark.parametrize("mode", ["broadcast", "salted"])
def test_random_against_numpy(spark, mode):
    rng = np.random.default_rng(7)
    zones = [(i, f"{2000 + i}", _star(rng, rng.uniform(0, 20), rng.uniform(0, 20), int(rng.integers(3, 12)), 1, 5))
             for i in range(25)]
    px = np.round(rng.uniform(-3, 23, 3000) * 8) / 8
    py = np.round(rng.uniform(-3, 23, 3000) * 8) / 8
    expected = []
    hits = np.stack([_numpy_inside(px, py, rings) for _, _, rings in zones])
    for j in range(len(px)):
        k = np.flatnonzero(hits[:, j])
        expected.append(zones[k[0]][1] if len(k) else None)
    zdf = spark.createDataFrame(zones, "fid bigint, code string, rings array<array<array<double>>>")
    pdf = spark.createDataFrame([(j, float(px[j]), float(py[j])) for j in range(len(px))], "j int, x double, y double")
    opts = {} if mode == "broadcast" else {"broadcast_limit": 0, "rows_per_task": 50, "max_hot_cells": 10}
    got = {r["j"]: r["code"] for r in spatial_join(pdf, zdf, "x", "y", "code", **opts).collect()}
    assert [got[j] for j in range(len(px))] == expected
    assert sum(e is not None for e in expected) > 500


def _feature(props, gtype, coords):
    return {"type": "Feature", "properties": props,
            "geometry": None if gtype is None else {"type": gtype, "coordinates": coords}}


def test_read_zones_file(spark):
    feats = [
        _feature({"PC4": 1001, "name": "a"}, "Polygon", SQUARE_WITH_HOLE),
        _feature({"PC4": "1002", "name": "b"}, "Polygon", TRIANGLE),
        _feature({"PC4": "1005"}, None, None),                      # no geometry: skipped
        _feature({"PC4": ""}, "Polygon", OVERLAP),                  # empty code: skipped
        _feature({"PC4": "1004"}, "MultiPolygon", MULTI),
        _feature({"PC4": "1006"}, "Point", [1, 2]),                 # not a polygon: skipped
    ]
    d = tempfile.mkdtemp(prefix="zones-", dir="/tmp")
    path = os.path.join(d, "zones.geojson")
    with open(path, "w") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f, indent=1)
    z = read_zones(spark, path).orderBy("fid").collect()
    assert [(r["fid"], r["code"], len(r["rings"])) for r in z] == [(0, "1001", 2), (1, "1002", 1), (4, "1004", 2)]
    line_path = os.path.join(d, "zones.geojsonl")
    with open(line_path, "w") as f:
        for ft in feats:
            f.write(json.dumps(ft) + "\n")
    zl = read_zones(spark, line_path, per_line=True).collect()
    assert sorted(r["code"] for r in zl) == ["1001", "1002", "1004"]


@pytest.mark.parametrize("props,key", [
    ({"pc4": "1001", "PC4": "9999"}, "pc4"),
    ({"name": "x", "postcode": "1001"}, "postcode"),
    ({"name": "x", "code_value": "1001", "other": "2002"}, "code_value"),
    ({"name": "x"}, None),
])
def test_code_property_detection(spark, props, key):
    feats = spark.createDataFrame(
        [(0, props, {"type": "Polygon", "coordinates": json.dumps(TRIANGLE)}),
         (1, {**props, "zz": "5555"}, {"type": "Polygon", "coordinates": json.dumps(OVERLAP)})],
        "fid bigint, properties map<string,string>, geometry struct<type:string, coordinates:string>")
    z = zones_from_features(feats).orderBy("fid").collect()
    if key is None:
        assert z == []
    else:
        assert [r["code"] for r in z] == [props[key], props[key]]


def test_wide_zone_changes_nothing_for_others(spark):
    """A zone a million times wider than the others has a few cells of its own level."""
    from rentyield.operators.spatial import build_cell_index, prepare
    rows = [(i, f"{3000 + i}", _f([[[i, 0], [i + 1, 0], [i + 1, 1], [i, 1], [i, 0]]])) for i in range(20)]
    rows.append((99, "9999", _f([[[-1e6, -1e6], [1e6, -1e6], [1e6, 1e6], [-1e6, 1e6], [-1e6, -1e6]]])))
    index = prepare(spark.createDataFrame(rows, "fid bigint, code string, rings array<array<array<double>>>"))
    assert index.cells == (1.0, 4.0 ** 11)
    assert build_cell_index(index, 4.0 ** 11).count() <= 4
    most = build_cell_index(index, 1.0).agg(F.max(F.size("zs"))).first()[0]
    assert most <= 4                                                # no cell holds all zones
    pts = spark.createDataFrame([(0, 0.5, 0.5), (1, 5e5, 5e5), (2, 2e6, 0.0)], "i int, x double, y double")
    got = [r["code"] for r in spatial_join(pts, index, "x", "y", "code").orderBy("i").collect()]
    assert got == ["3000", "9999", None]


def test_broken_feature_is_no_zone(spark):
    """A broken position in a hole drops the whole feature, not only the hole's edges."""
    feats = spark.createDataFrame(
        [(0, {"pc4": "1001"}, {"type": "Polygon", "coordinates": json.dumps(SQUARE_WITH_HOLE).replace("[4, 4]", '["x", 4]')}),
         (1, {"pc4": "1002"}, {"type": "Polygon", "coordinates": json.dumps(TRIANGLE)}),
         (2, {"pc4": "1003"}, {"type": "Polygon", "coordinates": "[[[0,0],[1]]]"}),
         (3, {"pc4": "1004"}, {"type": "Polygon", "coordinates": "[[[0,0],[1e300,0],[1,1],[0,0]]]"}),
         (4, {"pc4": "1005"}, {"type": "Polygon", "coordinates": "[]"})],
        "fid bigint, properties map<string,string>, geometry struct<type:string, coordinates:string>")
    from pyspark.sql import Observation
    seen = Observation("zones")
    zones = zones_from_features(feats, observation=seen)
    assert [r["code"] for r in zones.collect()] == ["1002"] and seen.get == {"features": 5, "skipped": 4}
    pts = spark.createDataFrame([(0, 2.0, 5.0), (1, 5.0, 5.0), (2, 15.0, 5.0)], "i int, x double, y double")
    got = [r["code"] for r in spatial_join(pts, zones, "x", "y", "code").orderBy("i").collect()]
    assert got == [None, None, "1002"]


def test_no_point_is_in_two_zones_at_a_shared_edge(spark):
    """Points within rounding of a slanted edge that two zones share (stored in opposite directions)."""
    from rentyield.operators import spatial as SP
    a = [[0.1, 0.3], [7.3, 9.7], [0.1, 9.7], [0.1, 0.3]]
    b = [[0.1, 0.3], [7.3, 0.3], [7.3, 9.7], [0.1, 0.3]]
    rng = np.random.default_rng(3)
    t = rng.uniform(0.01, 0.99, 4000)
    x, y = 0.1 + t * 7.2, 0.3 + t * 9.4
    x = np.where(rng.random(4000) < 0.5, np.nextafter(x, -1), np.nextafter(x, 9))
    pts = spark.createDataFrame([(i, float(p), float(q)) for i, (p, q) in enumerate(zip(x, y))], "i int, x double, y double")
    hits = []
    for ring in (a, b):
        z = spark.createDataFrame([(0, "1", [ring])], "fid bigint, code string, rings array<array<array<double>>>")
        hits.append({r["i"] for r in SP.spatial_join(pts, z, "x", "y", "c").filter("c IS NOT NULL").collect()})
    assert not hits[0] & hits[1] and len(hits[0] | hits[1]) > 1000
