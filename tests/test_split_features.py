"""IO04: a FeatureCollection cut at its features gives what the one-task reader gives."""

from __future__ import annotations

import json
import tempfile

import pytest

from rentyield.sources.geojson import read_features, read_zones, split_features


def _feature(i: int, **properties) -> dict:
    ring = [[i, 0], [i + 1, 0.5], [i + 1, 1], [i, 0]]
    return {"type": "Feature", "properties": {"pc4": str(1000 + i), **properties}, "geometry": {"type": "Polygon", "coordinates": [ring]}}


def _rows(df) -> list:
    """The rows, JSON kept as text without blanks: the readers differ in whether they keep those."""
    def packed(text: str | None) -> str | None:
        return text and "".join(text.split()) if text and text[0] in "[{" else text

    return sorted((r["fid"], sorted((k, packed(v)) for k, v in (r["properties"] or {}).items() if k != "name" or v),
                   r["geometry"] and (r["geometry"]["type"], packed(r["geometry"]["coordinates"]))) for r in df.collect())


def _file(text: str) -> str:
    path = tempfile.mkdtemp(prefix="rentyield-zones-", dir="/tmp") + "/zones.geojson"
    with open(path, "w") as f:
        f.write(text)
    return path


NASTY = ['a},{"b', '{{{', '}', '"Feature"', 'back\\', '\\"}', '],"x":[', 'é ☃', ""]


def _collection(features: list, **more) -> dict:
    return {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "x"}}, "features": features, **more}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("type_last", [False, True])
def test_splits_equal_the_plain_reader(spark, indent, type_last):
    features = [_feature(i, name=NASTY[i % len(NASTY)]) for i in range(400)]
    features[7]["properties"]["nested"] = [{"a": 1}, {"b": {"c": "}"}}]
    if type_last:       # the type after the other members: a record holds the whole next feature
        features = [{k: f[k] for k in ("properties", "geometry", "type")} for f in features]
    path = _file(json.dumps(_collection(features, bbox=[0, 0, 1, 1]), indent=indent, ensure_ascii=False))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 3000)
    try:
        got = split_features(spark, path)
        assert got is not None and _rows(got) == _rows(read_features(spark, path))
        assert spark.read.option("lineSep", '"Feature"').text(path).rdd.getNumPartitions() > 10
        zones = {(r["fid"], r["code"], str(r["rings"])) for r in read_zones(spark, path, split=True).collect()}
        assert zones == {(r["fid"], r["code"], str(r["rings"])) for r in read_zones(spark, path).collect()} and len(zones) == 400
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text", [
    json.dumps(_collection([_feature(1, kind="Feature"), _feature(2)])),                   # the mark as a property's value
    json.dumps(_collection([{"type": "Feature", "properties": {"sub": _feature(1)}, "geometry": _feature(1)["geometry"]}, _feature(2)])),
    json.dumps(_collection([])), "{}", "", json.dumps(_collection([_feature(1), _feature(2)]))[:-40],
    json.dumps([_feature(1), _feature(2)])])
def test_other_documents_are_left_to_the_plain_reader(spark, text):
    path = _file(text)
    assert split_features(spark, path) is None
    assert _rows(read_features(spark, path, split=True)) == _rows(read_features(spark, path))


def test_one_feature_and_a_broken_geometry(spark):
    features = [_feature(3) | {"geometry": None}, _feature(4)]
    for some in (features, features[:1]):
        path = _file(json.dumps(_collection(some)))
        assert split_features(spark, path) is not None
        assert _rows(read_features(spark, path, split=True)) == _rows(read_features(spark, path))
