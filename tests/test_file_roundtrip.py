"""The file pipeline equals the registered query: demo views → raw files → run() → gold."""

from __future__ import annotations

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_ORACLE
from rentyield.params import Paths
from rentyield.plans.run import run, target
from rentyield.sources import demo


@pytest.mark.parametrize("per_line", [False, True])
def test_raw_files_give_the_registered_gold(spark, per_line):
    raw = tempfile.mkdtemp(prefix="rentyield-roundtrip-", dir="/tmp")
    demo.stays(spark, SF_ORACLE).write.option("header", True).csv(f"{raw}/airbnb.csv")
    lets = demo.lets(spark, SF_ORACLE)
    for c in ["_id", "firstSeenAt", "lastSeenAt"]:
        lets = lets.withColumn(c, F.array(F.col(c)))               # singleton arrays, as scraped
    lets.write.json(f"{raw}/rentals.json")                          # JSON lines
    feats = demo.zone_features(spark, SF_ORACLE).orderBy("fid").collect()
    os.makedirs(f"{raw}/geo")
    features = [{"type": "Feature", "properties": dict(r["properties"]),
                 "geometry": {"type": r["geometry"]["type"], "coordinates": json.loads(r["geometry"]["coordinates"])}}
                for r in feats]
    with open(f"{raw}/geo/post_codes.geojson", "w") as f:
        if per_line:
            f.writelines(json.dumps(x) + "\n" for x in features)
        else:
            json.dump({"type": "FeatureCollection", "features": features}, f)
    paths = Paths(raw=raw, tables=f"{raw}/tables", rentals_multiline=False, zones_per_line=per_line)
    audit = run(spark, paths)
    gold = spark.read.parquet(target(paths, "gold"))
    query = E.queries()["gold_compare"](spark, SF_ORACLE)
    cols = sorted(query.columns)
    assert sorted(gold.columns) == cols
    assert gold.select(*cols).exceptAll(query.select(*cols)).count() == 0
    assert query.select(*cols).exceptAll(gold.select(*cols)).count() == 0
    assert audit.counts["gold"]["rows"] == query.count()
