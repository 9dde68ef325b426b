"""Rings of zones as edges: the input check of a feature (IO06) and the edges both point-in-polygon joins use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ring (array of [x, y] positions) closed if needed, as SQL text over variable r
_CLOSED = "CASE WHEN get(r, 0) = get(r, size(r) - 1) THEN r ELSE concat(r, array(get(r, 0))) END"

# edges run from the end with the lower y (then x) to the other: both zones at an edge store the same one
_EDGES_SQL = f"""
flatten(transform(rings,
  r -> zip_with(
    slice({_CLOSED}, 1, size({_CLOSED}) - 1),
    slice({_CLOSED}, 2, size({_CLOSED}) - 1),
    (a, b) -> CASE WHEN get(a, 1) < get(b, 1) OR (get(a, 1) = get(b, 1) AND get(a, 0) <= get(b, 0))
      THEN named_struct('x1', get(a, 0), 'y1', get(a, 1), 'x2', get(b, 0), 'y2', get(b, 1))
      ELSE named_struct('x1', get(b, 0), 'y1', get(b, 1), 'x2', get(a, 0), 'y2', get(a, 1)) END)))
"""

_POSITION_OK = "p IS NOT NULL AND size(p) >= 2 AND abs(get(p, 0)) < 1e150 AND abs(get(p, 1)) < 1e150"


def well_formed(rings: str = "rings") -> Column:
    """IO06: every ring has three positions at least, every position two finite numbers (below 1e150)."""
    return F.expr(f"coalesce({rings} IS NOT NULL AND size({rings}) > 0 AND forall({rings}, r -> r IS NOT NULL AND size(r) >= 3 "
                  f"AND forall(r, p -> coalesce({_POSITION_OK}, false))), false)")


def zone_edges(zones: DataFrame) -> DataFrame:
    """(fid, code, rings) → (fid, code, edges, minx, miny, maxx, maxy); broken features are dropped whole."""
    # a well-formed zone has two edges at least
    z = zones.filter(well_formed()).select("fid", "code", F.expr(_EDGES_SQL).alias("edges"))
    z = z.withColumn("edges", F.expr(
        "transform(edges, e -> named_struct('x1', e.x1, 'y1', e.y1, 'x2', e.x2, 'y2', e.y2, "
        "'xlo', least(e.x1, e.x2), 'xhi', greatest(e.x1, e.x2), "
        "'ylo', e.y1, 'yhi', e.y2, "
        "'k', CASE WHEN e.y1 != e.y2 THEN (e.x2 - e.x1) / (e.y2 - e.y1) END))"))
    return z.withColumns({
        "minx": F.expr("array_min(transform(edges, e -> e.xlo))"),
        "maxx": F.expr("array_max(transform(edges, e -> e.xhi))"),
        "miny": F.expr("array_min(transform(edges, e -> e.ylo))"),
        "maxy": F.expr("array_max(transform(edges, e -> e.yhi))"),
    })
