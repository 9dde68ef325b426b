"""Point-in-polygon lookup (JO02) as a grid-cell equi-join on a grid of several levels.

A point-in-polygon test is a theta join; run naively it compares every point
with every zone. Here it becomes an equi-join:

1. zones → edges (rings of Polygon and MultiPolygon alike; even-odd rule, so
   holes and multi-part zones need no special case) → bounding box → level: the
   smallest power of four that is at least the zone's extent, and the grid cells
   of that size the box covers: four at most. So a very wide zone has a few cells of
   its own size and changes nothing for the others. Per (zone, cell) only the edges
   a rightward ray from a point of that cell can meet are kept.
2. cells → one index row per (level, cell) holding the zones of that level that
   meet the cell, sorted by feature order. Zones of a level are about as large as
   its cells, so a row holds as many of them as overlap in one place.
3. points → their cell on each level in use (two ``floor`` calls each) → an
   **equi-join on the cell** per level → the first candidate zone whose edges the
   ray crosses an odd number of times, with points on an edge excluded → over the
   levels, the lowest feature index.

Every point meets at most one index row per level, so the joins are left-preserving
with no row id, no group-by and no collect. The index is broadcast, after its size
has been bounded against ``broadcast_limit``; a larger one becomes the quadtree of
``operators.quadtree``, whose rows are bounded and which meets the points of all levels in one shuffle.

``prepare`` parses the zones once: a reliable checkpoint of their edges (in the folder
the session names in ``spark.checkpoint.dir``) and one small aggregate per level. The
result can be kept and passed to any number of joins.

Contract: an edge is stored from its lower to its higher end, so two zones that share an
edge compute the same crossing for a point and never both hold it. Positions are doubles;
a point that the (rounded) cross product places on an edge is in no zone; where zones
overlap the lowest feature index wins. A feature with a broken ring or position is no zone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import quadtree
from .quadtree import DEFAULT_MAX_HOT_CELLS, DEFAULT_ROWS_PER_TASK, QuadIndex
from .rings import zone_edges

DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024

_ON_EDGE = 1_000_000_000


def _inside_sql(z: str, px: str, py: str) -> str:
    """Even-odd ray test toward +x for zone struct ``z``; False when the point is on an edge.

    Written for the interpreted lambda path: a cheap bounding-box reject first,
    a long accumulator (no struct per step), bbox before the collinearity test,
    and per-edge constants (ylo, yhi, xlo, xhi, slope k) precomputed in the index.
    The crossing x uses the stored slope; exact on-edge points are caught by
    the exact cross-product test.
    """
    on = (f"{px} >= e.xlo AND {px} <= e.xhi AND {py} >= e.ylo AND {py} <= e.yhi "
          f"AND (e.x2 - e.x1) * ({py} - e.y1) = (e.y2 - e.y1) * ({px} - e.x1)")
    cross = f"{py} >= e.ylo AND {py} < e.yhi AND {px} < e.x1 + ({py} - e.y1) * e.k"
    return (f"{px} >= {z}.minx AND {px} <= {z}.maxx AND {py} >= {z}.miny AND {py} <= {z}.maxy AND "
            f"aggregate({z}.edges, 0L, (acc, e) -> acc + CASE WHEN {on} THEN {_ON_EDGE}L "
            f"WHEN {cross} THEN 1L ELSE 0L END, acc -> acc < {_ON_EDGE}L AND acc % 2 = 1)")


EDGE_BYTES = 96         # one stored edge: nine doubles plus row overhead
ZONE_BYTES = 128        # fid, bbox and array headers per zone entry; the code's length comes on top
LEAST_LEVEL = -20       # zones below 4^-20 across share the finest grid


@dataclass(frozen=True)
class ZoneIndex:
    """Zones prepared for any number of joins: checkpointed edges with their level, cell sizes, size bound."""

    edges: DataFrame
    cells: tuple[float, ...]        # cell size per level in use
    size_bound: int                 # upper bound on the index bytes

    @cached_property
    def quad(self) -> QuadIndex:
        """The same zones as a quadtree, built once for all joins that cannot broadcast them."""
        return quadtree.build_zones(self.edges)


def prepare(zones: DataFrame, cell: float | None = None) -> ZoneIndex:
    """Parse the zones once and gather, in one action, the levels in use and a bound on the index size.

    A zone of extent w gets cells of the smallest power of four that is at least w, at most four of them
    (``cell`` puts all zones on one grid of that size instead). The bound counts for each zone the cells of
    its box, each with all its edges; the per-cell edge filter only removes some.
    """
    ensure_checkpoint_dir(zones.sparkSession)
    edges = zone_edges(zones)
    if cell is None:
        extent = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
        level = F.greatest(F.ceil(F.log(4.0, extent)), F.lit(LEAST_LEVEL))
        size = F.pow(F.lit(4.0), F.when(extent > 0, level).otherwise(F.lit(LEAST_LEVEL)).cast("double"))
    else:
        size = F.lit(float(cell))
    edges = edges.withColumn("cell", size).checkpoint()
    c = F.col("cell")
    cells = (F.floor(F.col("maxx") / c) - F.floor(F.col("minx") / c) + 1) * (F.floor(F.col("maxy") / c) - F.floor(F.col("miny") / c) + 1)
    per_cell = F.size("edges") * F.lit(EDGE_BYTES) + F.lit(ZONE_BYTES) + F.coalesce(F.octet_length("code"), F.lit(0))
    rows = edges.groupBy("cell").agg(F.sum(cells * per_cell).alias("b")).collect()      # a row per level
    return ZoneIndex(edges, tuple(sorted(r["cell"] for r in rows)), sum(int(r["b"]) for r in rows))


def build_cell_index(index: ZoneIndex, cell: float) -> DataFrame:
    """(cx, cy, zs): per cell of one level, its candidate zones sorted by feature index."""
    c = F.lit(float(cell))
    eps = float(cell) * 1e-9
    zc = index.edges.filter(F.col("cell") == c)
    zc = zc.withColumn("cx", F.explode(F.sequence(F.floor(F.col("minx") / c), F.floor(F.col("maxx") / c))))
    zc = zc.withColumn("cy", F.explode(F.sequence(F.floor(F.col("miny") / c), F.floor(F.col("maxy") / c))))
    band = (f"filter(edges, e -> e.yhi >= cy * {cell!r}D - {eps!r}D "
            f"AND e.ylo <= (cy + 1) * {cell!r}D + {eps!r}D AND e.xhi >= cx * {cell!r}D - {eps!r}D)")
    zc = zc.select("cx", "cy", "fid", "code", "minx", "maxx", "miny", "maxy",
                   F.expr(band).alias("edges")).filter(F.size("edges") > 0)
    return zc.groupBy("cx", "cy").agg(F.sort_array(F.collect_list(
        F.struct("fid", "code", "minx", "maxx", "miny", "maxy", "edges"))).alias("zs"))


def _cell_of(v: Column, cell: float) -> Column:
    """Number of the cell; NULL for NaN and where the division loses whole cells (no zone of this level is there)."""
    q = v / F.lit(float(cell))
    return F.when(~F.isnan(v) & (F.abs(q) < F.lit(1e15)), F.floor(q))


def spatial_join(points: DataFrame, zones: DataFrame | ZoneIndex | QuadIndex, lon: str = "longitude", lat: str = "latitude",
                 out: str = "zone_code", where: Column | None = None, cell: float | None = None,
                 broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                 rows_per_task: int = DEFAULT_ROWS_PER_TASK,
                 max_hot_cells: int = DEFAULT_MAX_HOT_CELLS, in_steps: bool = False) -> DataFrame:
    """Add ``out`` = code of the zone containing (lon, lat), else NULL.

    ``zones`` has columns (fid, code, rings: array<array<array<double>>>), or is what ``prepare`` or
    ``quadtree.build`` or ``quadtree.build_zones`` made of them. Rows where ``where`` is false, or a coordinate is NULL, are passed through
    with NULL and never meet the index. An index larger than ``broadcast_limit`` is made a quadtree of edges and
    joined by one shuffle of the points; its levels are broadcast as far as ``broadcast_limit`` goes. A prepared index builds it once.
    ``in_steps``: as in ``quadtree.lookup``.
    """
    index = zones if isinstance(zones, ZoneIndex | QuadIndex) else prepare(zones, cell)
    if isinstance(index, ZoneIndex) and index.size_bound > broadcast_limit:
        index = index.quad
    if isinstance(index, QuadIndex):
        return quadtree.lookup(points, index, lon, lat, out, where, rows_per_task, max_hot_cells, broadcast_limit, in_steps)
    ok = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    if where is not None:
        ok = ok & F.coalesce(where, F.lit(False))
    joined = points.withColumns({"_px": F.when(ok, F.col(lon).cast("double")), "_py": F.when(ok, F.col(lat).cast("double"))})
    hits = []
    for i, size in enumerate(index.cells):
        joined = joined.withColumns({"_cx": _cell_of(F.col("_px"), size), "_cy": _cell_of(F.col("_py"), size)})
        cells = build_cell_index(index, size)
        joined = joined.join(F.broadcast(cells.withColumnsRenamed({"cx": "_cx", "cy": "_cy"})), on=["_cx", "_cy"], how="left")
        # zones are sorted by feature order: keep the first hit and skip the tests after it
        hit = F.expr(f"aggregate(zs, CAST(NULL AS STRUCT<fid: BIGINT, code: STRING>), (acc, z) -> "
                     f"CASE WHEN acc IS NULL AND ({_inside_sql('z', '_px', '_py')}) "
                     f"THEN named_struct('fid', CAST(z.fid AS BIGINT), 'code', z.code) ELSE acc END)")
        joined = joined.withColumn(f"_hit{i}", hit).drop("_cx", "_cy", "zs")
        hits.append(f"_hit{i}")
    if not hits:
        code = F.lit(None).cast("string")
    else:
        code = (F.least(*hits) if len(hits) > 1 else F.col(hits[0])).getField("code")
    return joined.withColumn(out, code).drop("_px", "_py", *hits)
