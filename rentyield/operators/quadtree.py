"""Point-in-polygon lookup (JO02) on a quadtree of edges: for zones too large, or too many, to broadcast.

The plane is a tree of cells: one root cell around all zones, each cell of 4 x 4 children. A cell is named by one
number, the interleaved bits of its column and row after a leading 1, so a parent's name is its child's without the
last four bits.

Zones. Each zone begins with the cells of its own size (four at most). A (zone, cell) pair holds the zone's edges that
touch the cell, and one bit: whether the cell's reference point is inside the zone. A pair with more than ``max_edges`` edges is split into
its 16 children; those that no edge touches are kept if they are inside. Both numbers of all pairs come from one
aggregate over edge rows: the crossings between a child's reference point and its parent's are summed modulo 2.
So no pair ever holds more than ``max_edges`` edges, however many a zone has, and the edges of one large zone are dealt over all tasks.
A zone of ``max_edges`` edges at most is never split: ``build_zones`` makes its pairs where its row is, without a shuffle, and
only larger zones go through edge rows. ``build`` gathers the edges of zones of ``in_row`` edges at most, in one shuffle, and
splits their pairs level by level where the row is.

Points. A point is inside a zone if the reference point of its cell is, unless the way between the two (along the point's row,
then along the reference point's column) crosses an odd number of the pair's edges. The point's finest cell gives its
cells on all levels by shifts; distinct positions meet the pairs of all levels in **one** join on the cell's number,
where cells of many positions are salted. The pairs of the smallest levels may be broadcast instead, up to ``broadcast_limit``
bytes: a few wide zones then cost no shuffled row per position. A zone's box is held against the position before its edges are. The lowest feature index per position is joined back to the points, so they are
shuffled once whatever the number of levels, and every point is preserved without a row number.

Contract: as in ``operators.spatial``: an edge is stored from its lower to its higher end and its crossing of a row is
computed in the same way; a point that the (rounded) cross product places on an edge is in no zone; the lowest feature index
wins; a feature with a broken ring or position is no zone; NULL, NaN and far-off positions have no zone.
Cells are not split below a hundred-millionth of the coordinates, nor beyond ``MAX_DEPTH`` levels: a pair
there keeps all its edges (those that meet in one vertex, say).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.tables import drop_written, written
from .rings import zone_edges

DEFAULT_ROWS_PER_TASK = 2_000_000
DEFAULT_MAX_HOT_CELLS = 100_000
DEFAULT_MAX_EDGES = 256
MAX_DEPTH = 15
EDGE_BYTES = 96         # one stored edge: six doubles plus row overhead
PAIR_BYTES = 160        # box, reference point, numbers and headers of a pair; the code's length comes on top
#: Place of the reference point in its cell: odd fractions, so that it is on no edge of round coordinates.
_FX, _FY = 0.7548776662466927, 0.5698402909980532
#: Cells take edges this much (of their size) outside them too.
_MARGIN = 1e-6
_ON_EDGE = 1_000_000_000
_EDGE = ["x1", "y1", "x2", "y2"]
_BOX = ["minx", "miny", "maxx", "maxy"]
_SLOPED = [*_EDGE, "k", "m"]        # with the slopes dx/dy and dy/dx, NULL where there is none
_EDGES = "array<struct<x1: double, y1: double, x2: double, y2: double, k: double, m: double>>"


@dataclass(frozen=True)
class QuadIndex:
    """Written (cell, fid, code, box, xr, yr, par, edges) rows, the root cell, the depths in use, the most edges of a row, bytes per depth."""

    pairs: DataFrame
    origin: tuple[float, float]
    root: float
    depths: tuple[int, ...]
    widest: int
    sizes: dict[int, int] = field(default_factory=dict)


# ---- edges -------------------------------------------------------------------------

def edges_of_zones(zones: DataFrame) -> DataFrame:
    """(fid, code, rings) → (fid, code, x1, y1, x2, y2), a row per edge; broken features are dropped whole."""
    return zone_edges(zones).select("fid", "code", F.explode("edges").alias("e")).select("fid", "code", *[f"e.{c}" for c in _EDGE])


def edges_of_positions(positions: DataFrame) -> DataFrame:
    """(fid, code, ring, pos, x, y) → edge rows: zones of any size, a row per position instead of one per zone.

    Positions of a ring are joined to their successors by ``pos`` (whole numbers without gaps); an open ring is closed.
    A zone with a broken position, or a ring of fewer than three, is dropped whole.
    """
    # written: the positions are read four times below, and their rings three times
    p, _ = written(positions.select("fid", "code", "ring", F.col("pos").cast("long").alias("pos"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")))
    fine = F.coalesce((F.abs("x") < F.lit(1e150)) & (F.abs("y") < F.lit(1e150)), F.lit(False))
    rings, _ = written(p.groupBy("fid", "ring").agg(F.count_if(~fine).alias("bad"), F.count("*").alias("n"), F.max("code").alias("code"),
                                                 F.min_by(F.struct("x", "y"), "pos").alias("a"), F.max_by(F.struct("x", "y"), "pos").alias("z")))
    broken = rings.filter((F.col("bad") > 0) | (F.col("n") < 3)).select(F.col("fid").alias("_f")).distinct()
    following = p.select(F.col("fid").alias("_f"), F.col("ring").alias("_r"), (F.col("pos") - 1).alias("_p"), F.col("x").alias("xn"), F.col("y").alias("yn"))
    steps = (p.join(following, (F.col("fid") == F.col("_f")) & (F.col("ring") == F.col("_r")) & (F.col("pos") == F.col("_p")))
             .select("fid", "code", "x", "y", "xn", "yn"))
    closing = rings.filter(F.col("a") != F.col("z")).select("fid", "code", F.col("z.x").alias("x"), F.col("z.y").alias("y"),
                                                            F.col("a.x").alias("xn"), F.col("a.y").alias("yn"))
    up = (F.col("y") < F.col("yn")) | ((F.col("y") == F.col("yn")) & (F.col("x") <= F.col("xn")))
    ends = [F.when(up, F.col(a)).otherwise(F.col(b)).alias(name) for a, b, name in
            (("x", "xn", "x1"), ("y", "yn", "y1"), ("xn", "x", "x2"), ("yn", "y", "y2"))]
    return steps.unionByName(closing).join(broken, F.col("fid") == F.col("_f"), "left_anti").select("fid", "code", *ends)


# ---- geometry, as SQL over an edge's columns (prefix e: "" or "e.") -------------------

def _right_of(e: str, y: str, x: str) -> str:
    """Whether the edge crosses height y to the right of x."""
    return f"({e}x1 + ({y} - {e}y1) * {e}k > {x})"


def _above(e: str, x: str, y: str) -> str:
    return f"({e}y1 + ({x} - {e}x1) * {e}m > {y})"


def _crossings(e: str, px: str, py: str, xr: str, yr: str) -> str:
    """Crossings of the way from (px, py) along its row to xr, then along that column to yr (0, 1 or 2)."""
    row = f"CASE WHEN {py} >= {e}y1 AND {py} < {e}y2 AND {_right_of(e, py, px)} != {_right_of(e, py, xr)} THEN 1L ELSE 0L END"
    column = (f"CASE WHEN {xr} >= least({e}x1, {e}x2) AND {xr} < greatest({e}x1, {e}x2) "
              f"AND {_above(e, xr, py)} != {_above(e, xr, yr)} THEN 1L ELSE 0L END")
    return f"({row} + {column})"


def _on_edge(px: str, py: str) -> str:
    return (f"{px} >= least(e.x1, e.x2) AND {px} <= greatest(e.x1, e.x2) AND {py} >= e.y1 AND {py} <= e.y2 "
            f"AND (e.x2 - e.x1) * ({py} - e.y1) = (e.y2 - e.y1) * ({px} - e.x1)")


def _touches(cx: str, cy: str, size: str, e: str = "") -> str:
    """The edge meets the cell, with a margin: their boxes do, and its line does not leave all corners on one side.

    Columns ox, oy hold the origin.
    """
    m = _MARGIN
    box = (f"greatest({e}x1, {e}x2) >= ox + ({cx} - {m}D) * {size} AND least({e}x1, {e}x2) <= ox + ({cx} + 1 + {m}D) * {size} "
           f"AND {e}y2 >= oy + ({cy} - {m}D) * {size} AND {e}y1 <= oy + ({cy} + 1 + {m}D) * {size}")
    off = f"abs(({e}x2 - {e}x1) * (oy + ({cy} + 0.5D) * {size} - {e}y1) - ({e}y2 - {e}y1) * (ox + ({cx} + 0.5D) * {size} - {e}x1))"
    return f"{box} AND {off} <= (abs({e}x2 - {e}x1) + abs({e}y2 - {e}y1)) * {size} * {0.5 + m}D"


def _spread_bits(c: Column) -> Column:
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = F.shiftleft(c, shift).bitwiseOR(c).bitwiseAND(F.lit(mask))
    return c


def cell_number(cx: Column, cy: Column, depth: Column) -> Column:
    """Interleaved bits of column and row (two bits of each per depth) after a leading 1."""
    return (F.expr("1L") * F.pow(F.lit(16.0), depth.cast("double")).cast("long")).bitwiseOR(_spread_bits(cx)).bitwiseOR(F.shiftleft(_spread_bits(cy), 1))


# ---- index -------------------------------------------------------------------------

@dataclass(frozen=True)
class _Frame:
    """The root cell and the deepest level of a tree."""

    origin: tuple[float, float]
    root: float
    deepest: int


def _frame(boxes: DataFrame) -> _Frame | None:
    b = boxes.agg(F.min("minx").alias("minx"), F.max("maxx").alias("maxx"), F.min("miny").alias("miny"), F.max("maxy").alias("maxy")).first()
    if b["minx"] is None:
        return None
    extent = max(b["maxx"] - b["minx"], b["maxy"] - b["miny"])
    least = 1e-8 * max(abs(v) for v in b) or 1e-300
    root = 4.0 ** -74
    while root <= extent or root < least:
        root *= 4
    deepest = 0
    while deepest < MAX_DEPTH and root / 4 ** (deepest + 1) >= least:
        deepest += 1
    return _Frame((b["minx"], b["miny"]), root, deepest)


def _own_cells(boxes: DataFrame, frame: _Frame) -> DataFrame:
    """A row per zone and cell of its own size; adds depth, size, cx, cy and the origin."""
    ox, oy = F.lit(frame.origin[0]), F.lit(frame.origin[1])
    # a zone begins at the depth whose cells are just as large: four cells at most
    width = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    depth = F.when(width > 0, F.floor(F.log(4.0, F.lit(frame.root) / width))).otherwise(F.lit(frame.deepest))
    boxes = boxes.withColumn("depth", F.least(F.greatest(depth, F.lit(0)), F.lit(frame.deepest)).cast("int"))
    boxes = boxes.withColumn("size", F.lit(frame.root) / F.pow(F.lit(4.0), F.col("depth").cast("double")))
    steps = [F.sequence(F.floor((F.col(lo) - o) / F.col("size")), F.floor((F.col(hi) - o) / F.col("size"))) for lo, hi, o in
             (("minx", "maxx", ox), ("miny", "maxy", oy))]
    return boxes.withColumn("cx", F.explode(steps[0])).withColumn("cy", F.explode(steps[1])).withColumns({"ox": ox, "oy": oy})


def _no_index(spark) -> QuadIndex:
    return QuadIndex(spark.createDataFrame([], _PAIRS), (0.0, 0.0), 1.0, (), 0)


def _index_of(done: list[DataFrame], frame: _Frame) -> QuadIndex:
    pairs = done[0]
    for more in done[1:]:
        pairs = pairs.unionByName(more)
    size = F.lit(PAIR_BYTES) + F.coalesce(F.octet_length("code"), F.lit(0)) + F.size("edges") * F.lit(EDGE_BYTES)
    held = pairs.groupBy("depth").agg(F.max(F.size("edges")).alias("widest"), F.sum(size).alias("b")).collect()    # MAX_DEPTH + 1 rows at most
    sizes = {r["depth"]: int(r["b"]) for r in held}
    return QuadIndex(pairs, frame.origin, frame.root, tuple(sorted(sizes)), max((r["widest"] for r in held), default=0), sizes)


def build_zones(zones: DataFrame, max_edges: int = DEFAULT_MAX_EDGES) -> QuadIndex:
    """(fid, code, edges, minx, miny, maxx, maxy), as ``rings.zone_edges`` gives them → the tree that ``build`` makes of their edges."""
    spark = zones.sparkSession
    ensure_checkpoint_dir(spark)
    z = zones.select(F.col("fid").cast("long").alias("fid"), "code", "edges", *_BOX)
    frame = _frame(z)
    if frame is None:
        return _no_index(spark)
    # zones to split, and rows of one fid: these make one zone together, as their edge rows do
    apart = z.groupBy("fid").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("edges")).alias("held"))
    apart = apart.filter((F.col("n") > 1) | (F.col("held") > max_edges)).select(F.col("fid").alias("_a")).checkpoint()
    light = z.filter("fid IS NOT NULL").join(apart, F.col("fid") == F.col("_a"), "left_anti")
    odd = f"CASE WHEN yr >= e.y1 AND yr < e.y2 AND {_right_of('e.', 'yr', 'xr')} THEN 1L ELSE 0L END"
    sloped = ", ".join([*(f"'{c}', e.{c}" for c in _EDGE), "'k', try_divide(e.x2 - e.x1, e.y2 - e.y1)", "'m', try_divide(e.y2 - e.y1, e.x2 - e.x1)"])
    # slopes once per zone, before it has a row per cell
    light = light.withColumn("edges", F.expr(f"transform(edges, e -> named_struct({sloped}))"))
    light = _with_reference(_own_cells(light, frame))
    light = light.withColumns({"par": F.expr(f"aggregate(edges, 0L, (acc, e) -> acc + {odd}) % 2"),
                               "edges": F.expr(f"filter(edges, e -> {_touches('cx', 'cy', 'size', 'e.')})")})
    rows, _ = written(light.select(cell_number(F.col("cx"), F.col("cy"), F.col("depth")).alias("cell"), "depth", "fid", "code", *_BOX,
                                      "xr", "yr", "par", "edges"))
    done = [rows.filter((F.size("edges") > 0) | (F.col("par") == 1))]
    if not apart.isEmpty():
        heavy = z.join(apart, F.col("fid") == F.col("_a"), "left_semi")
        done += _split(heavy.select("fid", "code", F.explode("edges").alias("e")).select("fid", "code", *[f"e.{c}" for c in _EDGE]), max_edges, frame)
    return _index_of(done, frame)


def build(edges: DataFrame, max_edges: int = DEFAULT_MAX_EDGES, in_row: int = DEFAULT_MAX_EDGES) -> QuadIndex:
    """Edge rows → the tree's (zone, cell) pairs. Only the root box, depths and counts reach the driver.

    Zones of more than ``in_row`` edges, and rows of one fid with different codes, are split by edge rows.
    """
    spark = edges.sparkSession
    ensure_checkpoint_dir(spark)
    edges, path = written(edges.select(F.col("fid").cast("long").alias("fid"), "code", *_EDGE))
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    frame = _frame(edges.select(low.alias("minx"), high.alias("maxx"), F.col("y1").alias("miny"), F.col("y2").alias("maxy")))
    if frame is None:
        drop_written(spark, [path])
        return _no_index(spark)
    n, named = F.count(F.lit(1)), F.count("code")
    counts = edges.groupBy("fid").agg(n.alias("n"), ((F.min("code") != F.max("code")) | ((named > 0) & (named < n))).alias("unlike"))
    apart, other = written(counts.filter((F.col("n") > in_row) | F.col("unlike")).select(F.col("fid").alias("_a")))
    some = not apart.isEmpty()
    light = edges.filter("fid IS NOT NULL")
    if some:
        light = light.join(apart, F.col("fid") == F.col("_a"), "left_anti")
    sloped = F.struct(*_EDGE, F.expr("try_divide(x2 - x1, y2 - y1)").alias("k"), F.expr("try_divide(y2 - y1, x2 - x1)").alias("m"))
    light = light.groupBy("fid").agg(F.max("code").alias("code"), F.min(low).alias("minx"), F.max(high).alias("maxx"),
                                     F.min("y1").alias("miny"), F.max("y2").alias("maxy"), F.collect_list(sloped).alias("edges"))
    done = _split_in_rows(light, max_edges, frame)
    if some:
        done += _split(edges.join(apart, F.col("fid") == F.col("_a"), "left_semi"), max_edges, frame)
    drop_written(spark, [path, other])
    return _index_of(done, frame)


def _held(par: Column, edges: Column) -> Column:
    """Both from one array, so that filters on them stay above and do not compute them again."""
    return F.explode(F.array(F.struct(par.alias("par"), edges.alias("edges")))).alias("_h")


def _split_in_rows(zones: DataFrame, max_edges: int, frame: _Frame) -> list[DataFrame]:
    """The written pairs of each level, for zones with all their edges in a row: no row is shuffled."""
    columns = ["fid", "code", *_BOX, "depth", "size", "cx", "cy", "xr", "yr"]
    touching = F.expr(f"filter(edges, e -> {_touches('cx', 'cy', 'size', 'e.')})")
    odd = f"CASE WHEN yr >= e.y1 AND yr < e.y2 AND {_right_of('e.', 'yr', 'xr')} THEN 1L ELSE 0L END"
    rows = _with_reference(_own_cells(zones, frame)).select(*columns, _held(F.expr(f"aggregate(edges, 0L, (acc, e) -> acc + {odd}) % 2"), touching))
    done = []
    while True:
        rows, _ = written(rows.select(*columns, "_h.*").withColumn("n", F.size("edges")).filter("n > 0 OR par = 1"))
        heavy = (F.col("n") > max_edges) & (F.col("depth") < frame.deepest)
        done.append(rows.filter(~heavy).select(cell_number(F.col("cx"), F.col("cy"), F.col("depth")).alias("cell"), "depth",
                                               "fid", "code", *_BOX, "xr", "yr", "par", "edges"))
        split = rows.filter(heavy)
        if split.isEmpty():
            return done
        down = split.withColumns({"px": F.col("xr"), "py": F.col("yr"), "child": F.explode(F.sequence(F.lit(0), F.lit(15)))})
        down = down.withColumns({"cx": F.col("cx") * 4 + F.col("child") % 4, "cy": F.col("cy") * 4 + F.floor(F.col("child") / 4),
                                 "size": F.col("size") / 4, "depth": F.col("depth") + 1, "ox": F.lit(frame.origin[0]), "oy": F.lit(frame.origin[1])})
        between = f"aggregate(edges, par, (acc, e) -> acc + {_crossings('e.', 'xr', 'yr', 'px', 'py')}) % 2"
        rows = _with_reference(down).select(*columns, _held(F.expr(between), touching))


def _split(edges: DataFrame, max_edges: int, frame: _Frame) -> list[DataFrame]:
    """The written pairs of each level, for zones of any size given by edge rows."""
    spark = edges.sparkSession
    edges, path = written(edges.select(F.col("fid").cast("long").alias("fid"), "code", *_EDGE, F.expr("try_divide(x2 - x1, y2 - y1)").alias("k"),
                                       F.expr("try_divide(y2 - y1, x2 - x1)").alias("m")))
    passing = [path]                    # tables that go once the next level is written
    boxes = edges.groupBy("fid").agg(F.min(F.least("x1", "x2")).alias("minx"), F.max(F.greatest("x1", "x2")).alias("maxx"),
                                     F.min("y1").alias("miny"), F.max("y2").alias("maxy"))
    deepest = frame.deepest
    ox, oy = F.lit(frame.origin[0]), F.lit(frame.origin[1])
    cells = _own_cells(boxes, frame).select(F.col("fid").alias("_f"), *_BOX, "depth", "size", "cx", "cy")
    rows = edges.join(cells, F.col("fid") == F.col("_f")).drop("_f").withColumns({"ox": ox, "oy": oy, "par": F.lit(0).cast("long")})
    rows = _with_reference(rows).withColumns({
        "touch": F.expr(_touches("cx", "cy", "size")),
        "odd": F.expr(f"CASE WHEN yr >= y1 AND yr < y2 AND {_right_of('', 'yr', 'xr')} THEN 1L ELSE 0L END")})
    done = []
    while True:
        rows, path = written(rows.select("fid", "code", *_BOX, *_SLOPED, "depth", "size", "cx", "cy", "par", "touch", "odd"))
        drop_written(spark, passing)
        pairs, other = written(rows.groupBy("fid", "cx", "cy", "depth").agg(
            F.max("code").alias("code"), *[F.max(c).alias(c) for c in _BOX], F.max("size").alias("size"), ((F.max("par") + F.sum("odd")) % 2).alias("par"), F.count_if("touch").alias("n")))
        passing = [path, other]
        heavy = (F.col("n") > max_edges) & (F.col("depth") < deepest)
        # light pairs gather their edges: max_edges at most (beyond only at the deepest level)
        light = pairs.filter(~heavy & ((F.col("n") > 0) | (F.col("par") == 1)))
        few = rows.filter("touch").join(light.filter("n > 0").select(*_key("l")), _same("l"), "left_semi")
        gathered = few.groupBy("fid", "cx", "cy", "depth").agg(F.collect_list(F.struct(*_SLOPED)).alias("edges"))
        none = F.array().cast(_EDGES)
        leaf = (light.join(gathered.select(*_key("g"), "edges"), _same("g"), "left")
                .withColumns({"ox": ox, "oy": oy, "edges": F.coalesce("edges", none)}))
        done.append(written(_with_reference(leaf).select(cell_number(F.col("cx"), F.col("cy"), F.col("depth")).alias("cell"), "depth",
                                                         "fid", "code", *_BOX, "xr", "yr", "par", "edges"))[0])
        split = pairs.filter(heavy).select(*_key("h"), F.col("par").alias("_par"))
        if split.isEmpty():
            drop_written(spark, passing)
            break
        # each edge of a heavy pair meets its 16 children: what it adds between the reference points, and whether it touches
        down = _with_reference(rows.filter("touch").join(split, _same("h")).withColumns({"ox": ox, "oy": oy}))
        down = down.withColumns({"px": F.col("xr"), "py": F.col("yr"), "child": F.explode(F.sequence(F.lit(0), F.lit(15)))})
        down = down.withColumns({"cx": F.col("cx") * 4 + F.col("child") % 4, "cy": F.col("cy") * 4 + F.floor(F.col("child") / 4),
                                 "size": F.col("size") / 4, "depth": F.col("depth") + 1, "par": F.col("_par")})
        rows = _with_reference(down).withColumns({
            "touch": F.expr(_touches("cx", "cy", "size")), "odd": F.expr(_crossings("", "xr", "yr", "px", "py"))})
    return done


_PAIRS = f"cell long, depth int, fid long, code string, minx double, miny double, maxx double, maxy double, xr double, yr double, par long, edges {_EDGES}"
_KEY = ("fid", "cx", "cy", "depth")


def _key(prefix: str) -> list[Column]:
    return [F.col(c).alias(f"_{prefix}{c}") for c in _KEY]


def _same(prefix: str) -> Column:
    out = F.lit(True)
    for c in _KEY:
        out = out & (F.col(c) == F.col(f"_{prefix}{c}"))
    return out


def _with_reference(df: DataFrame) -> DataFrame:
    size = F.col("size")
    return df.withColumns({"xr": F.col("ox") + (F.col("cx") + F.lit(_FX)) * size, "yr": F.col("oy") + (F.col("cy") + F.lit(_FY)) * size})


# ---- lookup ------------------------------------------------------------------------

def lookup(points: DataFrame, index: QuadIndex, lon: str = "longitude", lat: str = "latitude", out: str = "zone_code",
           where: Column | None = None, rows_per_task: int = DEFAULT_ROWS_PER_TASK,
           max_hot_cells: int = DEFAULT_MAX_HOT_CELLS, broadcast_limit: int = 0, in_steps: bool = False) -> DataFrame:
    """Add ``out`` = code of the zone containing (lon, lat), else NULL; every row of ``points`` is kept as it is.

    The smallest levels of the index are broadcast, as many as ``broadcast_limit`` bytes hold.
    ``in_steps`` takes less disk at a time: the positions found are written before the rows are joined to them, so the index
    and the files of its joins may go (``tables.release``), and rows that look up nothing are not shuffled. The points are
    read once more for it.
    """
    if not index.depths:
        return points.withColumn(out, F.lit(None).cast("string"))
    ok = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    if where is not None:
        ok = ok & F.coalesce(where, F.lit(False))
    rows = points.withColumns({"_px": F.when(ok, F.col(lon).cast("double")), "_py": F.when(ok, F.col(lat).cast("double"))})
    # exploded from one array, so that filters on a position stay above its parsing and do not repeat it
    at = F.explode(F.when(ok, F.array(F.struct(F.col(lon).cast("double").alias("_px"), F.col(lat).cast("double").alias("_py"))))).alias("_p")
    found = positions_found(points.select(at).select("_p.*"), index, rows_per_task, max_hot_cells, broadcast_limit)
    if in_steps:
        return _joined_in_steps(rows, written(found)[0], out)
    spread = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flat = [c for c, t in points.dtypes if "map<" not in t]        # a map has no hash
    # rows that look up nothing get a salt instead of a position, so they do not pile up under NULL
    salt = F.when(F.col("_px").isNull() | F.col("_py").isNull(), F.pmod(F.xxhash64(*flat), F.lit(spread))).otherwise(F.lit(-1).cast("long"))
    rows = rows.withColumn("_salt", salt)
    found = found.select(F.col("_px").alias("_fx"), F.col("_py").alias("_fy"), F.lit(-1).cast("long").alias("_fs"), F.col("code").alias(out))
    return (rows.join(found, F.col("_px").eqNullSafe(F.col("_fx")) & F.col("_py").eqNullSafe(F.col("_fy")) & (F.col("_salt") == F.col("_fs")), "left")
            .drop("_px", "_py", "_fx", "_fy", "_salt", "_fs"))


def _joined_in_steps(rows: DataFrame, found: DataFrame, out: str) -> DataFrame:
    """``rows`` with the code ``found`` for (_px, _py); only rows that have both are shuffled."""
    # exploded from one array, so that the filters on a position stay above the rows' parsing and do not repeat it
    rows = rows.select(F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))).alias("_r")).select("_r.*")
    have = F.col("_px").isNotNull() & F.col("_py").isNotNull()
    found = found.select(F.col("_px").alias("_fx"), F.col("_py").alias("_fy"), F.col("code").alias(out))
    # merged: what the positions take packed in files says little about what they would take broadcast
    looked = rows.filter(have).join(found.hint("merge"), (F.col("_px") == F.col("_fx")) & (F.col("_py") == F.col("_fy")), "left").drop("_fx", "_fy")
    other = rows.filter(~have).withColumn(out, F.lit(None).cast("string"))
    return looked.unionByName(other).drop("_px", "_py")


def positions_found(positions: DataFrame, index: QuadIndex, rows_per_task: int, max_hot_cells: int, broadcast_limit: int = 0) -> DataFrame:
    """(_px, _py, code): the distinct positions that are in a zone. One join on the cell for all levels but those broadcast."""
    spark = positions.sparkSession
    ensure_checkpoint_dir(spark)
    deepest = max(index.depths)
    size = index.root / 4 ** deepest
    n = 4 ** deepest
    cx, cy = (F.floor((F.col(c) - F.lit(o)) / F.lit(size)) for c, o in (("_px", index.origin[0]), ("_py", index.origin[1])))
    inside_root = (~F.isnan("_px") & ~F.isnan("_py") & (F.col("_px") >= index.origin[0]) & (F.col("_px") < index.origin[0] + index.root)
                   & (F.col("_py") >= index.origin[1]) & (F.col("_py") < index.origin[1] + index.root))
    seen = positions.filter(inside_root).distinct()
    seen = seen.withColumn("_fine", cell_number(F.least(cx, F.lit(n - 1)), F.least(cy, F.lit(n - 1)), F.lit(deepest))).checkpoint()
    in_box = "_px >= minx AND _px <= maxx AND _py >= miny AND _py <= maxy"
    test = (f"aggregate(edges, par, (acc, e) -> acc + CASE WHEN {_on_edge('_px', '_py')} THEN {_ON_EDGE}L "
            f"ELSE {_crossings('e.', '_px', '_py', 'xr', 'yr')} END, acc -> acc < {_ON_EDGE}L AND acc % 2 = 1)")

    def of_depths(depths: list[int]) -> DataFrame:
        cells = F.array(*[F.shiftright("_fine", 4 * (deepest - d)) for d in depths])
        return seen.select("_px", "_py", F.explode(cells).alias("_cell"))

    def inside(met: DataFrame) -> DataFrame:
        return met.filter(F.expr(in_box)).filter(F.expr(test)).select("_px", "_py", "fid", "code")

    small, left = [], broadcast_limit
    for d in sorted(index.depths, key=lambda d: index.sizes[d]):
        left -= index.sizes[d]
        if left < 0:
            break
        small.append(d)
    large = [d for d in index.depths if d not in small]
    met = []
    if small:
        few = index.pairs.filter(F.col("depth").isin(small)).drop("depth")
        met.append(inside(of_depths(small).join(F.broadcast(few), F.col("_cell") == F.col("cell"))))
    if large:
        dealt = of_depths(large)
        # only cells with zones; those of many positions get salts: at most max_hot_cells, so their table may be broadcast
        counts = dealt.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).checkpoint()
        total = counts.agg(F.sum("n")).first()[0] or 0
        limit = max(int(rows_per_task), -(-int(total) // int(max_hot_cells)))
        hot = counts.filter(F.col("n") > limit).select(F.col("_cell").alias("_h"), F.ceil(F.col("n") / limit).cast("int").alias("_f"))
        salts = F.coalesce("_f", F.lit(1))
        dealt = (dealt.join(F.broadcast(hot), F.col("_cell") == F.col("_h"), "left")
                 .select("_px", "_py", "_cell", F.pmod(F.xxhash64("_px", "_py"), salts).cast("int").alias("_s")))
        pairs = index.pairs.filter(F.col("depth").isin(large)).drop("depth")
        pairs = (pairs.join(F.broadcast(hot), F.col("cell") == F.col("_h"), "left")
                 .withColumn("_t", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_h", "_f"))
        met.append(inside(dealt.join(pairs, (F.col("_cell") == F.col("cell")) & (F.col("_s") == F.col("_t")))))
    all_met = met[0] if len(met) == 1 else met[0].unionByName(met[1])
    return all_met.groupBy("_px", "_py").agg(F.min(F.struct("fid", "code")).alias("z")).select("_px", "_py", "z.code")
