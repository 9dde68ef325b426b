"""Driver tables shaped as the three sources (stays, lets, zones) and a singleton table.

The reference ships no data, so the test tables are shaped into its columns.
Each view is a list of (name, SQL expression) written in the dialect subset
Spark SQL and DuckDB share; Spark applies it with ``selectExpr`` (column
pruning reaches the parquet scan), the oracle wraps it in ``SELECT ... FROM``.
Rules: float division for fractions, ``floor`` then ``BIGINT`` for whole
numbers (the engines differ on double→integer casts), ``VARCHAR(n)`` casts.

stays  ← lineitem: price, mixed-format zipcode, a point inside the unit square of
         the zone of its part (or on its edge), scores, room type.
lets   ← orders: city, rent text in the '€ 1.250,-  Utilities incl.' style,
         postal code, area, capacity, deposit, seen-at text.
zones  ← every part: a unit square on a 100-wide grid (every 7th with a hole, some broken);
         every supplier: a 2x2 square overlapping them, later in file order
         (so it only wins where no unit square contains the point), odd ones
         written as MultiPolygon; every nation: a right triangle; every region: a
         very wide square. Area codes are 1000 + key % 9000, 8000 + key, 9900 + key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .tables import spread

_PC = "CAST(1000 + l_partkey % 9000 AS VARCHAR(20))"
_RENT = "CAST(floor(o_totalprice / 100) AS BIGINT)"

STAYS = [
    ("listing_id", "l_orderkey"),
    ("line_no", "l_linenumber"),
    ("zipcode", f"""CASE l_linenumber WHEN 1 THEN {_PC}
        WHEN 2 THEN {_PC} || ' AM' WHEN 3 THEN {_PC} || 'HE'
        WHEN 5 THEN '' WHEN 6 THEN 'n/a' ELSE NULL END"""),
    ("price", """CASE WHEN l_suppkey % 50 = 1 THEN 'n/a'
        WHEN l_suppkey % 50 = 2 AND l_linenumber = 7 THEN '9000'
        ELSE CAST(CAST(floor(l_extendedprice / 400) AS BIGINT) AS VARCHAR(20))
            || '.' || lpad(CAST((l_partkey * 7 + l_linenumber) % 100 AS VARCHAR(20)), 2, '0') END"""),
    ("bedrooms", "CASE WHEN l_quantity = 48 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) % 4 AS VARCHAR(20)) END"),
    ("accommodates", "CASE WHEN l_quantity = 47 THEN '2.0' ELSE CAST(1 + CAST(l_quantity AS BIGINT) % 6 AS VARCHAR(20)) END"),
    ("latitude", """CASE WHEN l_quantity >= 49 THEN NULL ELSE CAST(
        CAST(floor(l_partkey / 100) AS BIGINT) + (l_suppkey % 8) / 8 AS VARCHAR(20)) END"""),
    ("longitude", "CASE WHEN l_quantity = 50 THEN NULL ELSE CAST(l_partkey % 100 + l_linenumber / 8 AS VARCHAR(20)) END"),
    ("review_scores_value", """CASE WHEN l_tax = 0 THEN NULL
        ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) % 10 + 1 AS VARCHAR(20))
            || '.' || lpad(CAST(l_partkey % 10000 AS VARCHAR(20)), 4, '0') END"""),
    ("room_type", """CASE l_returnflag WHEN 'A' THEN 'Entire home/apt ' WHEN 'N' THEN 'Private room'
        ELSE ' Shared room' END"""),
]

LETS = [
    ("_id", "CAST(o_orderkey AS VARCHAR(20))"),
    ("city", """CASE o_orderkey % 5 WHEN 0 THEN 'Utrecht' WHEN 1 THEN 'AMSTERDAM'
        WHEN 2 THEN ' Amsterdam' ELSE 'Amsterdam' END"""),
    ("rent", f"""CASE WHEN o_custkey % 97 = 0 THEN 'Prijs op aanvraag'
        WHEN {_RENT} >= 1000 THEN '€ ' || CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR(20))
            || '.' || lpad(CAST({_RENT} % 1000 AS VARCHAR(20)), 3, '0') || ',-  Utilities incl.'
        ELSE '€ ' || CAST({_RENT} AS VARCHAR(20)) || ',-' END"""),
    ("postalCode", "CAST(1000 + (o_custkey * 2) % 9000 AS VARCHAR(20)) || 'AB'"),
    ("areaSqm", """CASE o_orderkey % 7 WHEN 3 THEN CAST(10 + o_custkey % 40 AS VARCHAR(20)) || ',5 m2'
        WHEN 4 THEN NULL ELSE CAST(10 + o_custkey % 40 AS VARCHAR(20)) || ' m2' END"""),
    ("matchCapacity", """CASE o_orderkey % 4 WHEN 0 THEN '1 person'
        WHEN 1 THEN CAST(2 + o_custkey % 3 AS VARCHAR(20)) || ' persons' WHEN 2 THEN '> 5 persons' ELSE NULL END"""),
    ("deposit", f"""CASE o_orderkey % 3
        WHEN 0 THEN chr(10) || '  € ' || CAST(2 * {_RENT} AS VARCHAR(20)) || chr(10)
        WHEN 1 THEN '€ ' || CAST({_RENT} AS VARCHAR(20)) || ',50'
        ELSE '€ ' || CAST({_RENT} AS VARCHAR(20)) || ',-' END"""),
    ("latitude", "CAST(52 + (o_custkey % 100) / 100 AS VARCHAR(20))"),
    ("longitude", "CAST(4 + (o_orderkey % 100) / 100 AS VARCHAR(20))"),
    ("propertyType", """CASE WHEN o_orderpriority LIKE '1%' THEN 'Studio'
        WHEN o_orderpriority LIKE '2%' THEN 'Apartment' ELSE 'Room' END"""),
    ("furnish", "CASE o_orderstatus WHEN 'F' THEN 'Furnished' WHEN 'O' THEN 'Unfurnished' ELSE 'Uncarpeted' END"),
    ("firstSeenAt", "CASE WHEN o_orderkey % 11 = 0 THEN 'unknown' ELSE CAST(o_orderdate AS VARCHAR(30)) END"),
    ("lastSeenAt", "CAST(o_orderdate + INTERVAL '30' DAY AS VARCHAR(30))"),
]

# Zones: per source row a square or right triangle with legs s; the Spark view turns them into
# GeoJSON-style features, the oracle tests containment arithmetically. Broken features (a position
# that is no pair of numbers, in the outer ring or the hole) must be skipped whole.
ZONE_SOURCES = {
    "part": {
        "fid": "p_partkey", "code": "CAST(1000 + p_partkey % 9000 AS VARCHAR(20))", "name": "p_name",
        "x0": "p_partkey % 100", "y0": "CAST(floor(p_partkey / 100) AS BIGINT)", "s": "1",
        "hole": "(p_partkey % 7 = 3)", "multi": "false", "tri": "false",
        "broken": "(p_partkey % 21 = 3 OR p_partkey % 13 = 5)",
    },
    "supplier": {
        "fid": "1000000000 + s_suppkey", "code": "CAST(1000 + s_suppkey % 9000 AS VARCHAR(20))", "name": "s_name",
        "x0": "2 * (s_suppkey % 50)", "y0": "2 * CAST(floor(s_suppkey / 50) AS BIGINT)", "s": "2",
        "hole": "false", "multi": "(s_suppkey % 2 = 1)", "tri": "false", "broken": "false",
    },
    "nation": {         # slanted edges
        "fid": "2000000000 + n_nationkey", "code": "CAST(8000 + n_nationkey AS VARCHAR(20))", "name": "n_name",
        "x0": "20 * (n_nationkey % 5)", "y0": "3 * CAST(floor(n_nationkey / 5) AS BIGINT)", "s": "12",
        "hole": "false", "multi": "false", "tri": "true", "broken": "false",
    },
    "region": {         # far wider than all others
        "fid": "3000000000 + r_regionkey", "code": "CAST(9900 + r_regionkey AS VARCHAR(20))", "name": "r_name",
        "x0": "0 - 100000", "y0": "0 - 100000", "s": "(100030 + r_regionkey)",
        "hole": "false", "multi": "false", "tri": "false", "broken": "false",
    },
}
HOLE_LO, HOLE_HI = 0.375, 0.625


def _select(cols: list[tuple[str, str]]) -> list[str]:
    return [f"{expr} AS `{name}`" for name, expr in cols]


def sql_select(cols: list[tuple[str, str]], table: str) -> str:
    """The same view for DuckDB: SELECT <exprs> FROM <table>."""
    body = ",\n  ".join(f'{expr} AS "{name}"' for name, expr in cols)
    return f"SELECT\n  {body}\nFROM {table}"


def _read(spark: SparkSession, sf_dir: str, table: str, parallel_filters: bool = False) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"), parallel_filters=parallel_filters)


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short-stay listings as the CSV would arrive: every column text."""
    return _read(spark, sf_dir, "lineitem", parallel_filters=True).selectExpr(*_select(STAYS))


def lets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-term lets after the bronze unwrap: every column text."""
    return _read(spark, sf_dir, "orders", parallel_filters=True).selectExpr(*_select(LETS))


def _ring(*points: tuple[str, str]) -> str:
    """JSON text of a closed ring through the points."""
    parts = ", ',', ".join(f"'[', CAST({x} AS STRING), ',', CAST({y} AS STRING), ']'" for x, y in (*points, points[0]))
    return f"concat('[', {parts}, ']')"


def _square(x0: str, y0: str, s: str) -> str:
    return _ring((x0, y0), (f"{x0} + {s}", y0), (f"{x0} + {s}", f"{y0} + {s}"), (x0, f"{y0} + {s}"))


def zone_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fid, properties, geometry) rows, the shape ``read_features`` gives for a file."""
    square = _square("_x0", "_y0", "_s")
    triangle = _ring(("_x0", "_y0"), ("_x0 + _s", "_y0"), ("_x0", "_y0 + _s"))
    hole = _square(f"(_x0 + {HOLE_LO})", f"(_y0 + {HOLE_LO})", repr(HOLE_HI - HOLE_LO))
    outer = f"CASE WHEN _tri THEN {triangle} ELSE {square} END"
    # a broken feature: text for a number in the hole, or a position of one number in the outer ring
    bad_hole = f"regexp_replace({hole}, '\\\\[([^,\\\\[]+),', '[\"x\",')"
    bad_outer = f"concat('[[0],', substring({square}, 2))"
    polygon = (f"CASE WHEN _hole AND _broken THEN concat('[', {outer}, ',', {bad_hole}, ']') WHEN _hole THEN concat('[', {outer}, ',', {hole}, ']') "
               f"WHEN _broken THEN concat('[', {bad_outer}, ']') ELSE concat('[', {outer}, ']') END")
    parts = []
    for table, z in ZONE_SOURCES.items():
        base = _read(spark, sf_dir, table, parallel_filters=True).selectExpr(
            f"CAST({z['fid']} AS BIGINT) AS fid", f"{z['code']} AS _code", f"{z['name']} AS _name",
            f"{z['x0']} AS _x0", f"{z['y0']} AS _y0", f"{z['s']} AS _s",
            f"{z['hole']} AS _hole", f"{z['multi']} AS _multi", f"{z['tri']} AS _tri", f"{z['broken']} AS _broken")
        parts.append(base.selectExpr(
            "fid",
            "map('pc4', _code, 'name', _name) AS properties",
            f"""named_struct(
                  'type', CASE WHEN _multi THEN 'MultiPolygon' ELSE 'Polygon' END,
                  'coordinates', CASE WHEN _multi THEN concat('[', {polygon}, ']') ELSE {polygon} END)
                AS geometry"""))
    return reduce(DataFrame.unionByName, parts)


def zones_sql() -> str:
    """DuckDB: (fid, code, x0, y0, s, hole, tri) for arithmetic containment, without the broken features."""
    return " UNION ALL ".join(
        f"SELECT {z['fid']} AS fid, {z['code']} AS code, {z['x0']} AS x0, {z['y0']} AS y0, "
        f"{z['s']} AS s, {z['hole']} AS hole, {z['tri']} AS tri FROM {table} WHERE NOT ({z['broken']})"
        for table, z in ZONE_SOURCES.items())


def singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → array-valued fields: one element, empty or NULL by event_id % 3."""
    return _read(spark, sf_dir, "events").selectExpr(
        "event_id",
        "array(CAST(event_id AS STRING)) AS _id",
        """CASE event_id % 3 WHEN 0 THEN array(props) WHEN 1 THEN filter(array(props), x -> false)
           ELSE CAST(NULL AS ARRAY<STRING>) END AS crawledAt""",
        "event_type AS firstSeenAt",
    )
