"""DuckDB SQL for every registered query: an independent statement of the semantics.

Written in DuckDB's dialect (RE2 regexes, TRY_CAST) rather than derived from
the Spark code. Two rules make the values equal to the last bit:
* means are computed exactly in integer units and rounded half away from zero
  (DuckDB's ``avg`` of a decimal returns a double);
* medians are ``quantile_disc`` (the lower middle value), the value Spark's
  ``percentile_approx`` returns for groups this small.
"""

from __future__ import annotations

from ..sources import demo

STAYS = demo.sql_select(demo.STAYS, "lineitem")
LETS = demo.sql_select(demo.LETS, "orders")
ZONES = demo.zones_sql()


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def pc4(x: str) -> str:
    return rf"NULLIF(regexp_extract({x}, '^\s*([1-9][0-9]{{3}})', 1), '')"


def rent_amount(x: str) -> str:
    no_euro = strip(f"replace({x}, '€', '')")
    inner = strip(rf"regexp_replace({no_euro}, '\s*,-[^\n]*', '', 'g')")
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE TRY_CAST(replace({inner}, '.', '') AS DOUBLE) END"


def utilities(x: str) -> str:
    return f"coalesce(contains(lower({x}), 'utilities incl'), false)"


def area(x: str) -> str:
    return rf"TRY_CAST(NULLIF(regexp_extract({x}, '([0-9]+(\.[0-9]+)?)', 1), '') AS DOUBLE)"


def capacity(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({x}, '([0-9]+)', 1), '') AS INTEGER)"


def deposit(x: str) -> str:
    t = strip(f"replace({x}, '€', '')")
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL "
            f"ELSE TRY_CAST(replace(replace({t}, '.', ''), ',', '.') AS DOUBLE) END")


def to_int(x: str) -> str:
    """Spark's try_cast to INT takes only an integer literal (DuckDB would round '2.0')."""
    return rf"CASE WHEN regexp_matches({x}, '^\s*[+-]?[0-9]+\s*$') THEN TRY_CAST({x} AS INTEGER) END"


def mean(x: str, scale: int, digits: int) -> str:
    """Exact mean of a DECIMAL(.., scale) expression, rounded half away from zero."""
    t = f"SUM(CAST(({x}) * {10 ** scale} AS HUGEINT))"
    n = f"COUNT({x})"
    num = f"({t} * {10 ** max(0, digits - scale)})"
    d = f"({10 ** max(0, scale - digits)} * {n})"
    units = f"sign({num}) * ((2 * abs({num}) + {d}) // (2 * {d}))"
    return f"CASE WHEN {n} = 0 THEN NULL ELSE CAST({units} AS DOUBLE) / {10 ** digits} END"


def median(x: str) -> str:
    return f"CAST(round(quantile_disc({x}, 0.5), 2) AS DOUBLE)"


INSIDE = (
    "c.longitude > z.x0 AND c.longitude < z.x0 + z.s AND c.latitude > z.y0 AND c.latitude < z.y0 + z.s "
    "AND NOT (z.tri AND (c.longitude - z.x0) + (c.latitude - z.y0) >= z.s) "
    f"AND NOT (z.hole AND c.longitude >= z.x0 + {demo.HOLE_LO} AND c.longitude <= z.x0 + {demo.HOLE_HI} "
    f"AND c.latitude >= z.y0 + {demo.HOLE_LO} AND c.latitude <= z.y0 + {demo.HOLE_HI})"
)

CLEAN_STAYS = f"""
s AS ({STAYS}),
c AS (
  SELECT listing_id, line_no, zipcode,
    TRY_CAST(price AS DOUBLE) AS price,
    TRY_CAST(bedrooms AS DOUBLE) AS bedrooms,
    {to_int('accommodates')} AS accommodates,
    TRY_CAST(latitude AS DOUBLE) AS latitude,
    TRY_CAST(longitude AS DOUBLE) AS longitude,
    TRY_CAST(review_scores_value AS DOUBLE) AS review_scores_value,
    trim(room_type) AS room_type,
    {pc4('zipcode')} AS pc4,
    coalesce(TRY_CAST(price AS DOUBLE) < 10 OR TRY_CAST(price AS DOUBLE) > 2000, true) AS is_price_outlier
  FROM s
  WHERE (TRY_CAST(latitude AS DOUBLE) IS NOT NULL OR TRY_CAST(longitude AS DOUBLE) IS NOT NULL)
    AND TRY_CAST(price AS DOUBLE) IS NOT NULL),
z AS ({ZONES})"""

SILVER_STAYS = f"""
{CLEAN_STAYS},
b AS (
  SELECT c.*, CASE WHEN c.pc4 IS NULL AND c.latitude IS NOT NULL AND c.longitude IS NOT NULL THEN
      (SELECT arg_min(z.code, z.fid) FROM z WHERE {INSIDE}) END AS lookup
  FROM c),
ss AS (
  SELECT listing_id, line_no, zipcode, price, bedrooms, accommodates, latitude, longitude,
    review_scores_value, room_type, coalesce(pc4, lookup) AS pc4, is_price_outlier,
    (pc4 IS NULL AND lookup IS NOT NULL) AS pc4_backfilled
  FROM b)"""

SILVER_LETS = f"""
l AS ({LETS}),
sl AS (
  SELECT _id, {pc4('postalCode')} AS pc4, postalCode,
    TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
    {rent_amount('rent')} AS rent_amount, {utilities('rent')} AS utilities_included,
    {deposit('deposit')} AS deposit_amount, propertyType, {area('areaSqm')} AS area_sqm,
    {capacity('matchCapacity')} AS capacity, furnish,
    ({rent_amount('rent')} < 100 OR {rent_amount('rent')} > 5000) AS is_rent_outlier,
    strftime(TRY_CAST(firstSeenAt AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS first_seen_at,
    strftime(TRY_CAST(lastSeenAt AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS last_seen_at,
    'orders' AS _source, '2024-05-01 00:00:00' AS _ingested_at
  FROM l
  WHERE lower(city) = 'amsterdam' AND {rent_amount('rent')} IS NOT NULL)"""

STAY_REV = """
sr AS (
  SELECT listing_id, line_no, pc4, price, review_scores_value,
    CAST(price AS DECIMAL(18,2)) AS p,
    CAST(price AS DECIMAL(18,2)) * 255.50 AS gross,
    CAST(price AS DECIMAL(18,2)) * 255.50 * 0.03 AS fees,
    2555.000000 AS cleaning,
    CAST(price AS DECIMAL(18,2)) * 255.50 - CAST(price AS DECIMAL(18,2)) * 255.50 * 0.03 - 2555.000000 AS net
  FROM ss WHERE is_price_outlier = false)"""

LET_REV = """
lr AS (
  SELECT _id, pc4, rent_amount, area_sqm,
    CAST(rent_amount AS DECIMAL(18,2)) AS r,
    CAST(rent_amount AS DECIMAL(18,2)) * 11 AS gross,
    CAST(rent_amount AS DECIMAL(18,2)) * 11 * 0.10 AS maint,
    CAST(rent_amount AS DECIMAL(18,2)) * 11 - CAST(rent_amount AS DECIMAL(18,2)) * 11 * 0.10 AS net
  FROM sl WHERE is_rent_outlier = false)"""

AREA_STAYS = f"""
ast AS (
  SELECT pc4,
    COUNT(price) AS airbnb_listing_count,
    {mean('CAST(p AS DECIMAL(18,3))', 3, 2)} AS airbnb_avg_nightly_price,
    {median('p')} AS airbnb_median_nightly_price,
    {mean('CAST(net AS DECIMAL(24,6))', 6, 2)} AS airbnb_avg_annual_net_revenue,
    {median('CAST(net AS DECIMAL(24,6))')} AS airbnb_median_annual_net_revenue,
    {mean('CAST(review_scores_value AS DECIMAL(20,12))', 12, 2)} AS airbnb_avg_review_score
  FROM sr GROUP BY pc4)"""

AREA_LETS = f"""
al AS (
  SELECT pc4,
    COUNT(rent_amount) AS kamernet_listing_count,
    {mean('CAST(r AS DECIMAL(18,3))', 3, 2)} AS kamernet_avg_monthly_rent,
    {median('r')} AS kamernet_median_monthly_rent,
    {mean('CAST(net AS DECIMAL(24,6))', 6, 2)} AS kamernet_avg_annual_net_revenue,
    {median('CAST(net AS DECIMAL(24,6))')} AS kamernet_median_annual_net_revenue,
    {mean('CAST(area_sqm AS DECIMAL(20,12))', 12, 2)} AS kamernet_avg_area_sqm
  FROM lr GROUP BY pc4)"""

GOLD = f"""
{SILVER_STAYS}, {SILVER_LETS}, {STAY_REV}, {LET_REV}, {AREA_STAYS}, {AREA_LETS},
j AS (SELECT * FROM ast FULL OUTER JOIN al USING (pc4)),
g AS (
  SELECT j.*,
    round(airbnb_median_annual_net_revenue - kamernet_median_annual_net_revenue, 2) AS revenue_advantage,
    CASE WHEN airbnb_median_annual_net_revenue IS NULL THEN 'Kamernet (no Airbnb data)'
         WHEN kamernet_median_annual_net_revenue IS NULL THEN 'Airbnb (no Kamernet data)'
         WHEN round(airbnb_median_annual_net_revenue - kamernet_median_annual_net_revenue, 2) > 0 THEN 'Airbnb'
         ELSE 'Kamernet' END AS recommended_strategy
  FROM j)"""


# Other assumptions and bounds than the defaults: 0.55 occupied, 0.08 fee, 21.5 per turnover of 2.5
# nights, 9 months, 0.125 maintenance; prices 20 to 900, rents 300 to 2,500.
STAY_REV_2 = """
sr AS (
  SELECT listing_id, line_no, pc4, price, review_scores_value,
    CAST(price AS DECIMAL(18,2)) AS p,
    CAST(price AS DECIMAL(18,2)) * 200.75 - CAST(price AS DECIMAL(18,2)) * 200.75 * 0.08 - 1726.450000 AS net
  FROM ss WHERE price >= 20 AND price <= 900)"""

LET_REV_2 = """
lr AS (
  SELECT _id, pc4, rent_amount, area_sqm,
    CAST(rent_amount AS DECIMAL(18,2)) AS r,
    CAST(rent_amount AS DECIMAL(18,2)) * 9 - CAST(rent_amount AS DECIMAL(18,2)) * 9 * 0.125 AS net
  FROM sl WHERE rent_amount >= 300 AND rent_amount <= 2500)"""

GOLD_2 = GOLD.replace(STAY_REV, STAY_REV_2).replace(LET_REV, LET_REV_2)


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST((({part}) * 2000 + {whole}) // (2 * {whole}) AS DOUBLE) / 10.0 END"


def _missing() -> str:
    cols = ["zipcode", "bedrooms", "review_scores_value"]
    parts = [f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL OR {c} = '') AS missing, "
             f"COUNT(*) AS total FROM s" for c in cols]
    body = " UNION ALL ".join(parts)
    return f"WITH s AS ({STAYS}), m AS ({body}) SELECT \"column\", missing, total, {_pct('missing', 'total')} AS pct FROM m"


def _schema(cols: list[tuple[str, str]], view: str) -> str:
    """Per column: the type that holds all cells, found from which kinds of cells there are."""
    parts = []
    for i, (name, _) in enumerate(cols):
        c = f'CAST("{name}" AS VARCHAR)'
        kind = (f"CASE WHEN {c} IS NULL OR {c} = '' THEN NULL WHEN regexp_full_match({c}, '[+-]?[0-9]{{1,18}}') THEN 'bigint' "
                f"WHEN regexp_full_match({c}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]{{1,2}})?') THEN 'double' "
                f"WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\\.[0-9]{{1,6}})?)?)?') "
                f"AND TRY_CAST({c} AS TIMESTAMP) IS NOT NULL THEN 'timestamp' ELSE 'string' END")
        parts.append(f"SELECT {i} AS position, '{name}' AS \"column\", {kind} AS kind FROM v")
    return f"""WITH v AS ({view}), k AS ({' UNION ALL '.join(parts)})
SELECT position, "column",
  CASE WHEN COUNT(kind) = 0 THEN 'void'
       WHEN bool_or(kind = 'string') OR (bool_or(kind = 'timestamp') AND bool_or(kind IN ('bigint', 'double'))) THEN 'string'
       WHEN bool_or(kind = 'timestamp') THEN 'timestamp' WHEN bool_or(kind = 'double') THEN 'double' ELSE 'bigint' END AS type,
  COUNT(kind) AS non_null, COUNT(*) - COUNT(kind) AS nulls
FROM k GROUP BY position, "column\""""


def _columns() -> str:
    parts = [f"""SELECT '{c}' AS "column", COUNT(v) AS count, {mean('CAST(v AS DECIMAL(18,4))', 4, 4)} AS mean, round(stddev_samp(v), 4) AS stddev,
        MIN(v) AS min, round(quantile_cont(v, 0.25), 4) AS q25, round(quantile_cont(v, 0.5), 4) AS q50, round(quantile_cont(v, 0.75), 4) AS q75, MAX(v) AS max
        FROM (SELECT TRY_CAST({c} AS DOUBLE) AS v FROM s)""" for c in ("price", "bedrooms", "review_scores_value", "latitude")]
    return f"WITH s AS ({STAYS}) " + " UNION ALL ".join(parts)


def _formats() -> str:
    formats = {
        "four_digits": r"^[0-9]{4}$",
        "six_chars_no_space": r"^[0-9]{4}[A-Za-z]{2}$",
        "with_space": r"^[0-9]{4}\s[A-Za-z]{2}$",
    }
    parts = [f"SELECT '{name}' AS format, COUNT(*) FILTER (WHERE regexp_matches(zipcode, '{rx}')) AS matching, "
             f"COUNT(*) AS non_null FROM s WHERE zipcode IS NOT NULL" for name, rx in formats.items()]
    return f"WITH s AS ({STAYS}) " + " UNION ALL ".join(parts)


def _issues() -> str:
    return f"""
WITH s AS ({STAYS}), l AS ({LETS}),
e AS (SELECT event_id FROM events)
SELECT 'missing_postal_codes' AS issue, 'listings' AS dataset,
  COUNT(*) FILTER (WHERE zipcode IS NULL OR zipcode = '') AS count FROM s
UNION ALL SELECT 'non_standard_postal_formats', 'listings',
  COUNT(*) FILTER (WHERE NOT (zipcode IS NULL OR zipcode = '') AND NOT regexp_matches(zipcode, '^[0-9]{{4}}$')) FROM s
UNION ALL SELECT 'price_outliers', 'listings',
  COUNT(*) FILTER (WHERE TRY_CAST(price AS DOUBLE) < 10 OR TRY_CAST(price AS DOUBLE) > 2000) FROM s
UNION ALL SELECT 'missing_bedrooms', 'listings',
  COUNT(*) FILTER (WHERE bedrooms IS NULL OR bedrooms = '') FROM s
UNION ALL SELECT 'missing_review_scores', 'listings',
  COUNT(*) FILTER (WHERE review_scores_value IS NULL OR review_scores_value = '') FROM s
UNION ALL SELECT 'other_city_records', 'rentals',
  COUNT(*) FILTER (WHERE NOT coalesce(lower(city) = 'amsterdam', false)) FROM l
UNION ALL SELECT 'rent_text_needs_parsing', 'rentals',
  COUNT(*) FILTER (WHERE lower(city) = 'amsterdam' AND rent IS NOT NULL AND NOT regexp_matches(rent, '^[0-9]+$')) FROM l
UNION ALL SELECT 'utilities_included', 'rentals',
  COUNT(*) FILTER (WHERE lower(city) = 'amsterdam' AND {utilities('rent')}) FROM l
UNION ALL SELECT 'single_element_arrays', 'rentals',
  COUNT(*) FILTER (WHERE event_id % 3 = 0) FROM e"""


SQL: dict[str, str] = {
    "rent_amount": f"WITH l AS ({LETS}) SELECT _id, rent, {rent_amount('rent')} AS rent_amount FROM l",
    "rent_utilities": f"WITH l AS ({LETS}) SELECT _id, rent, {utilities('rent')} AS utilities_included FROM l",
    "postal_pc4": f"WITH s AS ({STAYS}) SELECT listing_id, line_no, zipcode, {pc4('zipcode')} AS pc4 FROM s",
    "area_sqm": f"WITH l AS ({LETS}) SELECT _id, areaSqm, {area('areaSqm')} AS area_sqm FROM l",
    "capacity": f"WITH l AS ({LETS}) SELECT _id, matchCapacity, {capacity('matchCapacity')} AS capacity FROM l",
    "deposit_amount": f"WITH l AS ({LETS}) SELECT _id, deposit, {deposit('deposit')} AS deposit_amount FROM l",
    "price_outlier": f"""WITH s AS ({STAYS}) SELECT listing_id, line_no, TRY_CAST(price AS DOUBLE) AS price,
        coalesce(TRY_CAST(price AS DOUBLE) < 10 OR TRY_CAST(price AS DOUBLE) > 2000, true) AS is_price_outlier
        FROM s""",
    "silver_stays": f"WITH {SILVER_STAYS} SELECT * FROM ss",
    "silver_lets": f"WITH {SILVER_LETS} SELECT * FROM sl",
    "spatial_backfill": f"""WITH {CLEAN_STAYS}
        SELECT listing_id, line_no, longitude, latitude,
          (SELECT arg_min(z.code, z.fid) FROM z WHERE {INSIDE}) AS zone_code
        FROM c WHERE pc4 IS NULL AND latitude IS NOT NULL AND longitude IS NOT NULL""",
    "spatial_backfill_salted": f"""WITH {CLEAN_STAYS}
        SELECT listing_id, line_no, longitude, latitude,
          (SELECT arg_min(z.code, z.fid) FROM z WHERE {INSIDE}) AS zone_code
        FROM c WHERE pc4 IS NULL AND latitude IS NOT NULL AND longitude IS NOT NULL""",
    "spatial_backfill_edges": f"""WITH {CLEAN_STAYS}
        SELECT listing_id, line_no, longitude, latitude,
          (SELECT arg_min(z.code, z.fid) FROM z WHERE {INSIDE}) AS zone_code
        FROM c WHERE pc4 IS NULL AND latitude IS NOT NULL AND longitude IS NOT NULL""",
    "backfill_flag_counts": f"""WITH {SILVER_STAYS}
        SELECT pc4, pc4_backfilled, COUNT(*) AS listings FROM ss GROUP BY pc4, pc4_backfilled""",
    "zones_parsed": f"""WITH z AS ({ZONES})
        SELECT fid, code, CASE WHEN hole THEN 2 ELSE 1 END AS rings,
               CASE WHEN hole THEN 10 WHEN tri THEN 4 ELSE 5 END AS positions FROM z""",
    "stay_revenue": f"""WITH {SILVER_STAYS}, {STAY_REV}
        SELECT listing_id, line_no, pc4, price, CAST(gross AS DOUBLE) AS annual_gross_revenue,
          CAST(fees AS DOUBLE) AS annual_service_fees, CAST(cleaning AS DOUBLE) AS annual_cleaning_costs,
          CAST(net AS DOUBLE) AS annual_net_revenue FROM sr""",
    "let_revenue": f"""WITH {SILVER_LETS}, {LET_REV}
        SELECT _id, pc4, rent_amount, CAST(gross AS DOUBLE) AS annual_gross_revenue,
          CAST(maint AS DOUBLE) AS annual_maintenance_costs, CAST(net AS DOUBLE) AS annual_net_revenue FROM lr""",
    "area_stays": f"WITH {SILVER_STAYS}, {STAY_REV}, {AREA_STAYS} SELECT * FROM ast",
    "area_lets": f"WITH {SILVER_LETS}, {LET_REV}, {AREA_LETS} SELECT * FROM al",
    "gold_compare": f"WITH {GOLD} SELECT * FROM g",
    "gold_compare_approx": f"WITH {GOLD} SELECT * FROM g",
    "gold_other_parameters": f"WITH {GOLD_2} SELECT * FROM g",
    "profile_schema": _schema(demo.STAYS, STAYS),
    "profile_schema_lets": _schema(demo.LETS, LETS),
    "profile_columns": _columns(),
    "area_stays_unbounded": f"WITH {SILVER_STAYS}, {STAY_REV.replace('WHERE is_price_outlier = false', '')}, {AREA_STAYS} SELECT * FROM ast",
    "gold_top10": f"""WITH {GOLD}
        SELECT pc4, airbnb_listing_count, kamernet_listing_count, airbnb_median_annual_net_revenue,
          kamernet_median_annual_net_revenue, revenue_advantage, recommended_strategy
        FROM g WHERE revenue_advantage IS NOT NULL
        ORDER BY revenue_advantage DESC, pc4 ASC NULLS LAST LIMIT 10""",
    "strategy_counts": f"""WITH {GOLD}
        SELECT recommended_strategy, COUNT(*) AS count FROM g GROUP BY recommended_strategy""",
    "profile_shape": f"WITH s AS ({STAYS}) SELECT COUNT(*) AS rows, {len(demo.STAYS)} AS cols FROM s",
    "profile_missing": _missing(),
    "profile_formats": _formats(),
    "profile_frequency": f"WITH s AS ({STAYS}) SELECT room_type, COUNT(*) AS count FROM s GROUP BY room_type",
    "city_frequency": f"""WITH l AS ({LETS}) SELECT city, COUNT(*) AS count FROM l GROUP BY city
        ORDER BY count DESC, city ASC NULLS FIRST LIMIT 10""",
    "zipcode_top": f"""WITH s AS ({STAYS}) SELECT zipcode, COUNT(*) AS count FROM s GROUP BY zipcode
        ORDER BY count DESC, zipcode ASC NULLS FIRST LIMIT 20""",
    "price_top": f"""WITH s AS ({STAYS}) SELECT price, COUNT(*) AS count FROM s GROUP BY price
        ORDER BY count DESC, price ASC NULLS FIRST LIMIT 15""",
    "property_frequency": f"""WITH l AS ({LETS}) SELECT propertyType, COUNT(*) AS count FROM l
        WHERE lower(city) = 'amsterdam' GROUP BY propertyType""",
    "profile_summary": f"""WITH s AS ({STAYS}), x AS (SELECT TRY_CAST(price AS DOUBLE) AS v FROM s)
        SELECT COUNT(v) AS count, {mean('CAST(v AS DECIMAL(18,2))', 2, 4)} AS mean,
          round(stddev_samp(v), 4) AS stddev, MIN(v) AS min,
          round(quantile_cont(v, 0.25), 4) AS q25, round(quantile_cont(v, 0.5), 4) AS q50, round(quantile_cont(v, 0.75), 4) AS q75, MAX(v) AS max,
          COUNT(*) FILTER (WHERE v > 2000) AS above_bound FROM x""",
    "issue_report": _issues(),
    "unwrap_singletons": """SELECT event_id, CAST(event_id AS VARCHAR) AS _id,
        CASE WHEN event_id % 3 = 0 THEN props END AS crawledAt, event_type AS firstSeenAt FROM events""",
}


# ---- raw files: the same rows as the views they were written from ------------------

def _audit() -> str:
    """Counts taken with the bronze and silver tables."""
    return f"""WITH {SILVER_STAYS}, {SILVER_LETS}
SELECT 'bronze_listings' AS step, 'rows' AS metric, COUNT(*) AS value FROM s
UNION ALL SELECT 'bronze_rentals', 'rows', COUNT(*) FROM l
UNION ALL SELECT 'silver_listings', 'rows', COUNT(*) FROM ss
UNION ALL SELECT 'silver_listings', 'missing_pc4', COUNT(*) FILTER (WHERE pc4 IS NULL) FROM ss
UNION ALL SELECT 'silver_listings', 'backfilled', COUNT(*) FILTER (WHERE pc4_backfilled) FROM ss
UNION ALL SELECT 'silver_listings', 'price_outliers', COUNT(*) FILTER (WHERE is_price_outlier) FROM ss
UNION ALL SELECT 'silver_rentals', 'rows', COUNT(*) FROM sl
UNION ALL SELECT 'silver_rentals', 'rent_outliers', COUNT(*) FILTER (WHERE is_rent_outlier) FROM sl
UNION ALL SELECT 'silver_rentals', 'utilities_included', COUNT(*) FILTER (WHERE utilities_included) FROM sl"""


def _verify() -> str:
    tables = {"bronze_listings": "s", "bronze_rentals": "l", "silver_listings": "ss", "silver_rentals": "sl", "gold": "g"}
    return f"WITH {GOLD} " + " UNION ALL ".join(
        f"SELECT '{step}' AS step, COUNT(*) AS rows_written, COUNT(*) AS rows_read, true AS same FROM {t}" for step, t in tables.items())


_LAT, _LON, _PRICE = (f"TRY_CAST({c} AS DOUBLE)" for c in ("latitude", "longitude", "price"))

SQL |= {
    "file_listings": f"WITH s AS ({STAYS}) SELECT CAST(listing_id AS VARCHAR) AS listing_id, CAST(line_no AS VARCHAR) AS line_no, NULLIF(zipcode, '') AS zipcode, price, latitude FROM s",
    "file_listings_inferred": f"WITH s AS ({STAYS}) SELECT listing_id, line_no, price, CAST(bedrooms AS INTEGER) AS bedrooms, CAST(longitude AS DOUBLE) AS longitude FROM s",
    "file_rentals": f"WITH l AS ({LETS}) SELECT _id, city, rent, \"areaSqm\", deposit, \"firstSeenAt\" FROM l",
    "file_zones": f"""WITH z AS ({ZONES})
        SELECT code, CASE WHEN hole THEN 2 ELSE 1 END AS rings, CASE WHEN hole THEN 10 WHEN tri THEN 4 ELSE 5 END AS positions FROM z""",
    "file_bronze": f"""WITH l AS ({LETS}) SELECT _id, city, "postalCode", 'kamernet' AS _source, 'rentals.json' AS _source_file, true AS stamped FROM l""",
    "file_gold": f"WITH {GOLD} SELECT * FROM g",
    "file_replay": f"WITH {GOLD} SELECT * FROM g",
    "file_verify": _verify(),
    "file_refresh": f"""WITH l AS ({LETS}), c AS (SELECT COUNT(DISTINCT coalesce('city ' || lower(city), 'none')) AS n FROM l),
  r(refresh, first) AS (VALUES ('first', true), ('unchanged', false), ('one city', false)),
  t(step) AS (VALUES ('bronze_listings'), ('bronze_rentals'), ('silver_listings'), ('silver_rentals'), ('gold'))
SELECT refresh, step, CASE WHEN first THEN parts WHEN refresh = 'one city' AND step = 'bronze_rentals' THEN 1 ELSE 0 END AS partitions_written,
  parts - CASE WHEN first THEN parts WHEN refresh = 'one city' AND step = 'bronze_rentals' THEN 1 ELSE 0 END AS partitions_kept
FROM r, (SELECT step, CASE WHEN step = 'bronze_rentals' THEN n ELSE 1 END AS parts FROM t, c)""",
    "file_reconcile": f"""WITH {SILVER_STAYS}, {SILVER_LETS}
SELECT 'listings' AS source, (SELECT COUNT(*) FROM s) AS bronze, 'no position' AS first_reason,
  (SELECT COUNT(*) FROM s WHERE {_LAT} IS NULL AND {_LON} IS NULL) AS first, 'no price' AS second_reason,
  (SELECT COUNT(*) FROM s WHERE NOT ({_LAT} IS NULL AND {_LON} IS NULL) AND {_PRICE} IS NULL) AS second, (SELECT COUNT(*) FROM ss) AS silver, true AS balanced
UNION ALL SELECT 'rentals', (SELECT COUNT(*) FROM l), 'other city', (SELECT COUNT(*) FROM l WHERE NOT coalesce(lower(city) = 'amsterdam', false)), 'no rent',
  (SELECT COUNT(*) FROM l WHERE lower(city) = 'amsterdam' AND {rent_amount('rent')} IS NULL), (SELECT COUNT(*) FROM sl), true""",
    "preview_lets": f"WITH l AS ({LETS}) SELECT _id, city, rent FROM l ORDER BY _id LIMIT 5",
}
SQL["file_audit"] = _audit()
