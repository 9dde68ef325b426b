"""Not-modified revisits of a web archive: as-of join to the latest earlier full response.

A revisit record says that a server answered "not modified": it has headers but no payload. It is
resolved to the latest full response of the same canonical URL that was captured before it. The
validators of both are compared, and the headers a not-modified answer may update are merged into
those of the response.

The as-of join is cut by time: boundaries of about equal numbers of records are taken from the
records' quantiles, and the latest response is sought within (URL, time slice); where a slice has
none before the revisit, the last one of the URL's earlier slices is carried in. So a URL with a
third of all records is spread over the slices, and what is carried is a row per URL and slice.

Canonical URL: no scheme, user, fragment, default port or leading "www."; host in lower case; no
closing "/" of the path; query parameters sorted, without empty and tracking ones.

Outcomes: ``resolved`` (ETags are weakly equal, or without two ETags Last-Modified is equal),
``etag-mismatch``, ``date-mismatch``, ``no-validator`` (nothing to compare), ``no-response`` (none
earlier), ``response`` for full responses themselves. Headers are merged where the outcome is
``resolved``; elsewhere they stay the record's own.

Defined results: a null or empty URL has no canonical form and matches nothing; a record without
time is earlier than none and later than none; ties of time are ordered by record id, the response with the
greatest (time, id) below the revisit's wins; repeated records are resolved each; null headers count
as none; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentyield.llm.tables import durable

SLICE_ROWS = 20_000
MAX_SLICES = 10_000
#: Header fields that a not-modified answer carries for the stored response, in lower case.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]
#: Fixed value: query parameters that only track.
TRACKING = r"^(utm_[a-z_]+|ref|fbclid|gclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/+$", "")
    query = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    query = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", whole)


def _slices(records: DataFrame, rows: int) -> Column:
    """Number of the time slice; boundaries are quantiles, at most ``MAX_SLICES`` numbers."""
    n = min(MAX_SLICES, max(1, records.count() // rows))
    if n == 1:
        return F.lit(0)
    return cuts_up_to(sorted(set(records.approxQuantile("ts", [i / n for i in range(1, n)], 0.1 / n))), F.col("ts"))


def cuts_up_to(cuts: list[float], value: Column) -> Column:
    """How many of the sorted cuts the value reaches: first among every ``step``-th cut, then in the ``step`` cuts from there."""
    if not cuts:
        return F.lit(0)
    step = isqrt(len(cuts))
    base = F.greatest(F.size(F.filter(F.lit(np.array(cuts[::step], float)), lambda c: c <= value)) - 1, F.lit(0)) * step
    return base + F.size(F.filter(F.slice(F.lit(np.array(cuts, float)), base + 1, F.lit(step)), lambda c: c <= value))


def latest_earlier(records: DataFrame, rows: int = SLICE_ROWS) -> DataFrame:
    """(record_id, refers_to) of the revisits: the latest response of the URL before each, or null.

    ``records``: record_id (of any type with an order), url_key, ts, full (boolean).
    """
    sliced = records.withColumn("slice", _slices(records, rows))
    response = F.when(F.col("full"), F.struct("ts", "record_id"))
    inside = Window.partitionBy("url_key", "slice").orderBy("ts", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    found = sliced.withColumn("here", F.last(response, ignorenulls=True).over(inside)).filter(~F.col("full"))
    last = sliced.groupBy("url_key", "slice").agg(F.max(response).alias("last"))
    before = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(F.col("url_key").alias("_url"), F.col("slice").alias("_slice"), F.last("last", ignorenulls=True).over(before).alias("carried"))
    joined = found.join(carried, (F.col("url_key") == F.col("_url")) & (F.col("slice") == F.col("_slice")), "left")
    return joined.select("record_id", F.coalesce("here.record_id", "carried.record_id").alias("refers_to"))


def _header(headers: str, name: str) -> Column:
    return F.element_at(headers, name)


def _weak(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve(records: DataFrame, rows: int = SLICE_ROWS) -> DataFrame:
    """One row per record: record_id, canonical_url, outcome, refers_to, headers (merged, keys in lower case).

    ``records``: record_id long, url string, ts (a number), revisit boolean, headers map<string,string>.
    """
    lower = F.coalesce(F.transform_keys("headers", lambda k, v: F.lower(k)), F.create_map().cast("map<string,string>"))
    records = records.select("record_id", canonical_url(F.col("url")).alias("canonical_url"), F.col("ts").cast("double").alias("ts"),
                             F.coalesce("revisit", F.lit(False)).alias("revisit"), lower.alias("headers"))
    # records are told apart by number: an id may be used several times, at several URLs
    records = durable(records.withColumn("_n", F.monotonically_increasing_id()))
    timed = records.filter("canonical_url IS NOT NULL AND ts IS NOT NULL AND record_id IS NOT NULL")
    timed = timed.select(F.struct("record_id", "_n").alias("record_id"), F.col("canonical_url").alias("url_key"), "ts", (~F.col("revisit")).alias("full"))
    earlier = latest_earlier(timed, rows).filter("refers_to IS NOT NULL").select(
        F.col("record_id._n").alias("_id"), F.col("refers_to.record_id").alias("refers_to"), F.col("refers_to._n").alias("_to"))
    stored = records.filter("NOT revisit").select(F.col("_n").alias("_stored"), F.col("headers").alias("stored"))
    # a table of its own: Spark splits a response with very many revisits in a join of two plain shuffles
    stored = durable(stored)
    joined = (records.join(earlier, F.col("_n") == F.col("_id"), "left")
              .join(stored, F.col("_to") == F.col("_stored"), "left"))
    tags = _weak(_header("headers", "etag")), _weak(_header("stored", "etag"))
    dates = _header("headers", "last-modified"), _header("stored", "last-modified")
    outcome = (F.when(~F.col("revisit"), "response").when(F.col("refers_to").isNull(), "no-response")
               .when(tags[0] == tags[1], "resolved").when(tags[0] != tags[1], "etag-mismatch")
               .when(dates[0] == dates[1], "resolved").when(dates[0] != dates[1], "date-mismatch").otherwise("no-validator"))
    joined = joined.withColumn("outcome", outcome)
    updates = F.map_filter("headers", lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    kept = F.map_filter("stored", lambda k, v: ~F.map_contains_key(updates, k))
    merged = F.when(F.col("outcome") == "resolved", F.map_concat(kept, updates)).otherwise(F.col("headers"))
    return joined.select("record_id", "canonical_url", "outcome", "refers_to", merged.alias("headers"))


def records_of_pages(pages: DataFrame) -> DataFrame:
    """Archive records derived from the ``pages`` table: for each page its capture and three that follow.

    Capture p of a page at time 10 p: a full response of its URL, with the payload's MD5 as ETag (pages
    whose id leaves 2 modulo 5 have none) and a Last-Modified. At 10 p + 3 a revisit under a variant of the URL
    (other scheme, upper-case host, tracking parameter), with a changed validator where p leaves 3
    modulo 7. At 10 p + 5 the host's front page: a full response where p leaves 0 modulo 16, else a
    revisit whose ETag follows the hundreds of p.
    """
    p = F.col("page_id")
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    tag = F.when(p % 5 != 2, F.concat(F.lit('"'), F.md5(F.coalesce(F.col("html"), F.lit("")).cast("binary")), F.lit('"')))
    date = F.concat(F.lit("day "), F.floor(p / 3).cast("string"))
    pages = pages.select(p, "url", host.alias("host"), tag.alias("tag"), date.alias("date"), F.length("html").cast("string").alias("size"))
    day = F.concat(F.lit("at "), F.col("ts").cast("string"))

    def headers(**fields: Column) -> Column:
        pairs = [F.struct(F.lit(name.replace("_", "-")).alias("k"), value.alias("v")) for name, value in fields.items()]
        return F.map_from_entries(F.filter(F.array(*pairs), lambda x: x["v"].isNotNull()))

    full = pages.withColumn("ts", 10 * p).select(
        (4 * p).alias("record_id"), "url", "ts", F.lit(False).alias("revisit"),
        headers(ETag=F.col("tag"), Last_Modified=F.col("date"), Date=day, Content_Length=F.col("size"), Server=F.lit("a")).alias("headers"))
    rest = F.regexp_extract("url", r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    variant = F.concat(F.when(p % 2 == 0, "http://WWW.").otherwise("https://"), F.upper("host"), F.when(p % 2 == 0, ":80").otherwise(""), rest,
                       F.lit("?utm_medium=x&"), query, F.lit("#part"))
    changed = p % 7 == 3
    again = pages.withColumn("ts", 10 * p + 3).select(
        (4 * p + 1).alias("record_id"), variant.alias("url"), "ts", F.lit(True).alias("revisit"),
        headers(etag=F.when(changed, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), F.col("tag"))),
                last_modified=F.when(p % 11 != 4, F.when(changed, F.lit("day -1")).otherwise(F.col("date"))), date=day, expires=day,
                content_length=F.lit("0")).alias("headers"))
    fresh = p % 16 == 0
    front = pages.withColumn("ts", 10 * p + 5).select(
        (4 * p + 2).alias("record_id"), F.concat(F.lit("https://"), F.col("host"), F.lit("/?ref=x")).alias("url"), "ts", (~fresh).alias("revisit"),
        headers(ETag=F.concat(F.lit('"'), F.floor(p / 100).cast("string"), F.lit('"')), Date=day,
                Vary=F.when(~fresh, F.lit("accept"))).alias("headers"))
    return full.unionByName(again).unionByName(front)


#: The same in DuckDB.
SQL = r"""
WITH p AS (
  SELECT page_id AS p, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host,
    CASE WHEN page_id % 5 <> 2 THEN '"' || md5(coalesce(html, '')) || '"' END AS tag,
    'day ' || CAST(CAST(floor(page_id / 3) AS BIGINT) AS VARCHAR) AS date, CAST(length(html) AS VARCHAR) AS size
  FROM pages),
r AS (
  SELECT 4 * p AS id, url, 10 * p AS ts, false AS revisit, tag AS etag, date AS lm, 'at ' || CAST(10 * p AS VARCHAR) AS d,
    size AS cl, CAST(NULL AS VARCHAR) AS ex, 'a' AS server, CAST(NULL AS VARCHAR) AS vary FROM p
  UNION ALL
  SELECT 4 * p + 1, CASE WHEN p % 2 = 0 THEN 'http://WWW.' ELSE 'https://' END || upper(host) || CASE WHEN p % 2 = 0 THEN ':80' ELSE '' END
      || regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) || '?utm_medium=x&' || regexp_extract(url, '\?([^#]*)', 1) || '#part',
    10 * p + 3, true, CASE WHEN p % 7 = 3 THEN '"other"' ELSE 'W/' || tag END,
    CASE WHEN p % 11 <> 4 THEN CASE WHEN p % 7 = 3 THEN 'day -1' ELSE date END END, 'at ' || CAST(10 * p + 3 AS VARCHAR),
    '0', 'at ' || CAST(10 * p + 3 AS VARCHAR), NULL, NULL FROM p
  UNION ALL
  SELECT 4 * p + 2, 'https://' || host || '/?ref=x', 10 * p + 5, p % 16 <> 0, '"' || CAST(CAST(floor(p / 100) AS BIGINT) AS VARCHAR) || '"', NULL,
    'at ' || CAST(10 * p + 5 AS VARCHAR), NULL, NULL, NULL, CASE WHEN p % 16 <> 0 THEN 'accept' END FROM p),
c AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)), ':(80|443)?$', ''), '^www\.', '')
      || regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '')
      || CASE WHEN len(q) > 0 THEN '?' || array_to_string(list_sort(q), '&') ELSE '' END AS canonical_url
  FROM (SELECT *, list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z_]+|ref|fbclid|gclid|sessionid)(=|$)')) AS q FROM r)),
v AS (SELECT * FROM c WHERE revisit),
f AS (SELECT * FROM c WHERE NOT revisit),
j AS (SELECT v.*, f.id AS refers_to, f.etag AS f_etag, f.lm AS f_lm, f.cl AS f_cl, f.server AS f_server
      FROM v ASOF LEFT JOIN f ON v.canonical_url = f.canonical_url AND v.ts > f.ts),
o AS (SELECT *, CASE WHEN refers_to IS NULL THEN 'no-response'
    WHEN regexp_replace(etag, '^W/', '') = regexp_replace(f_etag, '^W/', '') THEN 'resolved'
    WHEN regexp_replace(etag, '^W/', '') <> regexp_replace(f_etag, '^W/', '') THEN 'etag-mismatch'
    WHEN lm = f_lm THEN 'resolved' WHEN lm <> f_lm THEN 'date-mismatch' ELSE 'no-validator' END AS outcome FROM j)
SELECT id AS record_id, canonical_url, outcome, refers_to, coalesce(CASE WHEN outcome = 'resolved' THEN coalesce(etag, f_etag) ELSE etag END, '') AS etag,
  coalesce(CASE WHEN outcome = 'resolved' THEN f_lm ELSE lm END, '') AS last_modified, coalesce(d, '') AS date, coalesce(ex, '') AS expires,
  coalesce(CASE WHEN outcome = 'resolved' THEN f_cl ELSE cl END, '') AS content_length,
  coalesce(CASE WHEN outcome = 'resolved' THEN f_server ELSE server END, '') AS server, coalesce(vary, '') AS vary
FROM o
UNION ALL
SELECT id, canonical_url, 'response', NULL, coalesce(etag, ''), coalesce(lm, ''), d, coalesce(ex, ''), coalesce(cl, ''), coalesce(server, ''), coalesce(vary, '')
FROM f
"""
FIELDS = ["etag", "last-modified", "date", "expires", "content-length", "server", "vary"]


def resolved_pages(pages: DataFrame) -> DataFrame:
    """Records of ``pages``, resolved; the merged headers as columns ('' for none)."""
    made = resolve(records_of_pages(pages))
    return made.select("record_id", "canonical_url", "outcome", "refers_to",
                       *[F.coalesce(F.element_at("headers", f), F.lit("")).alias(f.replace("-", "_")) for f in FIELDS])
