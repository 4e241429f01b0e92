"""Not-modified revisits in web archives: as-of joins by canonical URL to the latest earlier full response, with validators checked and permitted headers merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


# Fields that a 304 response may update in the stored one, and query parameters that don't tell pages apart.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
TRACKING = "utm_[a-z]+|ref|fbclid|gclid|sessionid"
AUTHORITY = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
#: Captures of one URL in a time slice; sums over slices carry the latest full response into the next.
SLICE_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. or m., no scheme, default port of the scheme, fragment, tracking parameters or trailing slash; other parameters in order of their text.

    URLs without a host (`mailto:x@y`, `example.com/a`) are themselves, without their fragment; empty ones are null.
    """
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    scheme = F.lower(F.regexp_extract(plain, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    named = F.regexp_replace(F.lower(F.regexp_extract(plain, f"{AUTHORITY}([^/?]*)", 1)), "^(www|m)\\.", "")
    host = F.when(scheme == "https", F.regexp_replace(named, ":443$", "")).otherwise(F.regexp_replace(named, ":80$", ""))
    path = F.regexp_replace(F.regexp_extract(plain, f"{AUTHORITY}[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(plain, "\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?i)({TRACKING})(=|$)")))
    whole = F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(plain == "", None).when(host == "", plain).otherwise(whole)


def resolve_revisits(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """The not-modified revisits of `records` with the response that each stands for.

    records: record_id, url, ts (long seconds), kind ('response' or 'revisit'), headers (map of lower-case names). Other columns are left aside.
    Returns record_id, key (canonical URL), ts, original_id, original_ts, status and headers:
    `resolved` if the latest response with an earlier ts (ties of ts: greatest record_id) agrees with every validator (etag, last-modified) that both have, and one at least;
    `unverified` if they share none; `mismatch` if one differs; `no_original` without an earlier response. Headers are the response's, with permitted ones of the revisit
    put over them where resolved; else the revisit's own. Null and empty URLs and null ts have no original. Repeated revisits each keep their row; an empty table gives no rows.

    Captures of a URL in one second are combined before the shuffle, so a time slice has no more rows than seconds; the last response of each slice is carried forward over slices.
    One very common URL thus spreads over tasks; bodies aren't moved.
    """
    cols = records.select("record_id", canonical_url(F.col("url")).alias("key"), "ts", "kind", "headers")
    placed = F.col("key").isNotNull() & F.col("ts").isNotNull()
    order, full = F.struct("ts", "record_id"), F.col("kind") == "response"
    moments = cols.filter(placed & (full | (F.col("kind") == "revisit"))).groupBy("key", "ts").agg(
        F.max(F.when(full, F.col("record_id"))).alias("id"), F.max_by(F.when(full, F.col("headers")), F.when(full, order)).alias("h"), F.max(full).alias("full"), F.max(~full).alias("wanted"))
    r = F.when(F.col("full"), F.struct(F.col("ts"), F.col("id").alias("record_id"), F.col("h").alias("headers")))
    moments = moments.select("key", "ts", F.floor(F.col("ts") / slice_seconds).alias("slice"), r.alias("r"), "wanted")
    inside = Window.partitionBy("key", "slice").orderBy("ts").rowsBetween(Window.unboundedPreceding, -1)
    near = moments.withColumn("near", F.last("r", ignorenulls=True).over(inside))
    slices = moments.groupBy("key", "slice").agg(F.max_by("r", F.when(F.col("r").isNotNull(), F.col("ts"))).alias("r"))
    carried = slices.select("key", "slice", F.last("r", ignorenulls=True).over(Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    known = near.filter("wanted").join(carried, ["key", "slice"]).select("key", "ts", F.coalesce("near", "before").alias("o"))
    revisits = cols.filter(F.col("kind") == "revisit")
    found = revisits.filter(placed).join(known, ["key", "ts"]).select(*cols.columns, "o").unionByName(revisits.filter(~placed).withColumn("o", F.lit(None).cast(known.schema["o"].dataType)))
    own, old = F.col("headers"), F.col("o.headers")
    both = lambda k: F.element_at(own, k).isNotNull() & F.element_at(old, k).isNotNull()
    differs = lambda k: both(k) & (F.element_at(own, k) != F.element_at(old, k))
    yes = lambda c: F.coalesce(c, F.lit(False))
    status = F.when(F.col("o").isNull(), "no_original").when(yes(differs("etag") | differs("last-modified")), "mismatch").when(yes(both("etag") | both("last-modified")), "resolved").otherwise("unverified")
    allowed = F.map_filter(own, lambda k, _: k.isin(PERMITTED))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.coalesce(F.map_contains_key(allowed, k), F.lit(False))), allowed)
    return found.withColumn("status", status).select("record_id", "key", "ts", F.col("o.record_id").alias("original_id"), F.col("o.ts").alias("original_ts"), "status", F.when(F.col("status") == "resolved", merged).otherwise(own).alias("headers"))


def captures(pages: DataFrame) -> DataFrame:
    """A crawl history of the pages: each page is a full response at second 10,000 * page_id mod 999,983, and is revisited three times, a day apart.

    A response's etag is a digest of its html; a revisit carries the etag of what it saw, on every eleventh page that of a page changed since, and on every seventh none.
    """
    ts = F.pmod(F.col("page_id") * 10_000, F.lit(999_983))
    etag = F.md5(F.coalesce("html", F.lit("")))
    date = lambda t: F.concat(F.lit("t"), t.cast("string"))
    base = pages.select("page_id", "url", ts.alias("at"), etag.alias("etag"), F.coalesce(F.octet_length("html"), F.lit(0)).cast("string").alias("bytes"))
    kinds = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.struct(k.alias("k"), (F.col("at") + k * 86_400).alias("ts")))
    rows = base.withColumn("c", F.explode(kinds))
    first = F.create_map(F.lit("etag"), F.col("etag"), F.lit("content-length"), F.col("bytes"), F.lit("date"), date(F.col("c.ts")), F.lit("server"), F.col("page_id").cast("string"))
    later = F.when(F.col("page_id") % 7 == 0, F.create_map(F.lit("date"), date(F.col("c.ts")), F.lit("connection"), F.lit("close"))).otherwise(
        F.create_map(F.lit("etag"), F.when(F.col("page_id") % 11 == 0, F.concat(F.col("etag"), F.lit("-new"))).otherwise(F.col("etag")), F.lit("date"), date(F.col("c.ts")), F.lit("connection"), F.lit("close"))
    )
    return rows.select((F.col("page_id") * 4 + F.col("c.k")).alias("record_id"), "url", F.col("c.ts").alias("ts"), F.when(F.col("c.k") == 0, "response").otherwise("revisit").alias("kind"), F.when(F.col("c.k") == 0, first).otherwise(later).alias("headers"))


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resolved revisits of the crawl history that is derived from `pages` (see captures); null and empty URLs have no original, repeated pages keep their rows."""
    found = resolve_revisits(captures(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    header = lambda k: F.element_at("headers", k).alias(k.replace("-", "_"))
    return found.select("record_id", "key", "ts", "original_id", "original_ts", "status", header("etag"), header("date"), header("content-length"), header("server"), header("connection"))


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, url, (page_id * 10000) % 999983 AS at_, md5(coalesce(html, '')) AS etag, coalesce(strlen(html), 0)::VARCHAR AS bytes,
         regexp_replace(trim(url), '#.*$', '') AS plain FROM pages),
h AS (
  SELECT *, regexp_replace(lower(regexp_extract(plain, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?]*)', 1)), '^(www|m)\.', '') AS named,
         lower(regexp_extract(plain, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme FROM p),
k AS (
  SELECT *, CASE WHEN scheme = 'https' THEN regexp_replace(named, ':443$', '') ELSE regexp_replace(named, ':80$', '') END AS host,
         regexp_replace(regexp_extract(plain, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*([^?]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(plain, '\?(.*)$', 1), '&'), lambda q: q <> '' AND NOT regexp_matches(q, '^(?i)(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) AS kept FROM h),
c AS (SELECT page_id, etag, bytes, at_, CASE WHEN plain = '' THEN NULL WHEN host = '' THEN plain WHEN len(kept) > 0 THEN host || path || '?' || array_to_string(kept, '&') ELSE host || path END AS key FROM k),
o AS (SELECT key, at_ AS ts, max(page_id) AS page_id FROM c GROUP BY key, at_),
f AS (SELECT o.key, o.ts, o.page_id, c.etag, c.bytes FROM o JOIN c ON c.page_id = o.page_id),
r AS (SELECT page_id * 4 + n AS record_id, key, at_ + n * 86400 AS ts, CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 11 = 0 THEN etag || '-new' ELSE etag END AS etag FROM c, (VALUES (1), (2), (3)) v(n)),
j AS (SELECT r.*, f.page_id AS opage, f.ts AS ots, f.etag AS oetag, f.bytes FROM r ASOF LEFT JOIN f ON r.key = f.key AND r.ts > f.ts),
s AS (SELECT *, CASE WHEN opage IS NULL THEN 'no_original' WHEN etag <> oetag THEN 'mismatch' WHEN etag = oetag THEN 'resolved' ELSE 'unverified' END AS status FROM j)
SELECT record_id, key, ts, opage * 4 AS original_id, ots AS original_ts, status, etag, 't' || ts::VARCHAR AS date,
       CASE WHEN status = 'resolved' THEN bytes END AS content_length, CASE WHEN status = 'resolved' THEN opage::VARCHAR END AS server,
       CASE WHEN status <> 'resolved' THEN 'close' END AS connection
FROM s
"""
