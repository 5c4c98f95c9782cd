"""WARC not-modified revisits: an as-of join by canonical URL to the latest earlier full response.

Captures of one URL are cut into blocks of time, and a block with very many captures into more
slices. The latest response of each slice is found by partial aggregation and carried into the
later ones; inside a slice a running maximum does the rest. So a URL that holds a third of all
captures is spread over as many tasks as it has slices, and no task needs a URL's whole
history, but for one row a slice; only captures of one URL in one second are never parted.

A revisit resolves if its validators agree with that response's: entity tags (weak comparison)
where both have one, else modification dates, else payload digests. The headers that a 304
may update are taken from it, all others from the response.

Defined results: earlier means a smaller ``ts``; among responses of one ``ts`` the largest
record id counts; captures without a URL or time resolve to nothing; a revisit before any
response has state ``no_response``, one whose validators disagree or are missing
``not_matching``; repeated captures are judged each by itself; header values that are null are
empty; an empty table has no rows; columns that are not named below are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Header fields that a not-modified answer may update; fixed by the HTTP standard's text on 304.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]

TRACKING = "^(utm_[a-z]+|ref)(=|$)"
#: A block of time with more than this share of all captures, or this number, is cut into slices.
DENSE_SHARE, DENSE_ROWS = 1024, 10_000


def canonical(url: Column) -> Column:
    """The URL without scheme, default port, fragment, tracking parameters, trailing slash and www., host in lower case."""
    url = F.regexp_replace(url, "(?s)#.*$", "")
    kept = F.filter(F.split(F.regexp_extract(url, "(?s)^[^?]*[?](.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    where = F.regexp_replace(F.regexp_extract(url, "^[^?]*", 0), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(where, "^[^/]*", 0)), ":(80|443)$", ""), "^www[.]", "")
    place = F.concat(host, F.regexp_extract(where, "(?s)^[^/]*(.*)$", 1))
    return F.when(F.size(kept) > 0, F.concat(place, F.lit("?"), F.array_join(kept, "&"))).otherwise(F.regexp_replace(place, "/+$", ""))


def resolve_revisits(captures: DataFrame, *, block: int = 86_400) -> DataFrame:
    """record_id, kind, url_key, base_id, state, headers (merged, name: value lines sorted by name) of every capture.

    captures: record_id, url, ts (whole seconds), kind (response or revisit), etag,
    last_modified, digest, headers (map of lower-case names).
    """
    rows = captures.select("record_id", "kind", F.col("ts").cast("long").alias("ts"), "etag", "last_modified", "digest", "headers", canonical(F.col("url")).alias("url_key"))
    rows = rows.withColumn("block", F.floor(F.col("ts") / block))
    full = F.when((F.col("kind") == "response") & F.col("ts").isNotNull(), F.struct("ts", "record_id", "etag", "last_modified", "digest", F.array_sort(F.map_entries("headers")).alias("headers")))
    rows = rows.withColumn("full", full)
    known = rows.where("url_key is not null and ts is not null")
    most = max(DENSE_ROWS, captures.count() // DENSE_SHARE)
    dense = known.groupBy("url_key", "block").agg(F.count("*").alias("n")).where(F.col("n") > most)  # DENSE_SHARE rows at most
    known = known.join(F.broadcast(dense), ["url_key", "block"], "left")
    slices = F.ceil(F.coalesce("n", F.lit(1)) / most)
    known = known.withColumn("slice", F.floor((F.col("ts") - F.col("block") * block) * slices / block)).drop("n")
    keys = ["url_key", "block", "slice"]
    latest = known.groupBy(*keys).agg(F.max("full").alias("latest"))
    carried = latest.select(*keys, F.max("latest").over(W.partitionBy("url_key").orderBy("block", "slice").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))
    inside = known.withColumn("near", F.max("full").over(W.partitionBy(*keys).orderBy("ts").rangeBetween(W.unboundedPreceding, -1)))
    met = inside.join(carried, keys).withColumn("base", F.coalesce("near", "carried"))
    met = met.unionByName(rows.where("url_key is null or ts is null"), allowMissingColumns=True)
    tag = lambda c: F.regexp_replace(c, "^W/", "")
    agree = F.coalesce(tag(F.col("etag")) == tag(F.col("base.etag")), F.col("last_modified") == F.col("base.last_modified"), F.col("digest") == F.col("base.digest"), F.lit(False))
    state = F.when(F.col("kind") == "response", "full").when(F.col("base").isNull(), "no_response").when(agree, "resolved").otherwise("not_matching")
    own = F.coalesce(F.col("headers"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    update = F.map_filter(own, lambda k, v: k.isin(PERMITTED))
    old = F.map_from_entries(F.coalesce(F.col("base.headers"), F.array().cast("array<struct<key:string,value:string>>")))
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(update), k)), update)
    met = met.withColumn("state", state)
    lines = F.array_join(F.transform(F.array_sort(F.map_entries(F.when(F.col("state") == "resolved", merged).otherwise(own))), lambda e: F.concat(e.key, F.lit(": "), F.coalesce(e.value, F.lit("")))), "\n")
    return met.select("record_id", "kind", "url_key", F.when(F.col("state") == "resolved", F.col("base.record_id")).alias("base_id"), "state", lines.alias("headers"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Captures as a crawl of these pages would leave them, three or four a page.

    Each page has its full response and a revisit asked for by another form of its URL: a tenth
    of these carries another entity tag, a tenth has only a digest, and a fifth comes before the
    response. Each page's visit also asks for its host's front page, which changes with every 200th
    page: a third of the visits finds it whole, and each revisits it once more, with the entity
    tag, an older one, a date or a digest. So a host with many pages has one URL with many
    captures, most of which resolve to a response that another page's visit left.
    """
    html = F.coalesce("html", F.lit(""))
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    pages = pages.select("page_id", "url", host.alias("host"), F.md5(html).alias("digest"), F.octet_length(html).cast("string").alias("size"), F.floor(F.col("page_id") / 200).alias("version"))
    n, digest, size, version = (F.col(c) for c in ("page_id", "digest", "size", "version"))
    none = F.lit(None).cast("string")
    text = lambda c: c.cast("string")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))

    def capture(record, url, ts, kind, tag, modified, digest, **headers):
        made = F.map_from_arrays(F.array(*(F.lit(k.replace("_", "-")) for k in headers)), F.array(*headers.values()))
        values = dict(record_id=record, url=url, ts=ts, kind=F.lit(kind), etag=tag, last_modified=modified, digest=digest, headers=F.map_filter(made, lambda _, v: v.isNotNull()))
        return F.struct(*(v.alias(k) for k, v in values.items()))

    tag = quoted(F.substring(digest, 1, 16))
    sent = F.when(n % 10 == 3, F.lit('"other"')).when(n % 10 != 4, F.concat(F.lit("W/"), tag))
    asked = F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))
    front = F.concat(F.lit("http://"), F.upper("host"), F.lit(":80/?utm_source=feed"))
    again = F.concat(F.lit("https://www."), F.col("host"), F.lit("/?ref=top#top"))
    release, modified, print_ = quoted(F.concat(F.lit("v"), text(version))), F.concat(F.lit("day "), text(version)), F.md5(text(version))
    known = F.when(n % 10 < 6, release).when(n % 10 == 6, F.concat(F.lit("W/"), release)).when(n % 10 == 7, quoted(F.concat(F.lit("v"), text(version - 1))))
    made = F.array(
        capture(4 * n, F.col("url"), n * 600, "response", tag, none, digest, etag=tag, content_length=size, date=text(n * 600)),
        capture(4 * n + 1, asked, n * 600 + F.when(n % 5 == 0, -300).otherwise(300), "revisit", sent, none, digest, date=text(n * 600 + 300), server=F.lit("edge"), content_length=F.lit("0")),
        F.when(n % 3 == 0, capture(4 * n + 2, front, n * 600 + 100, "response", release, modified, print_, etag=release, last_modified=modified, content_length=F.lit("5000"), date=text(n * 600 + 100))),
        capture(4 * n + 3, again, n * 600 + F.when(n % 4 == 0, 100).otherwise(150), "revisit", known, F.when(n % 10 == 8, modified), print_, etag=known, date=text(n * 600 + 150), server=F.lit("edge")),
    )
    return pages.select(F.inline(F.filter(made, lambda c: c.isNotNull())))


ORACLE = """
WITH p AS (
  SELECT page_id AS n, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, md5(coalesce(html, '')) AS digest, strlen(coalesce(html, ''))::VARCHAR AS size, page_id // 200 AS version,
         '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag, '"v' || (page_id // 200) || '"' AS release, 'day ' || (page_id // 200) AS modified FROM pages),
c AS (
  SELECT 4 * n AS record_id, url, n * 600 AS ts, 'response' AS kind, tag AS etag, NULL AS last_modified, digest, tag AS h_etag, size AS h_length, (n * 600)::VARCHAR AS h_date, NULL AS h_modified, NULL AS h_server FROM p
  UNION ALL SELECT 4 * n + 1, regexp_replace(url, '#.*$', '') || '#again', n * 600 + CASE WHEN n % 5 = 0 THEN -300 ELSE 300 END, 'revisit',
         CASE WHEN n % 10 = 3 THEN '"other"' WHEN n % 10 <> 4 THEN 'W/' || tag END, NULL, digest, NULL, '0', (n * 600 + 300)::VARCHAR, NULL, 'edge' FROM p
  UNION ALL SELECT 4 * n + 2, 'http://' || upper(host) || ':80/?utm_source=feed', n * 600 + 100, 'response', release, modified, md5(version::VARCHAR), release, '5000', (n * 600 + 100)::VARCHAR, modified, NULL FROM p WHERE n % 3 = 0
  UNION ALL SELECT 4 * n + 3, 'https://www.' || host || '/?ref=top#top', n * 600 + CASE WHEN n % 4 = 0 THEN 100 ELSE 150 END, 'revisit', k, CASE WHEN n % 10 = 8 THEN modified END, md5(version::VARCHAR), k, NULL, (n * 600 + 150)::VARCHAR, NULL, 'edge'
         FROM (SELECT *, CASE WHEN n % 10 < 6 THEN release WHEN n % 10 = 6 THEN 'W/' || release WHEN n % 10 = 7 THEN '"v' || (version - 1) || '"' END AS k FROM p)),
u AS (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM c),
v AS (SELECT *, regexp_extract(bare, '^[^?]*', 0) AS whole, list_filter(string_split(regexp_extract(bare, '^[^?]*[?](.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)(=|$)')) AS params FROM u),
w AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(whole, '^[^/]*', 0)), ':(80|443)$', ''), '^www[.]', '') || regexp_extract(whole, '^[^/]*(.*)$', 1) AS place FROM v),
x AS (SELECT *, CASE WHEN len(params) > 0 THEN place || '?' || array_to_string(params, '&') ELSE regexp_replace(place, '/+$', '') END AS url_key FROM w),
r AS (SELECT *, ts AS seen FROM x WHERE kind = 'response' QUALIFY row_number() OVER (PARTITION BY url_key, ts ORDER BY record_id DESC) = 1),
j AS (SELECT x.*, r.record_id AS base, r.etag AS b_etag, r.last_modified AS b_modified, r.digest AS b_digest, r.h_etag AS bh_etag, r.h_length AS bh_length, r.h_modified AS bh_modified
      FROM x ASOF LEFT JOIN r ON x.url_key = r.url_key AND x.ts > r.seen),
s AS (SELECT *, CASE WHEN kind = 'response' THEN 'full' WHEN base IS NULL THEN 'no_response'
      WHEN coalesce(regexp_replace(etag, '^W/', '') = regexp_replace(b_etag, '^W/', ''), last_modified = b_modified, digest = b_digest, false) THEN 'resolved' ELSE 'not_matching' END AS state FROM j)
SELECT record_id, kind, url_key, CASE WHEN state = 'resolved' THEN base END AS base_id, state,
       CASE WHEN state = 'resolved' THEN concat_ws(chr(10), 'content-length: ' || bh_length, 'date: ' || h_date, 'etag: ' || coalesce(h_etag, bh_etag), 'last-modified: ' || bh_modified)
            ELSE concat_ws(chr(10), 'content-length: ' || h_length, 'date: ' || h_date, 'etag: ' || h_etag, 'last-modified: ' || h_modified, 'server: ' || h_server) END AS headers
FROM s
"""
