"""More joins, encodings, selections and scalars: each a small plan with its SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.functions import parsing as P
from tallyforge.operators import records as R
from tallyforge.operators import sequences as S
from tallyforge.registry import Tables, query


@query(
    """WITH w AS (SELECT event_type, user_id, max(value) AS best FROM events GROUP BY 1, 2 HAVING max(value) >= 150)
    SELECT event_id, user_id, event_type, value, best FROM events JOIN w USING (event_type, user_id)"""
)
def two_key_inner(t: Tables) -> DataFrame:
    """Rows whose unit and tag are both wanted, with what the wanted list says of them."""
    wanted = t("events").groupBy("event_type", "user_id").agg(F.max("value").alias("best")).where("best >= 150")
    return t("events").join(wanted, ["event_type", "user_id"]).select("event_id", "user_id", "event_type", "value", "best")


@query(
    """WITH l AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS place FROM orders GROUP BY 1, 2 HAVING bool_and(o_totalprice >= 20000))
    SELECT o_custkey, o_orderpriority, n FROM l QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, place) = 1"""
)
def longest_valid_list(t: Tables) -> DataFrame:
    """Each customer's longest list of orders without an invalid value; of equally long ones the first stays."""
    lists = t("orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("place"), F.bool_and(F.col("o_totalprice") >= 20000).alias("valid"))
    best = F.max_by(F.struct("o_orderpriority", "n"), F.struct("n", -F.col("place"))).alias("best")
    return lists.where("valid").groupBy("o_custkey").agg(best).select("o_custkey", "best.*")


@query(
    """WITH s AS (SELECT DISTINCT l_orderkey, (l_linenumber + 2) // 3 AS height, l_quantity::INT % 2 + 1 AS width FROM lineitem)
    SELECT l_orderkey, CASE WHEN count(*) = 1 THEN min(height) || 'x' || min(width) WHEN count(DISTINCT width) = 1 THEN 'varying x' || min(width) ELSE count(*) || ' shapes' END AS geometry FROM s GROUP BY 1"""
)
def geometry_labels(t: Tables) -> DataFrame:
    """One shape by its sides, shapes of one width by that width, others by their number."""
    height, width = F.expr("(l_linenumber + 2) div 3").cast("string"), (F.col("l_quantity").cast("int") % 2 + 1).cast("string")
    shapes = t("lineitem").groupBy("l_orderkey").agg(F.collect_set(F.struct(height.alias("height"), width.alias("width"))).alias("s"))
    widths = F.array_distinct(F.col("s.width"))
    label = F.when(F.size("s") == 1, F.concat_ws("x", F.col("s")[0]["height"], F.col("s")[0]["width"])).when(F.size(widths) == 1, F.concat(F.lit("varying x"), widths[0]))
    return shapes.select("l_orderkey", label.otherwise(F.concat(F.size("s").cast("string"), F.lit(" shapes"))).alias("geometry"))


@query("SELECT p_partkey FROM part WHERE regexp_matches(lower(concat_ws(' ', p_name, p_type, p_brand)), 'steel|brand#1') AND NOT regexp_matches(lower(concat_ws(' ', p_name, p_type, p_brand)), 'promo|#.5')")
def keywords_of_all_columns(t: Tables) -> DataFrame:
    """Rows by words that their columns, put together, must and must not have."""
    text = F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    return t("part").where(text.rlike("steel|brand#1") & ~text.rlike("promo|#.5")).select("p_partkey")


@query(
    """WITH l AS (SELECT l_orderkey, 'l_discount' AS name, l_discount AS value FROM lineitem UNION ALL SELECT l_orderkey, 'l_tax', l_tax FROM lineitem)
    SELECT l_orderkey, name, count(*) AS n, round(sum(value), 6) AS total FROM l GROUP BY 1, 2"""
)
def unpivot_by_header(t: Tables) -> DataFrame:
    """Columns whose header fits a pattern become rows of name and value."""
    rows = t("lineitem")
    long = R.unpivot(rows, ["l_orderkey"], [c for c in rows.columns if re.fullmatch("l_(discount|tax)", c)]).toDF("l_orderkey", "name", "value")
    return long.groupBy("l_orderkey", "name").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


def _brand(p: str) -> str:
    return f"CASE WHEN {p}p_size > 5 THEN {p}p_brand END"


@query(
    f"""WITH d AS (SELECT brand, row_number() OVER (ORDER BY place, brand) AS code FROM (SELECT {_brand('')} AS brand, min(p_partkey) AS place FROM part GROUP BY 1) WHERE brand IS NOT NULL)
    SELECT p_partkey, coalesce(code, 0)::INT AS code FROM part LEFT JOIN d ON brand = {_brand('part.')}"""
)
def codes_first_seen(t: Tables) -> DataFrame:
    """Values as codes in the order of first appearance; 0 stands for a missing one."""
    rows = t("part").select("p_partkey", F.expr(_brand("")).alias("brand"))
    return rows.join(R.dictionary(rows, "brand", "p_partkey"), "brand", "left").select("p_partkey", F.coalesce("code", F.lit(0)).alias("code"))


@query(
    f"""WITH d AS (SELECT brand, row_number() OVER (ORDER BY brand) AS code FROM (SELECT DISTINCT {_brand('')} AS brand FROM part) WHERE brand IS NOT NULL)
    SELECT p_partkey, coalesce(code, 0)::INT AS code FROM part LEFT JOIN d ON brand = {_brand('part.')}"""
)
def codes_sorted(t: Tables) -> DataFrame:
    """Values as codes in sorted order; 0 stands for a missing one."""
    rows = t("part").select("p_partkey", F.expr(_brand("")).alias("brand"))
    return rows.join(R.dictionary(rows, "brand"), "brand", "left").select("p_partkey", F.coalesce("code", F.lit(0)).alias("code"))


def _twice(value: Column) -> Column:
    return F.sha2(F.unhex(F.sha2(value, 256)), 256)


_PAIR = "SELECT block, place // 2 AS place, sha256(unhex(sha256(unhex(arg_min(h, place)) || unhex(arg_max(h, place))))) AS h FROM {} GROUP BY 1, 2"


@query(
    f"""WITH a AS (SELECT o_orderkey // 7 AS block, row_number() OVER (PARTITION BY o_orderkey // 7 ORDER BY o_orderkey) - 1 AS place, sha256(unhex(sha256(o_orderkey::VARCHAR))) AS h, count(*) OVER (PARTITION BY o_orderkey // 7) AS n FROM orders),
    one AS (SELECT block, h FROM a WHERE n = 1), b AS ({_PAIR.format('a WHERE n > 1')}), c AS (SELECT b.*, count(*) OVER (PARTITION BY block) AS n FROM b),
    d AS ({_PAIR.format('c WHERE n > 1')}), e AS (SELECT d.*, count(*) OVER (PARTITION BY block) AS n FROM d), f AS ({_PAIR.format('e WHERE n > 1')})
    SELECT block, h AS root FROM one UNION ALL SELECT block, h FROM c WHERE n = 1 UNION ALL SELECT block, h FROM e WHERE n = 1 UNION ALL SELECT block, h FROM f"""
)
def merkle_roots(t: Tables) -> DataFrame:
    """The root of the hash tree over each block of up to seven rows; at an odd place the last hash meets itself."""
    leaf = _twice(F.col("o_orderkey").cast("string").cast("binary"))
    blocks = t("orders").groupBy(F.expr("o_orderkey div 7").alias("block")).agg(F.sort_array(F.collect_list(F.struct("o_orderkey", leaf.alias("h")))).alias("x"))
    blocks = blocks.select("block", F.col("x.h").alias("h"))
    for _ in range(3):  # seven leaves, four, two, one
        n = F.size("h")

        def pair(i: Column) -> Column:
            return _twice(F.concat(F.unhex(F.element_at("h", 2 * i + 1)), F.unhex(F.element_at("h", F.least(2 * i + 2, F.size("h"))))))

        blocks = blocks.select("block", F.when(n == 1, F.col("h")).otherwise(F.transform(F.sequence(F.lit(0), ((n + 1) / 2).cast("int") - 1), pair)).alias("h"))
    return blocks.select("block", F.col("h")[0].alias("root"))


@query(
    """WITH j AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN '{"a":{"x":' || (event_id * 3) || '}}' WHEN 1 THEN '{"a":{"x":"' || event_id || '"}}' WHEN 2 THEN '{"a":{"x":true}}' WHEN 3 THEN '{"a":{}}' ELSE '{"a":{"x":null}}' END AS body FROM events)
    SELECT event_id, CASE json_type(body, '$.a.x') WHEN 'UBIGINT' THEN 'number' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'missing' END AS kind,
    CASE WHEN json_type(body, '$.a.x') = 'UBIGINT' THEN (body ->> '$.a.x')::BIGINT ELSE -1 END AS x FROM j"""
)
def typed_nested_get(t: Tables) -> DataFrame:
    """A nested value by its JSON type: whole numbers are taken, truth values and quoted numbers are not; the default is -1."""
    k, key = F.col("event_id") % 5, F.col("event_id").cast("string")
    number = F.concat(F.lit('{"a":{"x":'), (F.col("event_id") * 3).cast("string"), F.lit("}}"))
    body = F.when(k == 0, number).when(k == 1, F.concat(F.lit('{"a":{"x":"'), key, F.lit('"}}'))).when(k == 2, '{"a":{"x":true}}').when(k == 3, '{"a":{}}').otherwise('{"a":{"x":null}}')
    rows = t("events").select("event_id", F.try_parse_json(body).alias("v"))
    kind = F.schema_of_variant(F.try_variant_get("v", "$.a.x", "variant"))
    named = F.when(kind == "BIGINT", "number").when(kind == "STRING", "text").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null").otherwise("missing")
    return rows.select("event_id", named.alias("kind"), F.when(kind == "BIGINT", F.try_variant_get("v", "$.a.x", "bigint")).otherwise(F.lit(-1).cast("bigint")).alias("x"))


@query(
    """WITH p AS (SELECT p_partkey, (p_partkey * 37 % 700 - 20)::DOUBLE AS x, (p_partkey * 11 % 500 - 10)::DOUBLE AS y FROM part)
    SELECT p_partkey, x BETWEEN 0 AND 640 AND y BETWEEN 0 AND 480 AS inside, CASE WHEN x BETWEEN 0 AND 640 AND y BETWEEN 0 AND 480 THEN x / 640 END AS u, CASE WHEN x BETWEEN 0 AND 640 AND y BETWEEN 0 AND 480 THEN y / 480 END AS v FROM p"""
)
def normalised_points(t: Tables) -> DataFrame:
    """Points as shares of the frame's sides; points outside the frame have none."""
    x, y = (F.col("p_partkey") * 37 % 700 - 20).cast("double"), (F.col("p_partkey") * 11 % 500 - 10).cast("double")
    inside = x.between(0, 640) & y.between(0, 480)
    return t("part").select("p_partkey", inside.alias("inside"), F.when(inside, x / 640).alias("u"), F.when(inside, y / 480).alias("v"))


@query(
    r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1) AS base_name,
    nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/feed?of=' || page_id AS feed FROM pages"""
)
def url_parts(t: Tables) -> DataFrame:
    """Host, last part of the path, one parameter, and an address joined to the host."""
    path = F.regexp_replace(F.try_parse_url("url", F.lit("PATH")), "/$", "")
    base, page = F.substring_index(path, "/", -1), F.try_url_decode(F.try_parse_url("url", F.lit("QUERY"), F.lit("page")))
    host = F.try_parse_url("url", F.lit("HOST"))
    feed = F.concat(F.try_parse_url("url", F.lit("PROTOCOL")), F.lit("://"), host, F.lit("/feed?of="), "page_id")
    return t("pages").select("page_id", host.alias("host"), base.alias("base_name"), page.alias("page"), feed.alias("feed"))


@query(
    """WITH g AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1),
    c AS (SELECT l_suppkey, n, chunk, 8 + ('0x' || substr(md5(l_suppkey || '-' || chunk), 1, 4))::INT % 24 AS length FROM g, unnest(range(n // 8 + 1)) AS u(chunk)),
    e AS (SELECT *, sum(length) OVER (PARTITION BY l_suppkey ORDER BY chunk) AS stop FROM c)
    SELECT l_suppkey, chunk, (stop - length)::BIGINT AS start, (least(stop, n) - (stop - length))::BIGINT AS length FROM e WHERE stop - length < n"""
)
def hashed_chunks(t: Tables) -> DataFrame:
    """Every series in chunks of 8 to 31 values, the lengths drawn by a hash of series and number; the last is what is left."""
    series = t("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    chunks = series.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("n div 8"))))
    drawn = F.conv(F.substring(F.md5(F.concat_ws("-", "l_suppkey", "chunk").cast("binary")), 1, 4), 16, 10).cast("bigint") % 24 + 8
    ends = S.running_total(chunks.withColumn("length", drawn), ["l_suppkey"], ["chunk"], "length")
    start = F.col("running") - F.col("length")
    return ends.where(start < F.col("n")).select("l_suppkey", "chunk", start.alias("start"), (F.least("running", "n") - start).alias("length"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 148")
def keyset_pages(t: Tables) -> DataFrame:
    """Three pages of fifty, each from the last key of the one before, whose row is met again and kept once."""
    rows, cursor, out = t("orders").select("o_orderkey", "o_totalprice"), None, None
    for _ in range(3):
        page = (rows if cursor is None else rows.where(F.col("o_orderkey") >= cursor)).orderBy("o_orderkey").limit(50)
        cursor = page.agg(F.max("o_orderkey")).first()[0]
        out = page if out is None else out.unionByName(page)
    return out.dropDuplicates(["o_orderkey"])


@query(
    """WITH a AS (SELECT * FROM events WHERE value >= 20 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 30)
    SELECT user_id, event_type, event_id FROM a QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) = 1"""
)
def listed_then_unique(t: Tables) -> DataFrame:
    """The first thirty accepted rows of each list, counted before users met in several lists keep only their first."""
    listed = S.first_per_group(t("events").where("value >= 20"), ["event_type"], ["event_id"], 30)
    return R.keep_first(listed, ["user_id"], [F.col("event_type"), F.col("event_id")]).select("user_id", "event_type", "event_id")


@query(
    """SELECT o_custkey, o_orderkey, total FROM (SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS total
    FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice <= 200000) WHERE total <= 600000"""
)
def gated_listing(t: Tables) -> DataFrame:
    """Records of an allowed kind and size, as long as their running total stays under a cap."""
    allowed = t("orders").where(F.col("o_orderstatus").isin("O", "F") & (F.col("o_totalprice") <= 200000))
    total = F.round(F.sum("o_totalprice").over(W.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(W.unboundedPreceding, 0)), 2)
    return allowed.select("o_custkey", "o_orderkey", total.alias("total")).where("total <= 600000")


@query("SELECT n_name, d::DATE AS day, lower(n_name) || '/' || strftime(d, '%Y/%m-%d') || '.zip' AS path FROM nation, unnest(generate_series(DATE '2024-02-25', DATE '2024-03-05', INTERVAL 1 DAY)) AS u(d)")
def dated_resources(t: Tables) -> DataFrame:
    """The resource of every symbol and day of a span."""
    day = F.explode(F.sequence(F.lit("2024-02-25").cast("date"), F.lit("2024-03-05").cast("date")))
    each = t("nation").select("n_name", day.alias("day"))
    return each.withColumn("path", F.concat(F.lower("n_name"), F.lit("/"), F.date_format("day", "yyyy/MM-dd"), F.lit(".zip")))


@query(
    r"""SELECT page_id, unnest(list_distinct(list_concat(regexp_extract_all(coalesce(html, ''), 'href="([^"]*[a-m])"', 1), regexp_extract_all(coalesce(html, ''), 'https?://[^\s"<>]+')))) AS link FROM pages"""
)
def links_of_suffix(t: Tables) -> DataFrame:
    """Each page's distinct links: those in attributes that end as asked for, and bare addresses."""
    html = F.coalesce("html", F.lit(""))
    named, bare = (F.regexp_extract_all(html, F.lit(p), F.lit(g)) for p, g in (('href="([^"]*[a-m])"', 1), (r'https?://[^\s"<>]+', 0)))
    return t("pages").select("page_id", F.explode(F.array_distinct(F.concat(named, bare))).alias("link"))


@query("SELECT event_id, trunc(value - 50)::BIGINT AS whole, least(greatest(value, 5), 90) AS held FROM events")
def truncated_and_clamped(t: Tables) -> DataFrame:
    """Numbers read from text and cut towards zero, and numbers held within bounds."""
    return t("events").select("event_id", P.truncated((F.col("value") - 50).cast("string")).alias("whole"), P.clamp(F.col("value"), 5.0, 90.0).alias("held"))
