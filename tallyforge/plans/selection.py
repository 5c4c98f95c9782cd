"""Filters, scalars, selections and small walks over links and trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.functions import parsing as P
from tallyforge.operators import fixpoints as X
from tallyforge.operators import strict
from tallyforge.operators.quantiles import bounded_distinct
from tallyforge.registry import Tables, query


@query("SELECT c_custkey, CASE WHEN n IS NULL THEN 'none' WHEN n > 1 THEN 'ambiguous' ELSE 'chosen' END AS reason, CASE WHEN n = 1 THEN o END AS o_orderkey FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS o FROM orders WHERE o_orderpriority LIKE '1-%' GROUP BY 1) ON o_custkey = c_custkey")
def preferred_row(t: Tables) -> DataFrame:
    """The one preferred order of each customer, or why there is none; ``strict.one_per_topic`` raises instead."""
    orders = t("orders").where(F.col("o_orderpriority").startswith("1-")).select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return strict.preferred(t("customer").select("c_custkey"), orders, "c_custkey", "o_orderkey")


@query("SELECT event_id, user_id, value FROM events WHERE event_type IN ('click', 'purchase') AND value >= 50 AND (user_id < 500 OR value >= 200)")
def filter_tree(t: Tables) -> DataFrame:
    """A tree of conditions, a list of fields and an order, as a remote query would be asked for."""
    kept = F.col("event_type").isin("click", "purchase") & (F.col("value") >= 50) & ((F.col("user_id") < 500) | (F.col("value") >= 200))
    return t("events").where(kept).select("event_id", "user_id", "value").orderBy("event_id")


@query("SELECT l_partkey, bool_or(l_returnflag = 'R') AS returned, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY returned DESC, n DESC, l_partkey LIMIT 25")
def candidate_order(t: Tables) -> DataFrame:
    """The first 25 candidates: flagged ones first, then by count, then by id."""
    parts = t("lineitem").groupBy("l_partkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("returned"), F.count("*").alias("n"))
    return parts.orderBy(F.desc("returned"), F.desc("n"), "l_partkey").limit(25)


@query(
    """WITH p AS (SELECT c_custkey, (c_custkey * 37 % 400 - 200)::DOUBLE AS lon, (c_custkey * 11 % 200 - 100)::DOUBLE AS lat FROM customer)
    SELECT (greatest(-180, least(177, floor(lon / 3) * 3)))::INT AS west, (greatest(-60, least(81, floor(lat / 3) * 3)))::INT AS south, count(*) AS points, min(c_custkey) AS first_point FROM p GROUP BY 1, 2"""
)
def spread_tiles(t: Tables) -> DataFrame:
    """Three-degree tiles that hold made-up points, clamped to the grid."""
    point = t("customer").select("c_custkey", (F.col("c_custkey") * 37 % 400 - 200).alias("lon"), (F.col("c_custkey") * 11 % 200 - 100).alias("lat"))
    tile = lambda c, lo, hi: P.clamp(F.floor(F.col(c) / 3) * 3, lo, hi).cast("int")
    return point.groupBy(tile("lon", -180, 177).alias("west"), tile("lat", -60, 81).alias("south")).agg(F.count("*").alias("points"), F.min("c_custkey").alias("first_point"))


@query("WITH u AS (SELECT page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/[0-9]+[^/]*/?$', '') AS address FROM pages) SELECT address, min(page_id) AS page_id FROM u GROUP BY 1")
def url_keep_first(t: Tables) -> DataFrame:
    """Addresses without their last number, each at its first page, in the order of first pages."""
    address = F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "/[0-9]+[^/]*/?$", "")
    return t("pages").groupBy(address.alias("address")).agg(F.min("page_id").alias("page_id")).orderBy("page_id")


@query("SELECT n_name, year(o_orderdate)::INT AS year, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
def code_year_sort(t: Tables) -> DataFrame:
    joined = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name", F.year("o_orderdate").alias("year")).agg(F.round(F.sum("o_totalprice"), 2).alias("total")).orderBy("n_name", "year")


@query("WITH k AS (SELECT user_id, date_trunc('hour', ts) AS hour, min(event_id) AS event_id FROM events GROUP BY 1, 2) SELECT event_id, user_id, epoch(hour)::BIGINT AS hour FROM k")
def time_after_dedupe(t: Tables) -> DataFrame:
    """One event a user and hour, then in order of time."""
    first = t("events").groupBy("user_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.min("event_id").alias("event_id"))
    return first.select("event_id", "user_id", F.unix_timestamp("hour").alias("hour")).orderBy("hour", "event_id")


TITLE_SQL = "t AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'Special:' || p_name WHEN 1 THEN '-' WHEN 2 THEN 'Main_Page' ELSE p_name END AS title FROM part)"


@query(f"WITH {TITLE_SQL} SELECT p_partkey, title FROM t WHERE NOT contains(title, ':') AND title NOT IN ('-', 'Main_Page')")
def title_junk(t: Tables) -> DataFrame:
    """Titles that are neither of a namespace nor known fillers."""
    k = F.col("p_partkey") % 6
    title = F.when(k == 0, F.concat(F.lit("Special:"), "p_name")).when(k == 1, "-").when(k == 2, "Main_Page").otherwise(F.col("p_name"))
    return t("part").select("p_partkey", title.alias("title")).where(~F.contains("title", F.lit(":")) & ~F.col("title").isin("-", "Main_Page"))


@query("SELECT p_partkey, p_type FROM part WHERE starts_with(lower(p_type), 'st') OR starts_with(lower(p_type), 'econ')")
def bucket_prefix(t: Tables) -> DataFrame:
    kind = F.lower("p_type")
    return t("part").where(kind.startswith("st") | kind.startswith("econ")).select("p_partkey", "p_type")


@query("SELECT p_brand, count(*) AS parts, bool_and(regexp_full_match(p_brand, 'Brand#[1-3][0-9]')) AS full_match FROM part WHERE regexp_full_match(p_brand, 'Brand#[0-9]{2}') GROUP BY 1")
def full_match(t: Tables) -> DataFrame:
    """Rows whose whole brand fits a pattern."""
    return t("part").where(F.col("p_brand").rlike("^Brand#[0-9]{2}$")).groupBy("p_brand").agg(F.count("*").alias("parts"), F.bool_and(F.col("p_brand").rlike("^Brand#[1-3][0-9]$")).alias("full_match"))


@query("SELECT page_id, substr(trim(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[^A-Za-z0-9._-]+', '_', 'g'), '_'), 1, 60) AS file_name FROM pages")
def file_names(t: Tables) -> DataFrame:
    return t("pages").select("page_id", P.file_name(F.regexp_replace("url", "^[a-z]+://", ""), 60).alias("file_name"))


@query("SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '(?i)[0-9]+ ?(km|kg|usd|eur)?')) AS numbers, len(regexp_extract_all(coalesce(text, ''), '(?i)https?://')) AS links FROM documents")
def pattern_counts(t: Tables) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return t("documents").select("doc_id", F.regexp_count(text, F.lit("(?i)[0-9]+ ?(km|kg|usd|eur)?")).cast("bigint").alias("numbers"), F.regexp_count(text, F.lit("(?i)https?://")).cast("bigint").alias("links"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN epoch(o_orderdate)::BIGINT + CASE WHEN o_orderkey % 4 = 2 THEN -7200 ELSE 0 END END AS epoch_seconds FROM orders")
def epoch_seconds(t: Tables) -> DataFrame:
    """ISO texts with and without Z or offset as seconds since 1970, without one as UTC; others are null."""
    k, day = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k == 0, day).when(k == 1, F.concat(day, F.lit("Z"))).when(k == 2, F.concat(day, F.lit("+02:00"))).otherwise("soon")
    return t("orders").select("o_orderkey", P.iso_seconds(text).alias("epoch_seconds"))


@query("WITH a AS (SELECT doc_id, CASE WHEN text IS NOT NULL AND doc_id % 9 <> 0 THEN len(string_split(text, chr(10))) ELSE 0 END AS n FROM documents) SELECT doc_id, n, n BETWEEN 0 AND 255 AS fits_byte FROM a")
def cardinality_guard(t: Tables) -> DataFrame:
    """How many elements a list has, 0 without a list, and whether a byte can hold that."""
    n = F.coalesce(F.size(F.when(F.col("doc_id") % 9 != 0, F.split("text", "\n"))), F.lit(0))
    n = F.greatest(n, F.lit(0)).cast("bigint")
    return t("documents").select("doc_id", n.alias("n"), n.between(0, 255).alias("fits_byte"))


@query(
    """WITH g AS (SELECT user_id, max(value) FILTER (event_type = 'purchase') AS a, max(value) FILTER (event_type = 'click') AS b, max(value) FILTER (event_type = 'view') AS c FROM events GROUP BY 1)
    SELECT user_id, CASE WHEN a IS NOT NULL THEN 'purchase' WHEN b IS NOT NULL THEN 'click' WHEN c IS NOT NULL THEN 'view' END AS kind, coalesce(a, b, c) AS score FROM g"""
)
def first_by_priority(t: Tables) -> DataFrame:
    """Of the scores a user has, the one of the first kind in a list of priorities."""
    scores = t("events").groupBy("user_id", "event_type").agg(F.max("value").alias("score")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "score"))).alias("scores"))
    hit = F.filter(F.array(*map(F.lit, ("purchase", "click", "view"))), lambda k: F.element_at("scores", k).isNotNull())
    return scores.select("user_id", F.try_element_at(hit, F.lit(1)).alias("kind"), F.element_at("scores", F.try_element_at(hit, F.lit(1))).alias("score"))


@query("SELECT l_suppkey, least(count(DISTINCT l_partkey), 257) AS kinds, count(DISTINCT l_partkey) > 256 AS overflow FROM lineitem GROUP BY 1")
def bounded_kinds(t: Tables) -> DataFrame:
    """Distinct values a group, counted up to 256, and whether there are more."""
    return bounded_distinct(t("lineitem"), ["l_suppkey"], "l_partkey").select("l_suppkey", "kinds", "overflow")


@query(
    """WITH RECURSIVE up AS (SELECT p_partkey AS node, p_partkey AS leaf, p_size FROM part UNION ALL SELECT node // 10, leaf, p_size FROM up WHERE node >= 10)
    SELECT node, count(*) AS below, sum(p_size)::BIGINT AS size FROM up GROUP BY 1"""
)
def tree_counts(t: Tables) -> DataFrame:
    """Size and weight of every subtree of the tree in which a number's parent is the number without its last digit."""
    digits = F.length(F.col("p_partkey").cast("string"))
    up = F.transform(F.sequence(F.lit(0), digits - 1), lambda k: F.floor(F.col("p_partkey") / F.pow(F.lit(10), k)).cast("bigint"))
    return t("part").select(F.explode(up).alias("node"), "p_size").groupBy("node").agg(F.count("*").alias("below"), F.sum("p_size").alias("size"))


@query("SELECT o_orderkey, (((o_orderkey % 9999) / 100.0)::DECIMAL(10, 2)::VARCHAR || 'e' || (o_orderkey % 40 - 20)::VARCHAR)::DOUBLE AS moment FROM orders")
def exact_exponents(t: Tables) -> DataFrame:
    """A mantissa and an exponent read as one number, so that it is rounded once."""
    mantissa = (F.col("o_orderkey") % 9999 / F.lit(100)).cast("decimal(10,2)").cast("string")
    return t("orders").select("o_orderkey", P.with_exponent(mantissa, (F.col("o_orderkey") % 40 - 20).cast("string")).alias("moment"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(f"WITH d AS (SELECT unnest({PRIORITIES}) AS o_orderpriority, unnest(range({len(PRIORITIES)})) AS ordinal) SELECT o_orderkey, ordinal::INT AS ordinal FROM orders LEFT JOIN d USING (o_orderpriority)")
def dimension_ordinal(t: Tables) -> DataFrame:
    """Categories by their place in the dimension's own index."""
    index = t("orders").sparkSession.range(1).select(F.posexplode(F.array(*map(F.lit, PRIORITIES))).alias("ordinal", "o_orderpriority"))
    return t("orders").join(F.broadcast(index), "o_orderpriority", "left").select("o_orderkey", "ordinal")


@query("SELECT user_id, strftime(ts, '%Y%m%d') AS day, max(value) AS value FROM events GROUP BY 1, 2")
def keyed_json(t: Tables) -> DataFrame:
    """Objects of date to number, one a user, read back as rows in the order of their keys."""
    days = t("events").groupBy("user_id", F.date_format("ts", "yyyyMMdd").alias("day")).agg(F.max("value").alias("value"))
    texts = days.groupBy("user_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("day", "value")))).alias("body"))
    return P.from_keyed(texts, "body", "double").select("user_id", F.col("key").alias("day"), "value").orderBy("user_id", "day")


@query("SELECT o_custkey, len(list(o_orderkey)) AS n, sum(o_orderkey)::BIGINT AS total, max(o_orderkey) AS top FROM orders GROUP BY 1")
def sparse_rows(t: Tables) -> DataFrame:
    """Lines of space-separated indices as number lists."""
    text = t("orders").groupBy("o_custkey").agg(F.array_join(F.transform(F.collect_list("o_orderkey"), lambda x: x.cast("string")), " ").alias("line"))
    rows = text.select("o_custkey", P.integers(F.col("line")).alias("at"))
    return rows.select("o_custkey", F.size("at").cast("bigint").alias("n"), F.aggregate("at", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.array_max("at").alias("top"))


LINKS_SQL = "l AS (SELECT p_partkey AS a, p_partkey * 3 + 1 AS b FROM part UNION ALL SELECT p_partkey, p_partkey * 7 + 2 FROM part)"


@query(f"WITH RECURSIVE {LINKS_SQL}, w AS (SELECT DISTINCT p_partkey AS page, 0 AS depth FROM part WHERE p_partkey < 3 UNION SELECT b, depth + 1 FROM w JOIN l ON a = page WHERE depth < 4) SELECT page, min(depth)::INT AS depth FROM w GROUP BY 1")
def link_walk(t: Tables) -> DataFrame:
    """Pages that can be reached in four steps over a table of links, each at its least depth."""
    k = F.col("p_partkey")
    links = t("part").select(k.alias("page"), F.explode(F.array(k * 3 + 1, k * 7 + 2)).alias("to"))
    return X.walk(links, t("part").where("p_partkey < 3").select(k.alias("page")), steps=4)


@query(
    """WITH r AS (SELECT regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS catalog, page_id, url FROM pages WHERE regexp_matches(url, '(?i)/(en|fr)/') AND NOT regexp_matches(url, '[?]'))
    SELECT catalog, page_id, url FROM r WHERE catalog IN (SELECT catalog FROM r GROUP BY 1 HAVING count(*) >= 2)"""
)
def resource_filter(t: Tables) -> DataFrame:
    """Resources that fit the patterns, of catalogs that have at least two of them."""
    kept = t("pages").where(F.col("url").rlike("(?i)/(en|fr)/") & ~F.col("url").contains("?")).select(F.regexp_extract("url", "^[a-z]+://([^/]*)", 1).alias("catalog"), "page_id", "url")
    enough = kept.groupBy("catalog").count().where("count >= 2").select("catalog")
    return kept.join(enough, "catalog", "left_semi")


@query("SELECT user_id, event_type, min(event_id) AS place, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2")
def last_at_first_place(t: Tables) -> DataFrame:
    """Of repeated keys the last value, at the place where the key was first seen."""
    return t("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("place"), F.max_by("value", "event_id").alias("value")).orderBy("place")


@query("WITH r AS (SELECT o_custkey, o_orderkey, md5(o_orderkey::VARCHAR) AS h FROM orders), c AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY h) <= 2) SELECT o_custkey, o_orderkey FROM c ORDER BY h, o_orderkey LIMIT 100")
def two_caps(t: Tables) -> DataFrame:
    """A sample by hash order with a cap of two a customer and of 100 in all."""
    rows = t("orders").select("o_custkey", "o_orderkey", F.md5(F.col("o_orderkey").cast("string")).alias("h"))
    few = rows.withColumn("k", F.row_number().over(W.partitionBy("o_custkey").orderBy("h"))).where("k <= 2")
    return few.orderBy("h", "o_orderkey").limit(100).select("o_custkey", "o_orderkey")


@query(
    """SELECT l_orderkey, round(product(1 - l_discount), 9) AS kept, isfinite(product(1 - l_discount)) AS finite, ceil(max(l_extendedprice / l_quantity))::BIGINT AS most FROM lineitem GROUP BY 1"""
)
def finite_products(t: Tables) -> DataFrame:
    """What all discounts of an order leave of a price, whether that is a number, and the dearest unit rounded up."""
    facts = t("lineitem").groupBy("l_orderkey").agg(F.product(1 - F.col("l_discount")).alias("p"), F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("m"))
    return facts.select("l_orderkey", F.round("p", 9).alias("kept"), P.is_finite(F.col("p")).alias("finite"), F.ceil("m").alias("most"))


@query("WITH f AS (SELECT user_id, event_id, value, max(CASE WHEN value > 400 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS over FROM events) SELECT user_id, count(*) FILTER (over = 0) AS kept, count(*) AS rows FROM f GROUP BY 1")
def stop_at_violation(t: Tables) -> DataFrame:
    """Each user's events up to the first one over a bound, in the order of ids."""
    w = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, 0)
    rows = t("events").select("user_id", F.max(F.when(F.col("value") > 400, 1).otherwise(0)).over(w).alias("over"))
    return rows.groupBy("user_id").agg(F.count_if(F.col("over") == 0).alias("kept"), F.count("*").alias("rows"))


@query("WITH f AS (SELECT user_id, arg_min(event_type, event_id) AS name FROM events GROUP BY 1) SELECT event_id, user_id, event_type FROM events JOIN f USING (user_id) WHERE event_type = name")
def same_as_first_name(t: Tables) -> DataFrame:
    """Rows that carry the name their key was first seen with; the others are dropped."""
    first = t("events").groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("name"))
    return t("events").join(first, "user_id").where("event_type = name").select("event_id", "user_id", "event_type")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_custkey IS NOT NULL)")
def without_pending(t: Tables) -> DataFrame:
    pending = t("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return t("customer").select("c_custkey").join(pending, "c_custkey", "left_anti")


@query("SELECT user_id, date_trunc('day', ts)::DATE AS day, count(*) AS rows, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) > 1")
def conflict_same_day(t: Tables) -> DataFrame:
    """Keys of one day that carry different names."""
    kinds = t("events").groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    return kinds.groupBy("user_id", "day").agg(F.sum("n").alias("rows"), F.count("*").alias("kinds")).where("kinds > 1")


@query("SELECT DISTINCT o_custkey FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 200000")
def except_large(t: Tables) -> DataFrame:
    orders = t("orders")
    return orders.select("o_custkey").distinct().join(orders.where("o_totalprice > 200000").select("o_custkey"), "o_custkey", "left_anti")


@query("SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def repeated_flags(t: Tables) -> DataFrame:
    """Keys that repeat where they should stand once."""
    return t("lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n")).where("n > 1")
