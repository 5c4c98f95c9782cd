"""Parsing, filtering, scalar functions, deduplication and set comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import parsing as P
from tallyforge.operators import records as R
from tallyforge.registry import Tables, query

RAW_SQL = "r AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN value::VARCHAR WHEN 2 THEN (event_id % 50)::VARCHAR || '.0' WHEN 3 THEN 'nan' WHEN 4 THEN '1d' ELSE '-' || (event_id % 90)::VARCHAR || '.5' END AS raw FROM events)"
NUMBER_SQL = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def raw_events(t: Tables) -> DataFrame:
    k = F.col("event_id")
    raw = F.when(k % 6 == 0, "").when(k % 6 == 1, F.col("value").cast("string")).when(k % 6 == 2, F.concat((k % 50).cast("string"), F.lit(".0"))).when(k % 6 == 3, "nan").when(k % 6 == 4, "1d").otherwise(F.concat(F.lit("-"), (k % 90).cast("string"), F.lit(".5")))
    return t("events").select("event_id", raw.alias("raw"))


@query(
    f"""WITH {RAW_SQL}, p AS (SELECT event_id, event_id % 6 AS kind, CASE WHEN event_id % 6 = 1 THEN 1 WHEN regexp_matches(raw, {NUMBER_SQL}) THEN 1 ELSE 0 END AS ok, CASE WHEN event_id % 6 = 2 THEN event_id % 50 WHEN event_id % 6 = 1 AND raw::DOUBLE = floor(raw::DOUBLE) THEN raw::DOUBLE::BIGINT END AS whole FROM r)
    SELECT kind, count(*) AS rows, sum(ok)::BIGINT AS parsed, sum(whole)::BIGINT AS whole_sum FROM p GROUP BY 1"""
)
def safe_parsing(t: Tables) -> DataFrame:
    """Every event, also those whose text is its own value; ``safe_parsing_whole`` sums the numbers too."""
    rows = raw_events(t).withColumn("kind", F.col("event_id") % 6)
    return rows.groupBy("kind").agg(F.count("*").alias("rows"), F.count(P.safe_float(F.col("raw"))).alias("parsed"), F.sum(P.safe_integral(F.col("raw"))).alias("whole_sum"))


@query(
    f"""WITH {RAW_SQL}, p AS (SELECT event_id % 6 AS kind, CASE WHEN regexp_matches(raw, {NUMBER_SQL}) THEN raw::DOUBLE END AS number FROM r)
    SELECT kind, count(*) AS rows, count(number) AS parsed, round(sum(number), 4) AS total, sum(CASE WHEN number = floor(number) THEN number::BIGINT END)::BIGINT AS whole_sum FROM p GROUP BY 1"""
)
def safe_parsing_whole(t: Tables) -> DataFrame:
    """Every event, also those whose text is its own value, and those without an id."""
    number = P.safe_float(F.col("raw"))
    rows = raw_events(t).withColumn("kind", F.col("event_id") % 6)
    return rows.groupBy("kind").agg(F.count("*").alias("rows"), F.count(number).alias("parsed"), F.round(F.sum(number), 4).alias("total"), F.sum(P.safe_integral(F.col("raw"))).alias("whole_sum"))


@query(
    """SELECT CASE WHEN event_id % 13 = 0 THEN 'blank' WHEN value < 5 THEN 'too_low' WHEN value > 90 THEN 'too_high' WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'other_type' ELSE 'accepted' END AS reason,
    count(*) AS rows FROM events GROUP BY 1"""
)
def reject_reason_counts(t: Tables) -> DataFrame:
    reasons = {"blank": F.col("event_id") % 13 == 0, "too_low": F.col("value") < 5, "too_high": F.col("value") > 90, "other_type": ~F.col("event_type").isin("click", "view", "purchase")}
    return R.rejected(t("events"), reasons).groupBy("reason").agg(F.count("*").alias("rows"))


@query("SELECT l_returnflag, count(*) AS rows, count(*) FILTER (l_returnflag <> 'R' AND l_linestatus = 'O') AS kept FROM lineitem GROUP BY 1")
def quality_flag_filter(t: Tables) -> DataFrame:
    return t("lineitem").groupBy("l_returnflag").agg(F.count("*").alias("rows"), F.count_if((F.col("l_returnflag") != "R") & (F.col("l_linestatus") == "O")).alias("kept"))


CELLS_SQL = "c AS (SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS a, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey::DOUBLE END AS b FROM customer)"


def cells(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t("customer").select(k, F.when(k % 5 != 0, F.col("c_acctbal")).alias("a"), F.when(k % 7 != 0, F.col("c_nationkey").cast("double")).alias("b"))


@query(f"WITH {CELLS_SQL} SELECT count(*) AS rows, round(sum(a), 4) AS a, sum(b) AS b FROM c WHERE a IS NOT NULL AND b IS NOT NULL")
def row_coherent_drop(t: Tables) -> DataFrame:
    return cells(t).dropna(subset=["a", "b"]).agg(F.count("*").alias("rows"), F.round(F.sum("a"), 4).alias("a"), F.sum("b").alias("b"))


@query(f"WITH {CELLS_SQL} SELECT 'a' AS series_id, count(a) AS n, round(sum(a), 4) AS total FROM c UNION ALL SELECT 'b', count(b), round(sum(b), 4) FROM c")
def cell_drop(t: Tables) -> DataFrame:
    return R.unpivot(cells(t), ["c_custkey"], ["a", "b"]).where("value is not null").groupBy("series_id").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT p_partkey, p_size * CASE p_partkey % 3 WHEN 0 THEN 1000.0::DOUBLE WHEN 1 THEN 1000000.0::DOUBLE ELSE 1.0::DOUBLE END AS value FROM part")
def unit_suffix_parse(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    text = F.concat(F.col("p_size").cast("string"), F.when(k % 3 == 0, ".00K").when(k % 3 == 1, "m").otherwise(""))
    return t("part").select(k, P.suffixed(text).alias("value"))


@query("SELECT p_partkey, (p_size + 0.5)::DOUBLE AS value FROM part")
def decimal_comma(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", P.decimal_comma(F.concat(F.col("p_size").cast("string"), F.lit(",5"))).alias("value"))


@query("SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS cents FROM orders")
def fixed_point_cents(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))


@query("SELECT l_suppkey, min(l_extendedprice::FLOAT)::DOUBLE AS low, max(l_extendedprice::FLOAT)::DOUBLE AS high FROM lineitem GROUP BY 1")
def float32_store_minmax(t: Tables) -> DataFrame:
    stored = F.col("l_extendedprice").cast("float")
    return t("lineitem").groupBy("l_suppkey").agg(F.min(stored).cast("double").alias("low"), F.max(stored).cast("double").alias("high"))


@query("WITH f AS (SELECT event_type, min(event_id) AS o FROM events WHERE event_type IS NOT NULL GROUP BY 1) SELECT event_type, row_number() OVER (ORDER BY o)::INT AS code FROM f")
def dict_first_seen(t: Tables) -> DataFrame:
    return R.dictionary(t("events"), "event_type", "event_id")


@query("SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority)::INT AS code FROM (SELECT DISTINCT o_orderpriority FROM orders)")
def dict_sorted(t: Tables) -> DataFrame:
    return R.dictionary(t("orders"), "o_orderpriority")


@query("SELECT l_suppkey, l_orderkey, l_linenumber, (row_number() OVER w - 1) // 100 AS shard, (row_number() OVER w - 1) % 100 AS \"offset\" FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity)")
def shard_offsets(t: Tables) -> DataFrame:
    rows = t("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return R.shards(rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], 100).withColumn("offset", F.col("offset").cast("bigint")).drop("l_partkey", "l_quantity")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def dedupe_first(t: Tables) -> DataFrame:
    return R.keep_first(t("events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def dedupe_last(t: Tables) -> DataFrame:
    return R.keep_last(t("events").select("user_id", "event_type", "event_id", "value", "ts"), ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("SELECT l_partkey, l_suppkey, count(*) AS rows, count(DISTINCT l_extendedprice) > 1 AS conflict FROM lineitem GROUP BY 1, 2")
def dedupe_conflict(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")  # two prices at least are a least and a greatest that differ: one grouping, by the keys alone
    return t("lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("rows"), F.coalesce(F.min(price) != F.max(price), F.lit(False)).alias("conflict"))


@query("SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_payload(t: Tables) -> DataFrame:
    digest = t("documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return digest.groupBy("digest").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


@query("SELECT doc_id, sha256(text) AS sha, md5(text) AS md FROM documents")
def payload_digest(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", F.sha2("text", 256).alias("sha"), F.md5("text").alias("md"))


@query(
    """WITH a AS (SELECT n_nationkey AS k FROM nation), b AS (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_nationkey % 9 <> 4)
    SELECT (SELECT count(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b)) AS missing, (SELECT count(*) FROM (SELECT k FROM b EXCEPT SELECT k FROM a)) AS unexpected, (SELECT count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b)) AS common"""
)
def set_equality(t: Tables) -> DataFrame:
    a = t("nation").select(F.col("n_nationkey").alias("k")).distinct().withColumn("a", F.lit(1))
    b = t("customer").where("c_nationkey % 9 <> 4").select(F.col("c_nationkey").alias("k")).distinct().withColumn("b", F.lit(1))
    return a.join(b, "k", "full").agg(F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("unexpected"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("common"))


@query("SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def except_required(t: Tables) -> DataFrame:
    """Required keys that no row has."""
    return t("orders").select("o_orderkey").exceptAll(t("lineitem").select("l_orderkey").distinct()).distinct()


@query(
    r"""SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug, lpad(p_partkey::VARCHAR, 8, '0') AS padded, regexp_extract(p_brand, '([0-9]+)', 1)::INT AS brand_no, lower(regexp_replace('partTypeID', '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS snake FROM part"""
)
def text_scalars(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", P.slug(F.col("p_name")).alias("slug"), F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("padded"), F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int").alias("brand_no"), P.snake(F.lit("partTypeID")).alias("snake"))


@query(
    r"""SELECT c_custkey, lower(regexp_replace(regexp_replace(c_mktsegment || 'Of' || c_name, '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '([a-z0-9])([A-Z])', '\1_\2', 'g')) AS snake FROM customer"""
)
def snake_names(t: Tables) -> DataFrame:
    """Names of mixed case, with runs of capitals, in small letters and underscores."""
    return t("customer").select("c_custkey", P.snake(F.concat("c_mktsegment", F.lit("Of"), "c_name")).alias("snake"))


@query(
    """SELECT o_orderkey, (date_diff('day', DATE '0001-01-01', o_orderdate::DATE) + 1)::INT AS ordinal, epoch_ms(o_orderdate) AS ms, (year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate))::INT AS packed,
    (year(o_orderdate) * 12 + month(o_orderdate))::INT AS months, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::INT AS days FROM orders"""
)
def date_scalars(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate")
    return t("orders").select("o_orderkey", P.ordinal_day(day).cast("int").alias("ordinal"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ms"), P.packed_date(day).alias("packed"), P.month_ordinal(day).alias("months"), F.unix_date(day).alias("days"))


@query("SELECT l_orderkey, l_linenumber, (l_linenumber * 5 * 3600 + (l_orderkey % 60) * 60 + l_orderkey % 50)::INT AS seconds FROM lineitem")
def clock_seconds(t: Tables) -> DataFrame:
    text = F.concat_ws(":", (F.col("l_linenumber") * 5).cast("string"), F.lpad((F.col("l_orderkey") % 60).cast("string"), 2, "0"), F.lpad((F.col("l_orderkey") % 50).cast("string"), 2, "0"))
    return t("lineitem").select("l_orderkey", "l_linenumber", P.clock_seconds(text).alias("seconds"))


@query("SELECT page_id, len(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS links, coalesce(regexp_extract(html, 'href=\"([^\"]+)\"', 1), '') AS first_link, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages")
def link_harvest(t: Tables) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))
    return t("pages").select("page_id", F.size(links).cast("bigint").alias("links"), F.regexp_extract("html", 'href="([^"]+)"', 1).alias("first_link"), F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"))


@query("SELECT p_partkey, ((p_size % 256) * 65536 + ((p_partkey % 256) * 256) + 7)::BIGINT AS rgb FROM part")
def rgb_compose(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", F.shiftleft((F.col("p_size") % 256).cast("bigint"), 16).bitwiseOR(F.shiftleft(F.col("p_partkey") % 256, 8)).bitwiseOR(F.lit(7).cast("bigint")).alias("rgb"))


@query("SELECT doc_id, substr(sha1(source || chr(9) || lang), 1, 8) AS tag, strlen(text) AS bytes, length(text) AS chars FROM documents")
def short_digests(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", P.short_digest(F.col("source"), F.col("lang")).alias("tag"), F.octet_length("text").cast("bigint").alias("bytes"), F.length("text").cast("bigint").alias("chars"))
