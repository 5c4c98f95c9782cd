"""Queries over texts that need Arrow functions or code units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.text import packed_ratio, strip_accents
from tallyforge.registry import Tables, query


@query("SELECT doc_id, md5(strip_accents(text)) AS plain FROM documents")
def nfd(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", F.md5(strip_accents("text")).alias("plain"))


@query()
def zlib_ratio(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", F.round(packed_ratio(F.encode("text", "UTF-8")), 6).alias("ratio"))


@query(
    r"""WITH c AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(?s).'), lambda c: unicode(c)) AS c FROM documents)
    SELECT doc_id, (len(c) + len(list_filter(c, lambda x: x > 65535)))::BIGINT AS units, md5(array_to_string(list_transform(c, lambda x: CASE WHEN x < 65536 THEN printf('%04X', x) ELSE printf('%04X%04X', 55296 + (x - 65536) // 1024, 56320 + (x - 65536) % 1024) END), '')) AS digest FROM c"""
)
def utf16_units(t: Tables) -> DataFrame:
    """How many 16-bit code units every whole text has, and a digest of all of them, surrogates apart."""
    units = F.hex(F.encode("text", "UTF-16BE"))
    return t("documents").select("doc_id", units.alias("u")).select("doc_id", (F.length("u") / 4).cast("bigint").alias("units"), F.md5("u").alias("digest"))


@query("SELECT doc_id, CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 10 = 0 THEN 'test' ELSE 'train' END AS part FROM documents")
def hash_split(t: Tables) -> DataFrame:
    bucket = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("bigint") % 10
    return t("documents").select("doc_id", F.when(bucket == 0, "test").otherwise("train").alias("part"))


@query("SELECT lang, count(*) AS n, count(DISTINCT source) AS sources, count(*) FILTER (contains(lower(text), 'the') AND NOT contains(lower(text), 'licensed')) AS chosen FROM documents GROUP BY 1")
def keyword_include_exclude(t: Tables) -> DataFrame:
    low = F.lower("text")
    return t("documents").groupBy("lang").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"), F.count_if(low.contains("the") & ~low.contains("licensed")).alias("chosen"))


@query(
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
    m AS (SELECT doc_id, min(pos) AS cut FROM l WHERE regexp_matches(line, '(?i)licen[sc]e') GROUP BY 1)
    SELECT doc_id, count(*) FILTER (cut IS NULL OR pos < cut) AS kept, count(*) AS lines FROM l LEFT JOIN m USING (doc_id) GROUP BY 1"""
)
def marker_strip(t: Tables) -> DataFrame:
    """Lines before the first one that names a licence."""
    lines = F.split("text", "\n")
    marks = F.filter(F.sequence(F.lit(1), F.size("l")), lambda i: F.element_at("l", i).rlike("(?i)licen[sc]e"))
    first = F.get(marks, F.lit(0))
    return t("documents").select("doc_id", lines.alias("l")).select("doc_id", F.coalesce(first - 1, F.size("l")).cast("bigint").alias("kept"), F.size("l").cast("bigint").alias("lines"))


@query("SELECT o_orderkey, d::DATE AS day FROM (SELECT o_orderkey, unnest(range(date_trunc('day', o_orderdate)::TIMESTAMP, date_trunc('day', o_orderdate)::TIMESTAMP + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS d FROM orders)")
def date_grid(t: Tables) -> DataFrame:
    start = F.to_date("o_orderdate")
    return t("orders").select("o_orderkey", F.explode(F.sequence(start, F.date_add(start, 2), F.expr("interval 1 day"))).alias("day"))


@query("SELECT l_orderkey, min(l_shipdate)::DATE AS first_day, max(l_shipdate)::DATE AS last_day, count(DISTINCT l_shipdate::DATE) AS days, concat_ws(',', list_sort(list(DISTINCT l_returnflag))) AS flags FROM lineitem GROUP BY 1")
def date_extents(t: Tables) -> DataFrame:
    day = F.to_date("l_shipdate")
    return t("lineitem").groupBy("l_orderkey").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_distinct(day).alias("days"), F.concat_ws(",", F.array_sort(F.collect_set("l_returnflag"))).alias("flags"))


@query("SELECT 'nation' AS side, n_nationkey::BIGINT AS k FROM nation UNION ALL SELECT 'region', r_regionkey FROM region")
def union_pages(t: Tables) -> DataFrame:
    one = lambda name, c: t(name).select(F.lit(name).alias("side"), F.col(c).cast("bigint").alias("k"))
    return one("nation", "n_nationkey").unionByName(one("region", "r_regionkey"))


@query("SELECT k FROM (SELECT DISTINCT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier)")
def intersect_seen(t: Tables) -> DataFrame:
    return t("customer").select(F.col("c_nationkey").alias("k")).intersect(t("supplier").select(F.col("s_nationkey").alias("k")))


@query(
    """WITH l AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), c AS (SELECT doc_id, text, regexp_extract(text, '(?is)^(.*?)[^\\n]*licen[sc]e', 1) AS head, regexp_matches(text, '(?i)licen[sc]e') AS marked FROM l),
    h AS (SELECT doc_id, CASE WHEN marked THEN head ELSE text END AS body FROM c)
    SELECT doc_id, length(body) AS kept_chars, md5(body) AS kept_md5 FROM h"""
)
def marker_strip_text(t: Tables) -> DataFrame:
    """The text before the first line that names a licence."""
    text = F.coalesce("text", F.lit(""))
    head = F.regexp_extract(text, r"(?is)^(.*?)[^\n]*licen[sc]e", 1)
    body = F.when(text.rlike("(?i)licen[sc]e"), head).otherwise(text)
    return t("documents").select("doc_id", body.alias("body")).select("doc_id", F.length("body").cast("bigint").alias("kept_chars"), F.md5("body").alias("kept_md5"))


@query("SELECT doc_id, length(coalesce(text, '')) + len(regexp_extract_all(coalesce(text, ''), '[\\x{10000}-\\x{10FFFF}]')) AS units FROM documents")
def utf16_lengths(t: Tables) -> DataFrame:
    """How many 16-bit code units every whole text has."""
    return t("documents").select("doc_id", (F.octet_length(F.encode(F.coalesce("text", F.lit("")), "UTF-16LE")) / 2).cast("bigint").alias("units"))
