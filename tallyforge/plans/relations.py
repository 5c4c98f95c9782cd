"""Joins, aggregations, top-k and pages over the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.operators import records as R
from tallyforge.operators import sequences as S
from tallyforge.operators.ranks import placed
from tallyforge.registry import Tables, query


@query("SELECT l_orderkey, l_linenumber, p_brand, l_quantity FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size IN (1, 5, 9) AND l_returnflag = 'R'")
def select_unit_tag_inner(t: Tables) -> DataFrame:
    chosen = t("part").where(F.col("p_size").isin(1, 5, 9)).select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return t("lineitem").where("l_returnflag = 'R'").join(chosen, "l_partkey").select("l_orderkey", "l_linenumber", "p_brand", "l_quantity")


@query("SELECT s_suppkey, coalesce(n_name, 'unknown') AS nation FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey")
def dim_left_default(t: Tables) -> DataFrame:
    dim = t("nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return t("supplier").join(dim, "s_nationkey", "left").select("s_suppkey", F.coalesce("n_name", F.lit("unknown")).alias("nation"))


@query(
    """WITH i AS (SELECT l_linestatus, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2), r AS (SELECT 'N' AS l_returnflag, 'auxiliary' AS role)
    SELECT coalesce(role, 'primary') AS role, sum(n)::BIGINT AS total FROM i LEFT JOIN r USING (l_returnflag) GROUP BY 1"""
)
def role_left(t: Tables) -> DataFrame:
    index = t("lineitem").groupBy("l_linestatus", "l_returnflag").agg(F.count("*").alias("n"))
    roles = index.sparkSession.createDataFrame([("N", "auxiliary")], "l_returnflag string, role string")
    named = index.join(F.broadcast(roles), "l_returnflag", "left")
    return named.groupBy(F.coalesce("role", F.lit("primary")).alias("role")).agg(F.sum("n").alias("total"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def planned_semi(t: Tables) -> DataFrame:
    return t("customer").join(t("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority = '1-URGENT')")
def missing_anti(t: Tables) -> DataFrame:
    """Customers that no urgent order names."""
    urgent = t("orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return t("customer").join(urgent, "c_custkey", "left_anti").select("c_custkey")


@query(
    """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 2 = 0), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 3 = 0)
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'unexpected' ELSE 'both' END AS side FROM a FULL JOIN b ON a.k = b.k"""
)
def expected_full_diff(t: Tables) -> DataFrame:
    part = lambda n, name: t("orders").where(F.col("o_orderkey") % n == 0).select(F.col("o_custkey").alias("k")).distinct().withColumn(name, F.lit(True))
    side = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unexpected").otherwise("both")
    return part(2, "a").join(part(3, "b"), "k", "full").select("k", side.alias("side"))


@query("SELECT d.doc_id, l.quality, l.doc_id IS NULL AS unlabelled FROM documents d LEFT JOIN labels l USING (doc_id)")
def unknown_label_probe(t: Tables) -> DataFrame:
    marks = t("labels").select("doc_id", "quality", F.lit(True).alias("known"))
    return t("documents").select("doc_id").join(marks, "doc_id", "left").select("doc_id", "quality", F.col("known").isNull().alias("unlabelled"))


@query("SELECT n_nationkey, n_regionkey IN (SELECT r_regionkey FROM region WHERE r_regionkey <> 4) AS resolves FROM nation")
def replacement_integrity(t: Tables) -> DataFrame:
    known = t("region").where("r_regionkey <> 4").select(F.col("r_regionkey").alias("n_regionkey"), F.lit(True).alias("k"))
    return t("nation").join(known, "n_regionkey", "left").select("n_nationkey", F.col("k").isNotNull().alias("resolves"))


@query(
    """WITH g AS (SELECT r_regionkey, m FROM region, range(1, 13) AS x(m)), v AS (SELECT n_regionkey AS r_regionkey, month(o_orderdate) AS m, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
    SELECT r_regionkey, m::INT AS m, (r_regionkey * 12 + m - 1)::INT AS flat, coalesce(n, 0) AS n FROM g LEFT JOIN v USING (r_regionkey, m)"""
)
def cube_cross(t: Tables) -> DataFrame:
    """Every cell of region by month, with the flat index of the cell."""
    cells = t("region").select("r_regionkey", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    homes = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_regionkey").alias("r_regionkey"))
    seen = t("orders").join(homes, F.col("o_custkey") == F.col("c_custkey")).groupBy("r_regionkey", F.month("o_orderdate").alias("m")).agg(F.count("*").alias("n"))
    return cells.join(seen, ["r_regionkey", "m"], "left").select("r_regionkey", "m", (F.col("r_regionkey") * 12 + F.col("m") - 1).alias("flat"), F.coalesce("n", F.lit(0)).alias("n"))


@query(
    """WITH g AS (SELECT user_id, list(event_id ORDER BY event_id) AS a, list(value ORDER BY event_id) FILTER (event_type <> 'view') AS b FROM events GROUP BY 1)
    SELECT user_id, least(len(a), coalesce(len(b), 0)) AS pairs FROM g"""
)
def positional_zip_truncate(t: Tables) -> DataFrame:
    """Lists paired by place; the shorter one sets the length."""
    order = lambda c: F.array_sort(F.collect_list(c))
    both = t("events").groupBy("user_id").agg(order(F.struct("event_id", "value")).alias("a"), order(F.when(F.col("event_type") != "view", F.struct("event_id", "value"))).alias("b"))
    n = F.least(F.size("a"), F.size("b"))
    zipped = F.slice(F.arrays_zip(F.col("a.event_id").alias("x"), F.col("b.value").alias("y")), F.lit(1), n)
    return both.select("user_id", F.size(zipped).cast("bigint").alias("pairs"))


@query("SELECT l_returnflag, l_quantity::INT AS q, count(*) AS n FROM lineitem GROUP BY 1, 2")
def histogram_map(t: Tables) -> DataFrame:
    counts = t("lineitem").groupBy("l_returnflag", F.col("l_quantity").cast("int").alias("q")).agg(F.count("*").alias("n"))
    sorted_map = counts.groupBy("l_returnflag").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("q", "n")))).alias("h"))
    return sorted_map.select("l_returnflag", F.explode("h").alias("q", "n"))


@query("WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS o FROM orders GROUP BY 1, 2) SELECT o_custkey, o_orderpriority, n FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o) = 1")
def argmax_longest(t: Tables) -> DataFrame:
    counts = t("orders").groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("o"))
    return R.keep_first(counts, ["o_custkey"], [F.desc("n"), F.col("o")]).drop("o")


@query("WITH r AS (SELECT l_suppkey, l_quantity, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS k, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem) SELECT l_suppkey, l_quantity AS upper_median FROM r WHERE k = n // 2 + 1")
def upper_median(t: Tables) -> DataFrame:
    """From the counts of distinct values, so that rows combine before the shuffle: the first value with more than half at or below it."""
    counts = t("lineitem").groupBy("l_suppkey", "l_quantity").agg(F.count("*").alias("k"))
    w = W.partitionBy("l_suppkey")
    ranked = counts.select("l_suppkey", "l_quantity", F.sum("k").over(w.orderBy("l_quantity")).alias("upto"), F.sum("k").over(w).alias("n"))
    return ranked.where("upto > n div 2").groupBy("l_suppkey").agg(F.min("l_quantity").alias("upper_median"))


@query("SELECT l_partkey, count(*) AS n, count(DISTINCT l_quantity) AS kinds, min(l_shipdate)::DATE AS first_day, max(l_shipdate)::DATE AS last_day FROM lineitem GROUP BY 1 HAVING count(*) >= 20 AND count(DISTINCT l_quantity) > 1")
def qualifying_groups(t: Tables) -> DataFrame:
    return (
        t("lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.count_distinct("l_quantity").alias("kinds"), F.to_date(F.min("l_shipdate")).alias("first_day"), F.to_date(F.max("l_shipdate")).alias("last_day")).where("n >= 20 and kinds > 1")
    )


@query("SELECT doc_id FROM documents ORDER BY sha256(doc_id::VARCHAR), doc_id LIMIT 50")
def hash_ordered_sample(t: Tables) -> DataFrame:
    return t("documents").orderBy(F.sha2(F.col("doc_id").cast("string"), 256), "doc_id").limit(50).select("doc_id")


@query("SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id) <= 5")
def stratified_sample(t: Tables) -> DataFrame:
    return S.first_per_group(t("documents").select("doc_id", "lang"), ["lang"], [F.sha2(F.col("doc_id").cast("string"), 256), F.col("doc_id")], 5).drop("rank")


@query(
    """WITH s AS (SELECT page_id, url, (CASE WHEN contains(url, '/en/') THEN 3 ELSE 0 END) + (CASE WHEN contains(url, 'blog') THEN 2 ELSE 0 END) + (CASE WHEN url LIKE 'https%' THEN 1 ELSE 0 END) AS score FROM pages)
    SELECT page_id, score::INT AS score FROM s WHERE score > 0 ORDER BY score DESC, url, page_id LIMIT 40"""
)
def score_rank(t: Tables) -> DataFrame:
    url = F.col("url")
    score = sum((F.when(test, n).otherwise(0) for test, n in ((url.contains("/en/"), 3), (url.contains("blog"), 2), (url.startswith("https"), 1))), F.lit(0))
    return t("pages").select("page_id", "url", score.alias("score")).where("score > 0").orderBy(F.desc("score"), "url", "page_id").limit(40).drop("url")


@query("WITH m AS (SELECT event_type FROM events GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1) SELECT event_id, event_type FROM events WHERE event_type = (SELECT event_type FROM m)")
def modal_group(t: Tables) -> DataFrame:
    top = t("events").groupBy("event_type").count().orderBy(F.desc("count"), "event_type").limit(1).select("event_type")
    return t("events").select("event_id", "event_type").join(top, "event_type", "left_semi").select("event_id", "event_type")


@query(
    """WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, coalesce(sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) AS r FROM lineitem)
    SELECT l_suppkey, l_orderkey, l_linenumber FROM r WHERE s < 500 AND r <= 15"""
)
def take_until_total(t: Tables) -> DataFrame:
    return S.until_target(t("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], "l_quantity", target=500, most=15).drop("l_partkey", "l_quantity")


@query("SELECT DISTINCT user_id FROM (SELECT user_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r FROM events WHERE value > 10) WHERE r <= 20")
def first_n_accepted(t: Tables) -> DataFrame:
    return S.first_per_group(t("events").where("value > 10"), ["event_type"], ["event_id"], 20).select("user_id").distinct()


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01' ORDER BY o_orderdate, o_orderkey LIMIT 100")
def pushed_range_page(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t("orders").where((day >= F.lit("1995-01-01").cast("timestamp")) & (day < F.lit("1996-01-01").cast("timestamp"))).orderBy(day, "o_orderkey").limit(100).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 200")
def keyset_page(t: Tables) -> DataFrame:
    return t("orders").where("o_orderkey > 1000").select("o_orderkey").orderBy("o_orderkey").limit(200)


@query("SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 25")
def earliest_n_by_time(t: Tables) -> DataFrame:
    return t("events").select("event_id", "ts").orderBy("ts", "event_id").limit(25)


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 3")
def first_n_per_group(t: Tables) -> DataFrame:
    return S.first_per_group(t("events").select("user_id", "event_id"), ["user_id"], ["event_id"], 3).drop("rank")


@query("SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= CASE event_type WHEN 'click' THEN 3 WHEN 'purchase' THEN 10 ELSE 5 END")
def per_group_limits(t: Tables) -> DataFrame:
    most = F.when(F.col("event_type") == "click", 3).when(F.col("event_type") == "purchase", 10).otherwise(5)
    few = S.first_per_group(t("events").select("event_type", "event_id"), ["event_type"], ["event_id"], 10)  # the largest limit, below the shuffle
    return few.where(F.col("rank") <= most).drop("rank")


@query("SELECT p_partkey, row_number() OVER (ORDER BY CASE WHEN p_name LIKE '%ring' THEN 0 ELSE 1 END, length(p_name), p_name, p_partkey) AS place FROM part")
def custom_order(t: Tables) -> DataFrame:
    """Places in an order of one's own."""
    first = F.when(F.col("p_name").endswith("ring"), 0).otherwise(1)
    rows = t("part").select("p_partkey", first.alias("first"), F.length("p_name").alias("n"), "p_name")
    return placed(rows, ["first", "n", "p_name", "p_partkey"], "place").select("p_partkey", "place")


@query(
    """WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y') WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS period FROM orders),
    k AS (SELECT o_orderkey, period, substr(period, 1, 4)::INT * 10000 + (CASE WHEN length(period) > 4 THEN substr(period, 6, 2)::INT ELSE 0 END) * 100 + (CASE WHEN length(period) > 7 THEN substr(period, 9, 2)::INT ELSE 0 END) AS sort_key FROM p)
    SELECT o_orderkey, period, sort_key, row_number() OVER (ORDER BY sort_key, o_orderkey) AS place FROM k"""
)
def mixed_period_order(t: Tables) -> DataFrame:
    """Years, months and days in one order of time, a longer period before those inside it."""
    day, k = F.col("o_orderdate"), F.col("o_orderkey") % 3
    period = F.when(k == 0, F.date_format(day, "yyyy")).when(k == 1, F.date_format(day, "yyyy-MM")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    parts = F.split("period", "-")
    at = lambda i: F.coalesce(F.get(parts, F.lit(i)).cast("int"), F.lit(0))
    rows = t("orders").select("o_orderkey", period.alias("period")).withColumn("sort_key", at(0) * 10_000 + at(1) * 100 + at(2))
    return placed(rows, ["sort_key", "o_orderkey"], "place")


@query("SELECT event_id, json_extract_string(props, '$.page') AS page, props IS NULL OR json_extract_string(props, '$.page') IS NULL AS missing FROM events")
def json_nested_defaults(t: Tables) -> DataFrame:
    page = F.get_json_object("props", "$.page")
    return t("events").select("event_id", page.alias("page"), page.isNull().alias("missing"))


@query("SELECT conv_id, count(*) AS turns, string_agg(role, '>' ORDER BY turn, role) AS roles, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY 1")
def conversation_records(t: Tables) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    return t("conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.array_join(turns["role"], ">").alias("roles"), F.sum(F.length("text").cast("bigint")).alias("chars"))


@query("SELECT vec_id, len(embedding)::INT AS dims, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 5) AS norm, len(list_distinct(embedding)) = 1 AS constant FROM embeddings")
def array_constancy(t: Tables) -> DataFrame:
    square = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    return t("embeddings").select("vec_id", F.size("embedding").alias("dims"), F.round(F.sqrt(square), 5).alias("norm"), (F.size(F.array_distinct("embedding")) == 1).alias("constant"))


@query("SELECT vec_id, len(list_filter(embedding, lambda x, i: (i - 1) % 3 = 1))::INT AS n, embedding[2]::DOUBLE AS first_value FROM embeddings")
def deinterleave(t: Tables) -> DataFrame:
    channel = F.filter("embedding", lambda x, i: i % 3 == 1)
    return t("embeddings").select("vec_id", F.size(channel).alias("n"), F.get(channel, F.lit(0)).cast("double").alias("first_value"))


@query(
    """WITH g AS (SELECT user_id, list(event_id ORDER BY event_id) AS a, list(value ORDER BY event_id) FILTER (event_type <> 'view') AS b FROM events GROUP BY 1),
    n AS (SELECT user_id, a, b, unnest(range(1, least(len(a), coalesce(len(b), 0)) + 1)) AS i FROM g) SELECT user_id, i - 1 AS place, a[i] AS event_id, b[i] AS value FROM n"""
)
def positional_zip_rows(t: Tables) -> DataFrame:
    """The pairs of ``positional_zip_truncate`` themselves, a row each."""
    order = lambda c: F.array_sort(F.collect_list(c))
    both = t("events").groupBy("user_id").agg(order(F.struct("event_id", "value")).alias("a"), order(F.when(F.col("event_type") != "view", F.struct("event_id", "value"))).alias("b"))
    pairs = F.slice(F.arrays_zip(F.col("a.event_id").alias("x"), F.col("b.value").alias("y")), F.lit(1), F.least(F.size("a"), F.size("b")))
    return both.select("user_id", F.posexplode(pairs).alias("place", "z")).select("user_id", F.col("place").cast("bigint").alias("place"), F.col("z.x").alias("event_id"), F.col("z.y").alias("value"))
