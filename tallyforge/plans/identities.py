"""Identity, conflict and shape checks: strict pairing, null-safe matches, capped and modal choices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.operators import records as R
from tallyforge.operators.ranks import placed
from tallyforge.registry import Tables, query


@query("WITH f AS (SELECT sha256(text) AS h, doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS first_id FROM documents) SELECT doc_id, CASE WHEN doc_id <> first_id THEN first_id END AS duplicate_of FROM f")
def duplicate_of(t: Tables) -> DataFrame:
    """The first row with the same content; found by aggregation and joined back, so that hot contents combine early."""
    rows = t("documents").select("doc_id", F.sha2("text", 256).alias("h"))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first_id"))
    return rows.join(first, "h").select("doc_id", F.when(F.col("doc_id") != F.col("first_id"), F.col("first_id")).alias("duplicate_of"))


@query("SELECT event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id) > 1")
def repeated_as_malformed(t: Tables) -> DataFrame:
    """Rows after the first of their user and hour."""
    w = W.partitionBy("user_id", F.date_trunc("hour", "ts")).orderBy("event_id")
    return t("events").select("event_id", F.row_number().over(w).alias("r")).where("r > 1").select("event_id")


@query("SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) = 1")
def dedupe_composite(t: Tables) -> DataFrame:
    return R.keep_first(t("lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"), ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber", "l_quantity"])


@query(
    """WITH e AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS want FROM customer), a AS (SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN c_nationkey END AS have FROM customer)
    SELECT count(*) FILTER (want IS NOT DISTINCT FROM have) AS agree, count(*) FILTER (want IS DISTINCT FROM have) AS differ FROM e JOIN a USING (c_custkey)"""
)
def expected_actual(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    want, have = (t("customer").select("c_custkey", F.when(k % n != 0, F.col("c_nationkey")).alias(name)) for n, name in ((4, "want"), (6, "have")))
    both = want.join(have, "c_custkey").withColumn("same", F.col("want").eqNullSafe(F.col("have")))
    return both.agg(F.count_if("same").alias("agree"), F.count_if(~F.col("same")).alias("differ"))


@query(
    """WITH a AS (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS r FROM lineitem WHERE l_linenumber % 2 = 0),
    b AS (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS r FROM lineitem WHERE l_linenumber % 2 = 1)
    SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, count(a.r) = count(b.r) AS pairs_up FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.r = b.r GROUP BY 1"""
)
def zip_strict(t: Tables) -> DataFrame:
    """Two lists pair up place by place only if they are equally long."""
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")
    side = lambda odd, name: t("lineitem").where(F.col("l_linenumber") % 2 == odd).select("l_orderkey", F.row_number().over(w).alias("r")).withColumn(name, F.lit(1))
    return side(0, "a").join(side(1, "b"), ["l_orderkey", "r"], "full").groupBy("l_orderkey").agg((F.count("a") == F.count("b")).alias("pairs_up"))


@query(
    """WITH x AS (SELECT user_id, ts::DATE AS day, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS v FROM events)
    SELECT user_id, day, CASE WHEN count(v) = count(*) THEN round(sum(v), 4) END AS total FROM x GROUP BY 1, 2"""
)
def all_valid_sum(t: Tables) -> DataFrame:
    """Sums per user and day; one invalid cell makes the sum null."""
    v = F.when(F.col("event_id") % 17 != 0, F.col("value"))
    cells = t("events").select("user_id", F.to_date("ts").alias("day"), v.alias("v"))
    return cells.groupBy("user_id", "day").agg(F.when(F.count("v") == F.count("*"), F.round(F.sum("v"), 4)).alias("total"))


@query("WITH n AS (SELECT c_mktsegment, c_nationkey, count(DISTINCT (c_custkey % 3)) AS k, min(c_custkey) AS o FROM customer GROUP BY 1, 2) SELECT c_mktsegment, c_nationkey, k, k > 1 AS conflict FROM n")
def identity_conflict(t: Tables) -> DataFrame:
    kinds = t("customer").groupBy("c_mktsegment", "c_nationkey").agg(F.count_distinct(F.col("c_custkey") % 3).alias("k"))
    return kinds.withColumn("conflict", F.col("k") > 1)


@query(
    """WITH p AS (SELECT o_orderkey, (o_orderkey % 14)::INT AS m, (o_orderkey % 33)::INT AS d FROM orders)
    SELECT m BETWEEN 1 AND 12 AND d BETWEEN 1 AND 31 AS plausible, count(*) AS n FROM p GROUP BY 1"""
)
def date_plausibility(t: Tables) -> DataFrame:
    """Month and day in range; whether the day exists is not asked."""
    text = F.concat_ws("-", F.lit("2001"), (F.col("o_orderkey") % 14).cast("string"), (F.col("o_orderkey") % 33).cast("string"))
    parts = F.split(text, "-")
    fits = parts[1].cast("int").between(1, 12) & parts[2].cast("int").between(1, 31)
    return t("orders").groupBy(fits.alias("plausible")).agg(F.count("*").alias("n"))


@query("SELECT vec_id, abs(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) - 1) <= 0.001 AS unit FROM embeddings")
def unit_norm(t: Tables) -> DataFrame:
    square = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    return t("embeddings").select("vec_id", (F.abs(F.sqrt(square) - 1) <= 0.001).alias("unit"))


@query("SELECT o_orderkey, o_orderdate::DATE AS day FROM orders")
def multi_format_dates(t: Tables) -> DataFrame:
    """Dates written in three ways, each tried in turn."""
    k, d = F.col("o_orderkey") % 3, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "yyyyMMdd'T'HHmmss"))
    read = F.coalesce(*(F.try_to_timestamp("text", F.lit(f)) for f in ("yyyy-MM-dd", "dd/MM/yyyy", "yyyyMMdd'T'HHmmss")))
    return t("orders").select("o_orderkey", text.alias("text")).select("o_orderkey", F.to_date(read).alias("day"))


@query("SELECT p_partkey, sha256(unhex(sha256(p_name))) AS twice FROM part")
def double_digest(t: Tables) -> DataFrame:
    return t("part").select("p_partkey", F.sha2(F.unhex(F.sha2("p_name", 256)), 256).alias("twice"))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def offset_page(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey").orderBy("o_orderkey").offset(100).limit(50)


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN 1.0 WHEN 2 THEN 0.0 ELSE epoch_ms(ts)::DOUBLE END AS v FROM events")
def polymorphic_scalar(t: Tables) -> DataFrame:
    """Numbers, words for truth and times read into one column."""
    k = F.col("event_id") % 4
    text = F.when(k == 0, F.col("value").cast("string")).when(k == 1, "true").when(k == 2, "False").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
    low = F.lower("text")
    v = F.when(low == "true", 1.0).when(low == "false", 0.0).otherwise(F.coalesce(F.col("text").try_cast("double"), F.unix_millis(F.to_timestamp(F.when(F.col("text").contains(":"), F.col("text")))).cast("double")))
    return t("events").select("event_id", text.alias("text")).select("event_id", v.alias("v"))


@query("WITH v AS (SELECT user_id, flatten(list([event_id::DOUBLE, value] ORDER BY event_id)) AS v FROM events GROUP BY 1) SELECT user_id, unnest(range(0, len(v))) AS place, unnest(v) AS value FROM v")
def interleave(t: Tables) -> DataFrame:
    """Two columns of a record as one vector in source order, an element a row."""
    rows = placed(t("events").select("user_id", "event_id", F.col("value").alias("v")), ["event_id"], "n", keys=("user_id",))
    both = F.posexplode(F.array(F.col("event_id").cast("double"), "v")).alias("side", "value")
    return rows.select("user_id", "n", both).select("user_id", (F.col("n") * 2 - 2 + F.col("side")).alias("place"), "value")


@query(
    """WITH g AS (SELECT l_suppkey, count(*) AS n, count(DISTINCT l_linestatus) AS kinds FROM lineitem GROUP BY 1)
    SELECT CASE WHEN kinds = 1 THEN 'uniform' WHEN n % 2 = 0 THEN 'even' ELSE 'odd' END AS label, count(*) AS groups, sum(n)::BIGINT AS total FROM g GROUP BY 1"""
)
def shape_labels(t: Tables) -> DataFrame:
    facts = t("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.size(F.collect_set("l_linestatus")).alias("kinds"))
    label = F.when(F.col("kinds") == 1, "uniform").when(F.col("n") % 2 == 0, "even").otherwise("odd")
    return facts.groupBy(label.alias("label")).agg(F.count("*").alias("groups"), F.sum("n").alias("total"))


@query("SELECT count(DISTINCT n) = 1 AS equal_lengths, min(n) AS low, max(n) AS high FROM (SELECT count(l_tax) AS n FROM lineitem UNION ALL SELECT count(l_discount) FROM lineitem UNION ALL SELECT count(l_quantity) FROM lineitem)")
def equal_lengths(t: Tables) -> DataFrame:
    names = ["l_tax", "l_discount", "l_quantity"]
    counts = t("lineitem").agg(*(F.count(c).alias(c) for c in names)).select(F.explode(F.array(*names)).alias("n"))
    return counts.agg((F.count_distinct("n") == 1).alias("equal_lengths"), F.min("n").alias("low"), F.max("n").alias("high"))


@query(
    """WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id NULLS FIRST) AS turn FROM events)
    SELECT event_type, event_id, row_number() OVER (ORDER BY turn, event_type NULLS FIRST) AS place FROM r"""
)
def round_robin_places(t: Tables) -> DataFrame:
    """Every event's place when the types take turns."""
    turns = placed(t("events").select("event_type", "event_id"), ["event_id"], "turn", keys=("event_type",))
    return placed(turns, ["turn", "event_type"], "place").select("event_type", "event_id", "place")


@query(
    """WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity <= 40 THEN l_quantity ELSE 0 END AS q FROM lineitem)
    SELECT l_suppkey, count(*) FILTER (q > 0) AS taken, sum(q) AS total, count(*) FILTER (q = 0) AS oversize FROM r GROUP BY 1"""
)
def skip_oversize(t: Tables) -> DataFrame:
    """Rows over the single-row cap are passed over instead of ending the scan."""
    q = F.when(F.col("l_quantity") <= 40, F.col("l_quantity")).otherwise(0.0)
    return t("lineitem").select("l_suppkey", q.alias("q")).groupBy("l_suppkey").agg(F.count_if(F.col("q") > 0).alias("taken"), F.sum("q").alias("total"), F.count_if(F.col("q") == 0).alias("oversize"))


@query("SELECT count(*) AS rows, count(*) FILTER (n_regionkey <> n_nationkey) AS edges, count(*) FILTER (n_regionkey = n_nationkey) AS loops FROM nation")
def self_loops(t: Tables) -> DataFrame:
    loop = F.col("n_regionkey") == F.col("n_nationkey")
    return t("nation").agg(F.count("*").alias("rows"), F.count_if(~loop).alias("edges"), F.count_if(loop).alias("loops"))


@query("SELECT s_suppkey, (s_nationkey * 7.5 - 90)::DOUBLE AS lat, (s_suppkey % 400 - 180)::DOUBLE AS lon FROM supplier WHERE s_nationkey * 7.5 - 90 BETWEEN -90 AND 90 AND s_suppkey % 400 - 180 BETWEEN -180 AND 180")
def coordinate_bounds(t: Tables) -> DataFrame:
    lat, lon = (F.col("s_nationkey") * 7.5 - 90).cast("double"), (F.col("s_suppkey") % 400 - 180).cast("double")
    return t("supplier").select("s_suppkey", lat.alias("lat"), lon.alias("lon")).where("lat between -90 and 90 and lon between -180 and 180")


@query("SELECT user_id, array_to_string(flatten(list([event_id::VARCHAR, (round(value * 100))::BIGINT::VARCHAR] ORDER BY event_id)), ' ') AS vector FROM events GROUP BY 1")
def interleave_values(t: Tables) -> DataFrame:
    """The vectors of ``interleave`` with all their values, in cents."""
    pairs = F.array_sort(F.collect_list(F.struct("event_id", F.round(F.col("value") * 100).cast("bigint").alias("cents"))))
    flat = F.flatten(F.transform("p", lambda e: F.array(e.event_id.cast("string"), e.cents.cast("string"))))
    return t("events").groupBy("user_id").agg(pairs.alias("p")).select("user_id", F.array_join(flat, " ").alias("vector"))
