"""Acceptance, distribution, degeneracy and registry audits over the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import records as R
from tallyforge.registry import Tables, query

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LONG_SQL = "l AS (UNPIVOT (SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME series_id VALUE value)"
INDEX_SQL = f"WITH {LONG_SQL}, i AS (SELECT series_id, l_suppkey AS record, count(value) AS value_count, count(value) * 8 AS sample_bytes FROM l GROUP BY ALL)"


def lineitem_long(t: Tables) -> DataFrame:
    return R.unpivot(t("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", *MEASURES), ["l_suppkey", "l_orderkey", "l_linenumber"], MEASURES)


def lineitem_index(t: Tables) -> DataFrame:
    return R.record_index(lineitem_long(t), "l_suppkey")


@query(
    INDEX_SQL
    + """, s AS (SELECT series_id, count(*) AS samples, sum(value_count)::BIGINT AS total_values, sum(sample_bytes)::BIGINT AS total_bytes,
      median(value_count)::DOUBLE AS median_values, min(value_count) AS min_values, max(value_count) AS max_values FROM i GROUP BY 1)
    SELECT *, concat_ws(',', CASE WHEN NOT (total_values >= 10000 OR total_bytes >= 100000) THEN 'total_below_floor' END, CASE WHEN median_values < 1000 THEN 'median_below_floor' END) AS reasons,
      CASE WHEN (total_values >= 10000 OR total_bytes >= 100000) AND median_values >= 1000 THEN 'ok' ELSE 'below_floor' END AS status FROM s"""
)
def acceptance_audit(t: Tables) -> DataFrame:
    return R.acceptance(lineitem_index(t), ["series_id"], min_values=10_000, min_bytes=100_000, min_median=1_000)


@query(
    INDEX_SQL
    + """, s AS (SELECT series_id, count(*) AS samples, sum(value_count)::BIGINT AS total_values, sum(sample_bytes)::BIGINT AS total_bytes,
      median(value_count)::DOUBLE AS median_values, min(value_count) AS min_values, max(value_count) AS max_values FROM i GROUP BY 1)
    SELECT *, concat_ws(',', CASE WHEN NOT (total_values >= 10000 AND total_bytes >= 1000000) THEN 'total_below_floor' END, CASE WHEN median_values < 100 THEN 'median_below_floor' END) AS reasons,
      CASE WHEN (total_values >= 10000 AND total_bytes >= 1000000) AND median_values >= 100 THEN 'ok' ELSE 'below_floor' END AS status FROM s"""
)
def acceptance_both_floors(t: Tables) -> DataFrame:
    return R.acceptance(lineitem_index(t), ["series_id"], min_values=10_000, min_bytes=1_000_000, min_median=100, either=False)


@query(
    INDEX_SQL
    + """, c AS (SELECT series_id, value_count, count(*) AS n FROM i GROUP BY ALL), m AS (SELECT series_id, max(n) / sum(n) AS mode_share FROM c GROUP BY 1)
    SELECT series_id, count(*) AS samples, sum(value_count)::BIGINT AS total, min(value_count) AS low, max(value_count) AS high,
      quantile_cont(value_count, 0.1) AS p10, quantile_cont(value_count, 0.25) AS p25, quantile_cont(value_count, 0.5) AS p50, quantile_cont(value_count, 0.75) AS p75, quantile_cont(value_count, 0.9) AS p90,
      any_value(mode_share) AS mode_share FROM i JOIN m USING (series_id) GROUP BY 1"""
)
def state_report_series(t: Tables) -> DataFrame:
    return R.distribution(lineitem_index(t), ["series_id"])


@query(
    """WITH c AS (SELECT o_custkey, count(*) AS value_count FROM orders GROUP BY 1)
    SELECT 'orders' AS dataset_id, count(*) AS samples, sum(value_count)::BIGINT AS total, min(value_count) AS low, max(value_count) AS high,
      quantile_cont(value_count, 0.1) AS p10, quantile_cont(value_count, 0.25) AS p25, quantile_cont(value_count, 0.5) AS p50, quantile_cont(value_count, 0.75) AS p75, quantile_cont(value_count, 0.9) AS p90,
      (SELECT max(n) / sum(n) FROM (SELECT count(*) AS n FROM c GROUP BY value_count)) AS mode_share FROM c"""
)
def state_report_dataset(t: Tables) -> DataFrame:
    index = t("orders").groupBy("o_custkey").agg(F.count("*").alias("value_count")).withColumn("dataset_id", F.lit("orders"))
    return R.distribution(index, ["dataset_id"])


@query(
    """WITH l AS (UNPIVOT (SELECT p_size::DOUBLE AS p_size, p_retailprice, 1.0::DOUBLE AS always, (CASE WHEN p_partkey = 1 THEN 1 ELSE 0 END)::DOUBLE AS rare, NULL::DOUBLE AS never FROM part) ON p_size, p_retailprice, always, rare, never INTO NAME series_id VALUE value),
    l2 AS (SELECT * FROM l UNION ALL SELECT 'never', NULL FROM part), c AS (SELECT series_id, value, count(value) AS n FROM l2 GROUP BY ALL),
    f AS (SELECT series_id, coalesce(sum(n), 0)::BIGINT AS value_count, count(*) FILTER (n > 0) AS distinct_values, min(n) FILTER (n > 0) AS least FROM c GROUP BY 1)
    SELECT series_id, value_count, distinct_values, CASE WHEN value_count = 0 THEN 'empty' WHEN distinct_values = 1 THEN 'constant' WHEN distinct_values = 2 AND least / value_count < 0.001 THEN 'binary_sparse' ELSE 'ok' END AS status FROM f"""
)
def degenerate_series(t: Tables) -> DataFrame:
    wide = t("part").select(
        "p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", F.lit(1.0).alias("always"), F.when(F.col("p_partkey") == 1, 1.0).otherwise(0.0).alias("rare"), F.lit(None).cast("double").alias("never")
    )
    return R.degenerate(R.unpivot(wide, ["p_partkey"], ["p_size", "p_retailprice", "always", "rare", "never"]), ["series_id"])


@query(
    """WITH r AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT count(*) AS records, sum(n)::BIGINT AS total, min(n) AS low, max(n) AS high, count(*) FILTER (n < 4) AS below_floor, count(*) FILTER (n < 4) / count(*) AS below_share FROM r"""
)
def natural_boundary(t: Tables) -> DataFrame:
    sizes = t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("records"), F.sum("n").alias("total"), F.min("n").alias("low"), F.max("n").alias("high"), F.count_if(F.col("n") < 4).alias("below_floor"), (F.count_if(F.col("n") < 4) / F.count("*")).alias("below_share"))


@query(
    """WITH r AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1), c AS (SELECT n, count(*) AS k FROM r GROUP BY 1)
    SELECT sum(k)::BIGINT AS records, count(*) AS distinct_sizes, max(k) / sum(k) AS same_size_fraction, count(*) = 1 AS identical_sample_sizes FROM c"""
)
def identical_sizes(t: Tables) -> DataFrame:
    sizes = t("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("k"))
    return sizes.agg(F.sum("k").alias("records"), F.count("*").alias("distinct_sizes"), (F.max("k") / F.sum("k")).alias("same_size_fraction"), (F.count("*") == 1).alias("identical_sample_sizes"))


@query(
    """WITH n AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey % 7 = 0 THEN 'retired' WHEN n_nationkey % 11 = 0 THEN 'lost' ELSE 'accepted' END AS status, CASE WHEN n_nationkey % 7 = 0 THEN n_nationkey + 20 END AS replacement_id FROM nation),
    a AS (SELECT * FROM n UNION ALL SELECT * FROM n WHERE id < 2)
    SELECT id, status, concat_ws(',', CASE WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'duplicate_id' END, CASE WHEN status NOT IN ('accepted', 'retired') THEN 'bad_status' END, CASE WHEN replacement_id IS NOT NULL AND replacement_id NOT IN (SELECT id FROM n) THEN 'dangling_replacement' END) AS problems FROM a"""
)
def registry_integrity(t: Tables) -> DataFrame:
    """Duplicate ids, unknown states and replacements that point nowhere."""
    from pyspark.sql import Window as W

    key = F.col("n_nationkey")
    rows = t("nation").select(key.alias("id"), F.when(key % 7 == 0, "retired").when(key % 11 == 0, "lost").otherwise("accepted").alias("status"), F.when(key % 7 == 0, key + 20).alias("replacement_id"))
    known = rows.select(F.col("id").alias("replacement_id"), F.lit(True).alias("known"))
    every = rows.unionByName(rows.where("id < 2")).join(known, "replacement_id", "left")
    every = every.withColumn("_n", F.count("*").over(W.partitionBy("id")))
    problems = F.concat_ws(
        ",",
        F.when(F.col("_n") > 1, "duplicate_id"),
        F.when(~F.col("status").isin("accepted", "retired"), "bad_status"),
        F.when(F.col("replacement_id").isNotNull() & F.col("known").isNull(), "dangling_replacement"),
    )
    return every.select("id", "status", problems.alias("problems"))


@query(
    """WITH s AS (SELECT o_orderkey AS k, o_totalprice AS stated FROM orders), i AS (SELECT l_orderkey AS k, count(*) AS lines, sum(l_extendedprice) AS summed FROM lineitem GROUP BY 1)
    SELECT coalesce(s.k, i.k) AS k, coalesce(lines, 0) AS lines, CASE WHEN i.k IS NULL THEN 'no_index' WHEN s.k IS NULL THEN 'no_stats' WHEN abs(stated - summed) <= 0.01 * summed THEN 'agrees' ELSE 'differs' END AS state FROM s FULL JOIN i ON s.k = i.k"""
)
def stats_reconciliation(t: Tables) -> DataFrame:
    stats = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("stated"), F.lit(True).alias("s"))
    index = t("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("lines"), F.sum("l_extendedprice").alias("summed"))
    state = F.when(F.col("lines").isNull(), "no_index").when(F.col("s").isNull(), "no_stats").when(F.abs(F.col("stated") - F.col("summed")) <= 0.01 * F.col("summed"), "agrees").otherwise("differs")
    return stats.join(index, "k", "full").select("k", F.coalesce("lines", F.lit(0)).alias("lines"), state.alias("state"))


@query("SELECT d.doc_id, regexp_matches(d.text, 'http|www') AS rule_link, contains(d.text, '@') AND contains(d.text, '.') AS rule_mail, contains(lower(d.text), 'licensed under') AS rule_license FROM documents d")
def bag_of_rules(t: Tables) -> DataFrame:
    """Rules that hold when all their needles stand in the text."""
    text = F.col("text")
    return t("documents").select("doc_id", text.rlike("http|www").alias("rule_link"), (text.contains("@") & text.contains(".")).alias("rule_mail"), F.lower(text).contains("licensed under").alias("rule_license"))


@query("SELECT i.item_id, count(d.doc_id) AS copies FROM benchmark i LEFT JOIN documents d ON d.text = i.text GROUP BY 1")
def eval_isolation(t: Tables) -> DataFrame:
    """Evaluation items that stand in the training table word for word: none may."""
    items = t("benchmark").select("item_id", "text")
    met = t("documents").select("doc_id", "text").join(items.select("text").distinct(), "text", "left_semi")  # the smaller side is the one to move
    counts = met.groupBy("text").agg(F.count("doc_id").alias("n"))
    return items.join(counts, "text", "left").groupBy("item_id").agg(F.sum(F.coalesce("n", F.lit(0))).alias("copies"))


@query(
    """WITH g AS (SELECT user_id, count(*) AS n, count(DISTINCT value) AS kinds, min(value) AS low, max(value) AS high, count(*) FILTER (value IS NULL) AS missing FROM events GROUP BY 1)
    SELECT user_id, n, n >= 5 AND kinds > 1 AND missing = 0 AS eligible FROM g"""
)
def eligibility_profile(t: Tables) -> DataFrame:
    facts = t("events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("value").alias("kinds"), F.count_if(F.col("value").isNull()).alias("missing"))
    return facts.select("user_id", "n", ((F.col("n") >= 5) & (F.col("kinds") > 1) & (F.col("missing") == 0)).alias("eligible"))


@query(
    """WITH b AS (SELECT l_suppkey, sum(l_quantity) AS used FROM lineitem GROUP BY 1)
    SELECT l_suppkey, used, CASE WHEN used > 20000 THEN 'over_hard_cap' WHEN used > 15000 THEN 'over_soft_cap' ELSE 'ok' END AS state, CASE WHEN used = round(used) THEN printf('%d', used::BIGINT) ELSE printf('%.1f', used) END AS shown FROM b"""
)
def soft_hard_cap(t: Tables) -> DataFrame:
    used = t("lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("used"))
    state = F.when(F.col("used") > 20000, "over_hard_cap").when(F.col("used") > 15000, "over_soft_cap").otherwise("ok")
    shown = F.when(F.col("used") == F.round("used"), F.col("used").cast("bigint").cast("string")).otherwise(F.format_string("%.1f", "used"))
    return used.select("l_suppkey", "used", state.alias("state"), shown.alias("shown"))
