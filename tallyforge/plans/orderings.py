"""Window-like queries: runs, order checks, running totals, turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.operators import sequences as S
from tallyforge.operators.ranks import placed
from tallyforge.registry import Tables, query


@query("WITH b AS (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) SELECT user_id, count(*) AS rows, count(*) FILTER (p <> event_type) AS transitions FROM b GROUP BY 1")
def transitions(t: Tables) -> DataFrame:
    return S.transitions(t("events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type")


@query(
    """WITH b AS (SELECT user_id, ts, event_id, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS n FROM events),
    i AS (SELECT user_id, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM b), c AS (SELECT user_id, g, count(*) AS k FROM i GROUP BY 1, 2)
    SELECT user_id, max(k) AS longest_run, count(*) AS runs FROM c GROUP BY 1"""
)
def longest_run(t: Tables) -> DataFrame:
    return S.longest_run(t("events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"], "event_type")


@query(
    """WITH b AS (SELECT o_custkey, o_totalprice AS v, lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders)
    SELECT o_custkey, coalesce(bool_and(v > p), true) AS strictly_rising, coalesce(bool_and(v >= p), true) AS never_falling, count(*) FILTER (v = p) AS repeats, count(*) FILTER (v < p) AS falls FROM b GROUP BY 1"""
)
def adjacent_delta_stats(t: Tables) -> DataFrame:
    return S.order_facts(t("orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], ["o_orderkey"], "o_totalprice")


@query(
    """WITH b AS (SELECT user_id, ts AS v, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events)
    SELECT user_id, coalesce(bool_and(v > p), true) AS strictly_rising, coalesce(bool_and(v >= p), true) AS never_falling, count(*) FILTER (v = p) AS repeats, count(*) FILTER (v < p) AS falls FROM b GROUP BY 1"""
)
def monotone_flags(t: Tables) -> DataFrame:
    return S.order_facts(t("events").select("user_id", "event_id", "ts"), ["user_id"], ["event_id"], "ts")


@query("WITH b AS (SELECT user_id, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS d FROM events) SELECT user_id, count(*) FILTER (d = 1) AS consecutive, max(d) AS widest FROM b GROUP BY 1")
def consecutive_ids(t: Tables) -> DataFrame:
    step = F.col("event_id") - F.lag("event_id").over(W.partitionBy("user_id").orderBy("event_id"))
    return t("events").select("user_id", step.alias("d")).groupBy("user_id").agg(F.count_if(F.col("d") == 1).alias("consecutive"), F.max("d").alias("widest"))


@query(
    """WITH d AS (SELECT label, list_distance(embedding::DOUBLE[], lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id)) AS step FROM embeddings)
    SELECT label, round(median(step), 5) AS median_step, round(max(step), 5) AS longest_step FROM d GROUP BY 1"""
)
def vector_steps(t: Tables) -> DataFrame:
    """The usual and the longest step from vector to vector of a label, over all their coordinates."""
    return vector_steps_whole(t).drop("steps")


@query(
    """WITH d AS (SELECT label, list_distance(embedding::DOUBLE[], lag(embedding::DOUBLE[]) OVER (PARTITION BY label ORDER BY vec_id)) AS step FROM embeddings)
    SELECT label, count(step) AS steps, round(median(step), 5) AS median_step, round(max(step), 5) AS longest_step FROM d GROUP BY 1"""
)
def vector_steps_whole(t: Tables) -> DataFrame:
    """Lengths of the steps from vector to vector of a label, over all their coordinates."""
    before = F.lag("embedding").over(W.partitionBy("label").orderBy("vec_id"))
    squares = F.zip_with("embedding", "before", lambda a, b: F.pow(a.cast("double") - b.cast("double"), 2))
    step = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, x: a + x))
    steps = t("embeddings").select("label", "embedding", before.alias("before")).select("label", step.alias("step"))
    return steps.groupBy("label").agg(F.count("step").alias("steps"), F.round(F.median("step"), 5).alias("median_step"), F.round(F.max("step"), 5).alias("longest_step"))


@query("SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header FROM events")
def ffill_header(t: Tables) -> DataFrame:
    rows = t("events").select("user_id", "ts", "event_id", "event_type")
    return S.fill_forward(rows, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "purchase", F.col("event_id")), "header").select("event_id", "header")


@query("WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM lineitem) SELECT * FROM r WHERE running <= 400")
def running_cap(t: Tables) -> DataFrame:
    rows = t("lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return S.running_total(rows, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"], "l_quantity").where("running <= 400").drop("l_partkey", "l_quantity")


@query("SELECT user_id, event_id FROM events QUALIFY ts < min(ts) OVER (PARTITION BY user_id) + INTERVAL 7 DAY")
def span_cutoff(t: Tables) -> DataFrame:
    start = t("events").groupBy("user_id").agg(F.min("ts").alias("start"))
    return t("events").join(start, "user_id").where("ts < start + interval 7 days").select("user_id", "event_id")


@query("SELECT user_id, date_trunc('hour', ts) AS ts, count(*) AS n, count(DISTINCT value) > 1 AS conflict FROM events GROUP BY ALL HAVING count(*) > 1")
def conflict_same_ts(t: Tables) -> DataFrame:
    """Rows of one user and hour, and whether their values disagree."""
    hours = t("events").groupBy("user_id", F.date_trunc("hour", "ts").alias("ts"))
    return hours.agg(F.count("*").alias("n"), (F.count_distinct("value") > 1).alias("conflict")).where("n > 1")


@query("SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id NULLS FIRST) AS turn FROM events")
def round_robin(t: Tables) -> DataFrame:
    """Every event's turn among its type's; sorting by turn, then type, interleaves the types."""
    return placed(t("events").select("event_type", "event_id"), ["event_id"], "turn", keys=("event_type",))


@query(
    """WITH r AS (SELECT event_type, user_id, event_id, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id NULLS FIRST) AS turn FROM events)
    SELECT event_type, user_id, event_id, turn, row_number() OVER (PARTITION BY event_type ORDER BY turn, user_id NULLS FIRST) AS type_turn FROM r"""
)
def round_robin_whole(t: Tables) -> DataFrame:
    """Every event with its turn among its type and user's, and its place among its type's when users take turns; sorting by type_turn, then type, interleaves the types."""
    turns = placed(t("events").select("event_type", "user_id", "event_id"), ["event_id"], "turn", keys=("event_type", "user_id"))
    return placed(turns, ["turn", "user_id"], "type_turn", keys=("event_type",))


@query(
    """WITH d AS (SELECT label, vec_id, list_dot_product(embedding::DOUBLE[], (lag(embedding) OVER w)::DOUBLE[]) AS dot, list_distance(embedding::DOUBLE[], (lag(embedding) OVER w)::DOUBLE[]) AS step FROM embeddings WINDOW w AS (PARTITION BY label ORDER BY vec_id))
    SELECT label, vec_id, round(dot, 5) AS dot, round(step, 5) AS step FROM d WHERE dot IS NOT NULL"""
)
def vector_dots(t: Tables) -> DataFrame:
    """Each vector against the one before it in its label, over all coordinates: dot product and distance."""
    before = F.lag("embedding").over(W.partitionBy("label").orderBy("vec_id"))
    pairs = t("embeddings").select("label", "vec_id", "embedding", before.alias("before")).where("before is not null")
    zipped = F.arrays_zip(F.col("embedding").cast("array<double>").alias("a"), F.col("before").cast("array<double>").alias("b"))
    add = lambda f: F.aggregate("z", F.lit(0.0), lambda acc, e: acc + f(e))
    out = pairs.select("label", "vec_id", zipped.alias("z"))
    return out.select("label", "vec_id", F.round(add(lambda e: e.a * e.b), 5).alias("dot"), F.round(F.sqrt(add(lambda e: (e.a - e.b) * (e.a - e.b))), 5).alias("step"))
