"""Queries over groups of any size: exact quantiles, bounded distinct values, rules as a table, hash trees, spread places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions import parsing as P
from tallyforge.operators import fixpoints as X
from tallyforge.operators.quantiles import bounded_distinct, quantiles
from tallyforge.operators import records as R
from tallyforge.operators.ranks import placed
from tallyforge.operators.rules import rules_met
from tallyforge.operators.wordpieces import word_codes
from tallyforge.registry import Tables, query

SHARES = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p999": 0.999}


@query(
    "SELECT l_returnflag, l_linestatus, "
    + ", ".join(f"quantile_cont({c}::DOUBLE, {s}) AS {n}_{p}" for c, n in (("l_extendedprice", "price"), ("l_quantity", "quantity")) for p, s in SHARES.items())
    + " FROM lineitem GROUP BY 1, 2"
)
def exact_quantiles(t: Tables) -> DataFrame:
    """Quantiles of a few very large groups, narrowed down by histograms."""
    found = quantiles(t("lineitem"), ["l_returnflag", "l_linestatus"], ["l_extendedprice", "l_quantity"], list(SHARES.values()))
    named = [F.col(c)[i].alias(f"{n}_{p}") for c, n in (("l_extendedprice", "price"), ("l_quantity", "quantity")) for i, p in enumerate(SHARES)]
    return found.select("l_returnflag", "l_linestatus", *named)


KINDS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]


@query(
    f"""WITH u AS ({" UNION ALL ".join(f"SELECT '{c}' AS name, {c}::VARCHAR AS v FROM lineitem" for c in KINDS)} UNION ALL SELECT 'l_quantity', l_quantity::BIGINT::VARCHAR FROM lineitem)
    SELECT name, least(count(DISTINCT v), 257) AS kinds, count(DISTINCT v) > 256 AS overflow, CASE WHEN count(DISTINCT v) <= 256 THEN string_agg(DISTINCT v, ',' ORDER BY v) END AS kept FROM u GROUP BY 1"""
)
def column_kinds(t: Tables) -> DataFrame:
    """The distinct values of each column, as long as there are no more than 256."""
    rows = t("lineitem").select(*(F.col(c).cast("string").alias(c) for c in KINDS), F.col("l_quantity").cast("bigint").cast("string").alias("l_quantity"))
    found = bounded_distinct(rows.unpivot([], [*KINDS, "l_quantity"], "name", "v"), ["name"], "v")
    return found.select("name", "kinds", "overflow", F.array_join("values", ",").alias("kept"))


RULES_SQL = r"""
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x40\x5B-\x60\x7B-\x7F]{4,}') AS w FROM benchmark),
r AS (SELECT item_id::VARCHAR AS rule, list_distinct([w[1], w[len(w) // 2 + 1], w[len(w)]]) AS needles FROM b WHERE len(w) >= 3)
"""


@query(
    f"""WITH {RULES_SQL}, n AS (SELECT rule, unnest(needles) AS needle, len(needles) AS need FROM r),
    m AS (SELECT doc_id, rule FROM documents, n WHERE contains(lower(text), needle) GROUP BY doc_id, rule, need HAVING count(*) = need)
    SELECT doc_id, coalesce(string_agg(rule, ',' ORDER BY rule), '') AS rules FROM documents LEFT JOIN m USING (doc_id) GROUP BY 1"""
)
def rules_of_table(t: Tables) -> DataFrame:
    """Which rules of a table hold for each whole text: each benchmark item makes one of its first, middle and last long word."""
    words = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]{4,}"), 0)
    rules = t("benchmark").select(F.col("item_id").cast("string").alias("rule_id"), words.alias("w")).where("size(w) >= 3")
    rules = rules.select("rule_id", F.array(F.col("w")[0], F.element_at("w", F.expr("size(w) div 2 + 1").cast("int")), F.element_at("w", -1)).alias("needles"))
    return rules_met(t("documents"), rules).select("doc_id", F.array_join("rules", ",").alias("rules"))


def _twice(value: Column) -> Column:
    return F.sha2(F.unhex(F.sha2(value, 256)), 256)


@query(
    """WITH RECURSIVE o AS (SELECT 'p:' || o_orderpriority AS block, o_orderkey FROM orders UNION ALL SELECT 'c:' || o_custkey, o_orderkey FROM orders),
    l AS (SELECT block, row_number() OVER (PARTITION BY block ORDER BY o_orderkey) - 1 AS place, count(*) OVER (PARTITION BY block) AS n, sha256(unhex(sha256(o_orderkey::VARCHAR))) AS h FROM o),
    t AS (SELECT block, place, n, h FROM l UNION ALL SELECT block, place // 2, (n + 1) // 2, sha256(unhex(sha256(unhex(arg_min(h, place)) || unhex(arg_max(h, place))))) FROM t WHERE n > 1 GROUP BY block, place // 2, (n + 1) // 2)
    SELECT block, h AS root FROM t WHERE n = 1"""
)
def hash_trees(t: Tables) -> DataFrame:
    """The hash trees over the orders of each customer and of each priority, from one leaf to very many."""
    rows = t("orders").select("o_orderkey", F.explode(F.array(F.concat(F.lit("p:"), "o_orderpriority"), F.concat(F.lit("c:"), "o_custkey"))).alias("block"))
    leaves = placed(rows, ["o_orderkey"], "place", keys=("block",)).select("block", (F.col("place") - 1).alias("place"), _twice(F.col("o_orderkey").cast("string").cast("binary")).alias("h"))
    return X.merkle_roots(leaves, ["block"], "place", "h", lambda a, b: _twice(F.concat(F.unhex(a), F.unhex(b))))


@query(
    """WITH g AS (SELECT p_partkey, p_size AS across, (p_partkey % 50 + 1)::INT AS down, (p_partkey % 9 + 1)::INT AS count FROM part),
    p AS (SELECT *, unnest(range(9)) AS k FROM g),
    xy AS (SELECT p_partkey, count, k, across, CASE WHEN across > 2 THEN least(greatest(1, round_even((k % 3 + 1) * across / 4.0, 0)), across - 2) ELSE least(greatest(0, round_even((k % 3 + 1) * across / 4.0, 0)), across - 1) END::INT AS x,
      CASE WHEN down > 2 THEN least(greatest(1, round_even((k // 3 + 1) * down / 4.0, 0)), down - 2) ELSE least(greatest(0, round_even((k // 3 + 1) * down / 4.0, 0)), down - 1) END::INT AS y FROM p),
    f AS (SELECT p_partkey, count, x, y, y * across + x AS tile, min(k) AS k FROM xy GROUP BY ALL)
    SELECT p_partkey, tile, x, y, (row_number() OVER (PARTITION BY p_partkey ORDER BY k))::INT AS place FROM f QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY k) <= count"""
)
def tile_places(t: Tables) -> DataFrame:
    """Up to so many tiles spread over each grid, whose sides are a part's size and a number of its key."""
    key = F.col("p_partkey")
    grids = t("part").select("p_partkey", F.col("p_size").alias("across"), (key % 50 + 1).cast("int").alias("down"), (key % 9 + 1).cast("int").alias("most"))
    tiles = P.spread_tiles(F.col("across"), F.col("down"), F.col("most"))
    return grids.select("p_partkey", F.posexplode(tiles).alias("at", "e")).select("p_partkey", "e.tile", "e.x", "e.y", (F.col("at") + 1).alias("place"))


@query(
    """WITH e AS (SELECT user_id, event_type, event_id, CASE WHEN event_id % 5 = 1 AND user_id % 4 = 1 THEN ts - INTERVAL 3 DAY ELSE ts END AS ts, CASE WHEN user_id % 3 = 0 AND event_id % 40 = 7 THEN NULL WHEN user_id % 3 = 1 AND event_id % 9 = 4 THEN value ELSE floor(value / 4) END AS v FROM events),
    b AS (SELECT *, ts < lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS falls FROM e),
    g AS (SELECT user_id, event_type, count(*) AS observations, count(v) AS numeric_values, count(*) FILTER (v = floor(v)) AS integer_values, min(v) AS minimum, max(v) AS maximum, count(DISTINCT v::INT) FILTER (v = floor(v) AND v BETWEEN 0 AND 255) AS distinct_bytes,
      NOT coalesce(bool_or(falls), false) AS monotonic, bool_and(coalesce(v = floor(v) AND v BETWEEN 0 AND 255, false)) AS complete FROM b GROUP BY 1, 2)
    SELECT *, observations >= 8 AND complete AND monotonic AND distinct_bytes > 1 AS selected FROM g"""
)
def byte_eligibility(t: Tables) -> DataFrame:
    """Whether each user's events of a type make a series of bytes, with all that speaks for or against it."""
    user, event = F.col("user_id"), F.col("event_id")
    ts = F.when((event % 5 == 1) & (user % 4 == 1), F.col("ts") - F.expr("interval 3 days")).otherwise(F.col("ts"))
    v = F.when((user % 3 == 0) & (event % 40 == 7), None).when((user % 3 == 1) & (event % 9 == 4), F.col("value")).otherwise(F.floor(F.col("value") / 4).cast("double"))
    return R.eligibility(t("events").select("user_id", "event_type", "event_id", ts.alias("ts"), v.alias("v")), ["user_id", "event_type"], "event_id", "ts", "v", least=8)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 200 >= 100 THEN o_orderkey % 200 + 1900 WHEN o_orderkey % 200 >= 70 THEN o_orderkey % 200 + 1900 ELSE o_orderkey % 200 + 2000 END AS year FROM orders WHERE o_orderkey % 200 < 100 UNION ALL SELECT o_orderkey, o_orderkey % 200 + 1870 FROM orders WHERE o_orderkey % 200 >= 100")
def two_digit_years(t: Tables) -> DataFrame:
    """Years written with two digits, from 70 on in the last century, beside years written in full."""
    k = F.col("o_orderkey") % 200
    return t("orders").select("o_orderkey", P.full_year(F.when(k < 100, k).otherwise(k + 1870)).alias("year"))


PIECES_SQL = r"""
w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents),
b AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS x FROM benchmark),
v AS (SELECT DISTINCT piece, inside FROM (SELECT substr(x, 1, n) AS piece, false AS inside FROM b, range(1, 5) AS r(n) WHERE length(x) >= n UNION ALL SELECT substr(x, length(x) - n + 1, n), true FROM b, range(1, 4) AS r(n) WHERE length(x) > n))
"""


@query(
    f"""WITH RECURSIVE {PIECES_SQL},
    g AS (SELECT word, 0 AS at_, '' AS pieces FROM w UNION ALL SELECT word, at_ + max(length(piece))::INT, any_value(pieces) || ' ' || arg_max(piece, length(piece)) FROM g JOIN v ON inside = (at_ > 0) AND starts_with(substr(word, at_ + 1), piece) WHERE at_ < length(word) GROUP BY word, at_)
    SELECT word, coalesce(max(trim(pieces)) FILTER (at_ = length(word)), '?') AS pieces FROM g GROUP BY 1"""
)
def words_in_pieces(t: Tables) -> DataFrame:
    """Every distinct word of the documents in pieces of benchmark words, the longest first; one that cannot be spelled is unknown."""
    words = lambda name: t(name).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("word")).distinct()
    n = F.length("word")
    starts = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(4))), lambda k: F.struct(F.substr("word", F.lit(1), k).alias("piece"), F.lit(False).alias("inside")))
    ends = F.transform(F.filter(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda k: k < n), lambda k: F.struct(F.substr("word", n - k + 1, k).alias("piece"), F.lit(True).alias("inside")))
    pieces = words("benchmark").select(F.explode(F.concat(starts, ends)).alias("e")).select("e.piece", "e.inside").distinct()
    vocabulary = R.dictionary(pieces.select("piece").distinct(), "piece", capacity=None).join(pieces, "piece").select("piece", "inside", F.col("code").alias("id"))
    coded = word_codes(words("documents"), vocabulary, longest=None)
    return coded.select("word", F.coalesce(F.array_join("pieces", " "), F.lit("?")).alias("pieces"))


@query(
    """WITH r AS (SELECT user_id, month(ts) AS month, CASE WHEN event_id % 13 = 0 THEN 'blank' WHEN value < 5 THEN 'too_low' WHEN value > 90 THEN 'too_high' ELSE 'accepted' END AS reason FROM events)
    SELECT user_id, month::INT AS month, reason, count(*) AS rows FROM r GROUP BY ALL"""
)
def reject_reasons_by_month(t: Tables) -> DataFrame:
    """Why rows are rejected, counted for each source and month."""
    reasons = {"blank": F.col("event_id") % 13 == 0, "too_low": F.col("value") < 5, "too_high": F.col("value") > 90}
    return R.rejected(t("events"), reasons).groupBy("user_id", F.month("ts").alias("month"), "reason").agg(F.count("*").alias("rows"))
