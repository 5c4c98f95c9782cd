"""Queries whose steps repeat until nothing changes: self-sized records, trees, crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.operators import fixpoints as X
from tallyforge.registry import Tables, query
from tallyforge.sources.self_sized import frames, number

LINES_SQL = """
c AS (SELECT c_nationkey AS file, o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey),
i AS (SELECT file, l_orderkey AS o_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS pos, l_quantity::BIGINT AS v FROM lineitem JOIN c ON l_orderkey = o_orderkey),
h AS (SELECT file, o_orderkey, 0 AS pos, coalesce(max(i.pos), 0) AS v FROM c LEFT JOIN i USING (file, o_orderkey) GROUP BY 1, 2),
n AS (SELECT file, v, row_number() OVER (PARTITION BY file ORDER BY o_orderkey, pos) AS line FROM (FROM h UNION ALL BY NAME FROM i))
"""


def order_lines(t: Tables) -> DataFrame:
    """file, line, v: each nation's orders as a text file would hold them, a count and then that many lines."""
    files = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("file"))
    orders = t("orders").select("o_custkey", "o_orderkey").join(files, "o_custkey").select("file", "o_orderkey")
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity")
    items = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.row_number().over(w).alias("at"), F.col("l_quantity").cast("long").alias("v"))
    counts = items.groupBy("o_orderkey").agg(F.count("*").alias("v"))
    heads = orders.join(counts, "o_orderkey", "left").select("file", "o_orderkey", F.lit(0).alias("at"), F.coalesce("v", F.lit(0)).alias("v"))
    rows = heads.unionByName(orders.join(items, "o_orderkey"))
    return X.placed(rows, ["o_orderkey", "at"], "line", keys=("file",)).select("file", "line", "v")


@query(
    f"""WITH RECURSIVE {LINES_SQL},
    s AS (SELECT file, line, v, 0 AS record FROM n WHERE line = 1 UNION ALL SELECT n.file, n.line, n.v, s.record + 1 FROM s JOIN n ON n.file = s.file AND n.line = s.line + s.v + 1)
    SELECT s.file, s.record, s.line, s.v + 1 AS size, 'whole' AS state, coalesce(sum(n.v), 0)::BIGINT AS total FROM s LEFT JOIN n ON n.file = s.file AND n.line > s.line AND n.line <= s.line + s.v GROUP BY ALL"""
)
def self_sized_lines(t: Tables) -> DataFrame:
    """Records of files in which only a record's first line says how many lines it has; any line could be taken for one."""
    lines = order_lines(t)
    found = X.self_sized(lines, ["file"], "line", F.col("v") + 1)
    inside = found.where("state = 'whole'").select("file", "record", F.explode(F.sequence(F.col("line") + 1, F.col("line") + F.col("size"))).alias("line"), (F.col("line") + F.col("size")).alias("_end"))
    sums = inside.where("line < _end").join(lines, ["file", "line"]).groupBy("file", "record").agg(F.sum("v").alias("total"))
    return found.join(sums, ["file", "record"], "left").select("file", "record", "line", "size", "state", F.coalesce("total", F.lit(0)).alias("total"))


@query(
    r"""WITH RECURSIVE p AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM conversations WHERE text IS NOT NULL),
    o AS (SELECT conv_id, turn, w, coalesce(sum(len(w)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM p),
    n AS (SELECT conv_id, turn, before + unnest(range(1, len(w) + 1)) - 1 AS place, 1 + length(unnest(w)) % 7 AS size FROM o),
    e AS (SELECT conv_id, max(place) AS last FROM n GROUP BY 1),
    s AS (SELECT conv_id, place, size, turn, 0 AS record FROM n WHERE place = 0 UNION ALL SELECT n.conv_id, n.place, n.size, n.turn, s.record + 1 FROM s JOIN n ON n.conv_id = s.conv_id AND n.place = s.place + s.size)
    SELECT s.conv_id, s.record, s.place, s.size::BIGINT AS size, CASE WHEN s.place + s.size - 1 > last THEN 'truncated' ELSE 'whole' END AS state, s.turn, count(DISTINCT n.turn) > 1 AS crosses
    FROM s JOIN e USING (conv_id) JOIN n ON n.conv_id = s.conv_id AND n.place BETWEEN s.place AND s.place + s.size - 1 GROUP BY ALL"""
)
def chained_frames(t: Tables) -> DataFrame:
    """Frames in the words of a conversation, each frame's first word stating its length, across the borders of turns as a stream's frames run across packets."""
    words = F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda w: w != "")
    sizes = F.array_join(F.transform(words, lambda w: F.char(F.length(w) % 7 + 1)), "")
    return word_frames(t("conversations").where("text is not null").select("conv_id", "turn", F.encode(sizes, "UTF-8").alias("sizes")))


def word_frames(turns: DataFrame, block: int = X.BLOCK) -> DataFrame:
    """conv_id, record, place, size, state, turn, crosses from each turn's ``sizes``, a byte for each of its words; no row a word is made."""
    n = F.length("sizes")
    w = W.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"))
    given = turns.where(n > 0).withColumn("_at", F.coalesce(F.sum(n).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    given = given.withColumn("_end", F.sum(n).over(w.rangeBetween(W.unboundedPreceding, 0)))
    more = F.col("_end") < F.max(F.when(F.col("turn").isNotNull(), F.col("_end"))).over(W.partitionBy("conv_id"))
    given = given.withColumn("_end", F.when(more, F.col("_end")))
    parts = given.select("*", F.explode(F.sequence(X.block_of("_at", block), F.expr(f"(_at + length(sizes) - 1) div {block}"))).alias("_b"))
    parts = parts.withColumns({"_from": F.greatest("_at", F.col("_b") * block), "_to": F.least(F.col("_at") + n, (F.col("_b") + 1) * block)})
    parts = parts.withColumn("_d", F.substr("sizes", (F.col("_from") - F.col("_at") + 1).cast("int"), (F.col("_to") - F.col("_from")).cast("int")))
    first = F.expr(f"_from % {block}").cast("int")
    marks = F.array_sort(F.collect_list(F.struct(first.alias("_p"), "turn", "_end")))
    blocks = parts.groupBy("conv_id", "_b").agg(F.min(first).alias("_low"), F.expr("listagg(_d) within group (order by _from)").alias("_n"), marks.alias("_m"))
    found = X.followed(blocks, ["conv_id"], "place", block)
    return found.select("conv_id", "record", "place", "size", "state", "turn", F.coalesce(F.col("place") + F.col("size") > F.col("_end"), F.lit(False)).alias("crosses"))


@query(
    """WITH RECURSIVE n AS (SELECT event_id AS node, value, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER b ELSE lag(event_id) OVER w END AS parent
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id), b AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    up AS (SELECT node AS leaf, node, parent, (value * 100)::BIGINT AS cents, 0 AS steps FROM n UNION ALL SELECT leaf, n.node, n.parent, cents, steps + 1 FROM up JOIN n ON n.node = up.parent)
    SELECT node, count(*) AS below, sum(cents)::BIGINT AS cents, max(depth) AS depth FROM up JOIN (SELECT leaf AS node, max(steps)::BIGINT AS depth FROM up GROUP BY 1) USING (node) GROUP BY 1"""
)
def event_trees(t: Tables) -> DataFrame:
    """What follows from each event: an error begins a tree, a view belongs to the user's last purchase, others to the event before."""
    w = W.partitionBy("user_id").orderBy("event_id")
    bought = F.last(F.when(F.col("event_type") == "purchase", F.col("event_id")), ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    parent = F.when(F.col("event_type") == "view", bought).when(F.col("event_type") != "error", F.lag("event_id").over(w))
    nodes = t("events").select(F.col("event_id").alias("node"), parent.alias("parent"), F.round(F.col("value") * 100).cast("long").alias("v"))
    return X.subtree_sums(nodes, "node", "parent", {"cents": F.col("v")})


@query(
    r"""SELECT conv_id, sum(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')))::BIGINT AS matches FROM conversations WHERE text IS NOT NULL GROUP BY 1"""
)
def nested_matches(t: Tables) -> DataFrame:
    """Match lists counted at every depth of nested documents: each turn of a conversation is a node inside the one before."""
    words = F.filter(F.split("text", "[ \\x09-\\x0D]+"), lambda w: w != "")
    match = F.transform(words, lambda w: F.struct(F.length(w).alias("n")))
    turns = t("conversations").where("text is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", match.alias("match"))), asc=False).alias("turns"))
    body = F.aggregate("turns", F.lit(""), lambda inner, e: F.concat(F.lit('{"match":'), F.to_json(e["match"]), F.lit(',"nodes":['), inner, F.lit("]}")))
    return X.variant_counts(turns.select("conv_id", F.parse_json(body).alias("body")), "conv_id", "body", "match")


LINK_SQL = """
r AS (SELECT url AS page, 'dir:' || unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS "to" FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
l AS (SELECT page, "to" FROM r UNION SELECT "to", page FROM r)
"""


def page_links(t: Tables) -> DataFrame:
    """page, to: pages link to the listings that they name, and a listing to all pages that name it."""
    read = t("pages").where("url is not null and html is not null")
    there = read.select(F.col("url").alias("page"), F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), 1)).alias("to"))
    there = there.withColumn("to", F.concat(F.lit("dir:"), "to"))
    return there.unionByName(there.select(F.col("to").alias("page"), F.col("page").alias("to"))).distinct()


CRAWL_SQL = f"""
WITH RECURSIVE {LINK_SQL},
w AS (SELECT min(page) AS page, 0 AS depth FROM l WHERE page LIKE 'http%' AND page NOT LIKE '%#top'
      UNION SELECT "to", depth + 1 FROM w JOIN l USING (page) WHERE depth < 12 AND "to" NOT LIKE '%#top' AND ("to" LIKE 'http%' OR "to" LIKE 'dir:%')),
d AS (SELECT page, min(depth) AS depth FROM w GROUP BY 1),
v AS (SELECT page, depth, row_number() OVER (ORDER BY depth, page) AS place FROM d QUALIFY place <= 300)
"""


@query(CRAWL_SQL + "SELECT page, depth::INT AS depth, place FROM v")
def crawl_pages(t: Tables) -> DataFrame:
    """The first 300 listings and pages that a bounded crawl reads from one page on."""
    return _crawled(t)[0]


@query(CRAWL_SQL + """, x AS (SELECT "to" AS label, min(place) AS first_place FROM v JOIN l USING (page) WHERE "to" LIKE '%#top' AND "to" LIKE 'http%' GROUP BY 1)
SELECT label, row_number() OVER (ORDER BY first_place, label) AS rank FROM x QUALIFY rank <= 60""")
def crawl_labels(t: Tables) -> DataFrame:
    """The first 60 labels (addresses that end in a mark) that the crawl's pages name."""
    return _crawled(t)[1].withColumnRenamed("place", "rank")


def _crawled(t: Tables) -> tuple[DataFrame, DataFrame]:
    links = page_links(t)
    label = F.col("page").endswith("#top")
    seed = links.where(F.col("page").startswith("http") & ~label).agg(F.min("page").alias("page"))
    return X.crawl(links, seed, prefixes=["http", "dir:"], label=label, most_pages=300, most_labels=60)


@query(
    """WITH RECURSIVE p AS (SELECT conv_id, turn, hex(encode(text)) AS h FROM conversations WHERE text IS NOT NULL AND text <> ''),
    o AS (SELECT conv_id, h, coalesce(sum(len(h) // 2) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM p),
    n AS (SELECT conv_id, before + i AS place, 2 + ('0x' || substr(h, 2 * i::INT + 1, 2))::BIGINT % 32 AS size FROM (SELECT conv_id, h, before, unnest(range(0, len(h) // 2)) AS i FROM o)),
    e AS (SELECT conv_id, max(place) AS last FROM n GROUP BY 1),
    s AS (SELECT conv_id, place, size, 0 AS record FROM n WHERE place = 0 UNION ALL SELECT n.conv_id, n.place, n.size, s.record + 1 FROM s JOIN n ON n.conv_id = s.conv_id AND n.place = s.place + s.size)
    SELECT conv_id, record, place, size, CASE WHEN place + size - 1 > last THEN 'truncated' ELSE 'whole' END AS state FROM s JOIN e USING (conv_id)"""
)
def byte_frames(t: Tables) -> DataFrame:
    """Frames in the bytes of a conversation, each with its length in its first byte; turns are the stream's packets."""
    packets = t("conversations").select("conv_id", "turn", F.encode("text", "UTF-8").alias("data"))
    found = frames(packets, ["conv_id"], "turn", "data", header=1, size=lambda head: number(head) % 32 + 2, heads=False)
    return found.select("conv_id", "record", "place", "size", "state")
