"""Filter interaction audit from a histogram of failure masks, in native DataFrame functions throughout.

One pass over the texts gives each row the bits of the four filters that see its text alone, and a
digest of the text. Grouping by that digest names the smallest id of each text (partial sums first,
so a text that a third of all rows hold costs one row a task), and a row that has a smaller one
fails filter E. Rows then add up to at most 32 cells a part. Whatever order filters are applied in,
a row's fate depends on its mask alone, so all orders are enumerated from the cells, never from rows.

Defined results: a null text is an empty one, a null source the part ``''``; a row without an id has
no smaller id before it and never fails E, and no row fails E because of it; repeated rows count
each, those with their text's smallest id all pass E; labels of an id stated more than once count as
1 where one of them is 1, labels without an id belong to no row; an empty table has no parts;
columns not named are not read.
"""

from __future__ import annotations

import json
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, let, tune

#: Each filter's bit is its place here.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5


def text_mask(text: Column) -> Column:
    """The bits of filters A to D, each text split once."""
    words = F.filter(F.split(text, "[ \\x09-\\x0D]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))

    def bits(w: Column) -> Column:
        n = F.size(w)
        tests = (n < LEAST_WORDS, 100 * F.size(F.array_distinct(w)) < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * F.length(text), text.rlike("[#$%&*|]"))
        return sum((F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)), F.lit(0))

    return let(words, bits)


def masked(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """doc_id, part, mask (five bits), good, toxic of every row."""
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), text_mask(F.col("text")).alias("mask"))
    rows = Scratch(docs.sparkSession, "filter-audit").keep(rows, "masks")
    # few rows share a digest and an id, so joins by both are even however often a text or a source comes again
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("least", F.lit(True))
    marks = labels.groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    named = rows.where("doc_id is not null").join(least, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    later = F.when(F.col("least").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    named = named.select("doc_id", "part", F.col("mask").bitwiseOR(later).alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    nameless = rows.where("doc_id is null").select("doc_id", "part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return named.unionByName(nameless)


def cells(rows: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: at most 32 rows a part."""
    return rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def orders() -> list[dict]:
    """Every step of every order: its filter's bit and the bits of the filters before it."""
    steps = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            steps.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return steps


def interactions(histogram: DataFrame) -> DataFrame:
    """One row a part, order and step from the cells alone; ``shapley`` sums a filter's removals over all orders.

    Of the 120 orders, a row that fails k filters is removed by each of these in 120 / k.
    """
    steps = F.from_json(F.lit(json.dumps(orders())), "array<struct<filter_order:string, step:int, bit:int, before:int>>")
    each = histogram.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")).select("part", "cells", F.inline(steps))
    mask, bit, before, zero = (lambda c: c["mask"]), F.col("bit"), F.col("before"), F.lit(0).cast("long")

    def total(test, value=lambda c: c["n"]) -> Column:
        return F.aggregate(F.filter("cells", test), zero, lambda a, c: a + value(c))

    def fails(c: Column) -> Column:
        return mask(c).bitwiseAND(bit) != 0

    def here(c: Column) -> Column:
        return fails(c) & (mask(c).bitwiseAND(before) == 0)

    share = F.lit(factorial(len(FILTERS)))
    return each.select(
        "part",
        "filter_order",
        "step",
        total(lambda c: mask(c).bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total(here).alias("removed"),
        total(lambda c: fails(c) & (mask(c).bitwiseAND(before) != 0)).alias("redundant"),
        total(lambda c: mask(c) == bit).alias("unique_fails"),
        total(here, lambda c: c["good"]).alias("good_lost"),
        total(here, lambda c: c["toxic"]).alias("toxic_lost"),
        total(fails, lambda c: c["n"] * (share / F.bit_count(mask(c))).cast("long")).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """The interactions of the five filters within each part of the documents."""
    tune(docs.sparkSession)
    return interactions(cells(masked(docs, labels, **columns)))


#: The same by rows instead of cells: every order is applied to the rows' own flags.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
f AS (SELECT doc_id, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
        100 * (length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g'))) > 5 * length(t), regexp_matches(t, '[#$%&*|]'),
        coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM w),
m AS (SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good = 1) AS good, count(*) FILTER (WHERE bad = 1) AS bad
      FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT part, filter_order, step, ascii(filter_order[step]) - 64 AS k, fails, n, good, bad,
        len(list_filter(range(1, step), lambda i: fails[ascii(filter_order[i]) - 64])) > 0 AS gone,
        len(list_filter(fails, lambda v: v)) AS many FROM m, o, range(1, 6) AS r(step)),
g AS (SELECT part, filter_order, step, any_value(k) AS k,
        sum(n) FILTER (WHERE NOT gone AND NOT fails[k]) AS kept, sum(n) FILTER (WHERE NOT gone AND fails[k]) AS removed,
        sum(n) FILTER (WHERE gone AND fails[k]) AS redundant, sum(n) FILTER (WHERE fails[k] AND many = 1) AS unique_fails,
        sum(good) FILTER (WHERE NOT gone AND fails[k]) AS good_lost, sum(bad) FILTER (WHERE NOT gone AND fails[k]) AS toxic_lost
      FROM s GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
       coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, sum(coalesce(removed, 0)) OVER (PARTITION BY part, k)::BIGINT AS shapley
FROM g
"""
