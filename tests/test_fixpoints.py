"""Ranks, self-sized records, trees, walks and nested counts against plain Python."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.fixpoints import crawl, self_sized, subtree_sums, variant_counts, walk
from tallyforge.operators.ranks import placed
from tallyforge.operators.records import dictionary
from tallyforge.session import Scratch


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_places(spark, keys):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 1, 1, 1, 1, 2, rnd.randint(3, 60)]), rnd.choice([None, *range(40)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int, i int").repartition(7)
    got = placed(df, ["v", "i"], "place", keys=keys).collect()
    groups = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        groups[r[0] if keys else 0].append(r)
    want = {r: n for own in groups.values() for n, r in enumerate(own, 1)}
    assert {(r.k, r.v, r.i): r.place for r in got} == want and len(got) == 3000


def test_places_of_odd_tables(spark):
    ties = spark.createDataFrame([(1, "x")] * 500 + [(None, "y")] * 3, "v int, s string")
    assert sorted(r.n for r in placed(ties, ["v"], "n").collect()) == list(range(1, 504))
    assert placed(ties.limit(0), ["v"], "n").count() == 0
    with pytest.raises(ValueError, match="already"):
        placed(ties, ["v"], "s")


def test_places_need_no_single_task(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).alias("k"))
    for keys in ((), ("k",)):
        plan = placed(df, ["id"], "n", keys=keys)
        sides = plan._jdf.queryExecution().optimizedPlan().toString()
        assert sides.count("Window") == 1 and "Window" not in sides.split("Join")[0]
        assert "Aggregate" in sides  # the window runs on a row a partition and group


def test_codes_beyond_two_bytes(spark):
    df = spark.range(70_000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"), (F.lit(70_000) - F.col("id")).alias("o"))
    assert {r.v: r.code for r in dictionary(df, "v", "o", capacity=None).where("code in (1, 66000, 70000)").collect()} == {"v69999": 1, "v4000": 66_000, "v0": 70_000}
    assert [r.code for r in dictionary(df, "v", capacity=None).where("v in ('v0', 'v99999', 'v1')").orderBy("v").collect()] == [1, 2]
    with pytest.raises(Exception, match="more than 65535 values"):
        dictionary(df, "v").collect()


def chain(rows):
    at, last, out = min(rows), max(rows), []
    while at <= last:
        n = rows.get(at)
        if not n or n < 1:
            return [*out, (at, n if n and n > 0 else None, len(out), "malformed")]
        out.append((at, n, len(out), "whole" if at + n - 1 <= last else "truncated"))
        at += n
    return out


def test_self_sized(spark):
    rnd = random.Random(2)
    seqs = {k: {p: rnd.choice([1, 2, 3, 7, 30]) for p in range(b, b + rnd.choice([1, 2, 50, 400]))} for k, b in ((k, rnd.choice([0, 1, 900])) for k in range(30))}
    seqs[30] = {p: 1 for p in range(3000)}
    seqs[31] = {0: 2, 1: None, 2: 3, 3: 1, 4: 1, 5: None, 6: 1}
    seqs[32] = {0: 2, 1: 0, 2: 0}
    seqs[33] = {0: None, 1: 1}
    seqs[34] = {5: 10**12}
    seqs[35] = {0: 4, 9: 1, 4: 5}
    rows = [(k, p, n, "x") for k, s in seqs.items() for p, n in s.items()] + [(None, 0, 1, "x"), (1, None, 1, "x")]
    found = self_sized(spark.createDataFrame(rows, "file int, line long, n long, record string").drop("record"), ["file"], "line", F.col("n"))
    got = collections.defaultdict(list)
    for r in found.orderBy("file", "record").collect():
        got[r.file].append((r.line, r.size, r.record, r.state))
    assert got == {k: chain(s) for k, s in seqs.items()}


def test_self_sized_of_odd_tables(spark):
    empty = spark.createDataFrame([], "file int, line long, n long")
    assert self_sized(empty, ["file"], "line", F.col("n")).count() == 0
    with pytest.raises(ValueError, match="more than once"):
        self_sized(spark.createDataFrame([(1, 0, 1), (1, 0, 2)], empty.schema), ["file"], "line", F.col("n"))


def test_subtree_sums(spark):
    rnd = random.Random(3)
    parent = {0: None} | {i: rnd.choice([None, i - 1, rnd.randrange(i), 0]) for i in range(1, 400)}
    parent |= {1000 + i: 999 + i if i else None for i in range(300)}  # a chain
    parent |= {2000: None} | {2001 + i: 2000 for i in range(2000)}  # a star
    value = {n: rnd.choice([None, rnd.randint(-5, 9)]) for n in parent}
    below, total, depth = collections.Counter(), collections.Counter(), {}
    for n in parent:
        at, steps = n, 0
        while at is not None:
            below[at] += 1
            total[at] += value[n] or 0
            at, steps = parent[at], steps + 1
        depth[n] = steps - 1
    rows = [(n, p, value[n], 1, "x") for n, p in parent.items()] + [(None, 3, 4, 1, "x"), (None, None, 4, 1, "x")]
    df = spark.createDataFrame(rows, "id int, up int, v int, below int, depth string")
    got = {r.id: (r.below, r.total, r.depth) for r in subtree_sums(df, "id", "up", {"total": F.col("v")}).collect()}
    assert got == {n: (below[n], total[n], depth[n]) for n in parent}


def test_trees_that_are_none(spark):
    def run(rows):
        return subtree_sums(spark.createDataFrame(rows, "id int, up int"), "id", "up", {}).count()

    assert run([]) == 0
    for rows, said in (([(1, 2), (2, 3), (3, 1), (4, None)], "cycle"), ([(1, 1)], "cycle"), ([(1, 7)], "no node 7"), ([(1, None), (1, None)], "more than once")):
        with pytest.raises(ValueError, match=said):
            run(rows)


def random_links(n=120, seed=4):
    rnd = random.Random(seed)
    names = [f"{rnd.choice(['a', 'b'])}/{i}{rnd.choice(['', '', '.lbl'])}" for i in range(n)]
    return names, [(rnd.choice(names), rnd.choice(names)) for _ in range(2 * n)] + [(names[0], names[0]), (names[0], None), (None, names[1])]


@pytest.mark.parametrize("steps", [0, 2, None])
def test_walk(spark, steps):
    names, links = random_links()
    table = spark.createDataFrame(links, "page string, to string")
    depth, newest, at = {names[0]: 0}, [names[0]], 0
    while newest and at != steps:
        at += 1
        newest = sorted({b for a, b in links if a in newest and b is not None and b.startswith("a") and b not in depth})
        depth |= dict.fromkeys(newest, at)
    start = spark.createDataFrame([(names[0],), (names[0],), (None,)], "page string")
    inside = F.col("page").startswith("a") | (F.col("page") == names[0])
    assert {r.page: r.depth for r in walk(table, start, steps=steps, within=inside).collect()} == depth


@pytest.mark.parametrize("most_pages, most_labels", [(1000, 1000), (25, 6), (1, 1), (0, 5)])
def test_crawl(spark, most_pages, most_labels):
    names, links = random_links(seed=8)
    label = lambda x: x.endswith(".lbl")
    seeds = [n for n in names if not label(n)][:2] + ["c/9"]
    inside = lambda x: x is not None and x.startswith(("a/", "b/"))
    pages, newest, depth = [], sorted({s for s in seeds if inside(s)}), 0
    while newest:
        pages += [(p, depth) for p in newest]
        newest = sorted({b for a, b in links if a in newest and inside(b) and not label(b)} - {p for p, _ in pages})
        depth += 1
    pages = pages[:most_pages]
    place = {p: n for n, (p, _) in enumerate(pages, 1)}
    first = {}
    for a, b in links:
        if a in place and inside(b) and label(b):
            first[b] = min(first.get(b, 10**9), place[a])
    labels = [b for _, b in sorted((n, b) for b, n in first.items())][:most_labels]
    table = spark.createDataFrame(links, "page string, to string")
    got = crawl(table, spark.createDataFrame([(s,) for s in seeds], "page string"), prefixes=["a/", "b/"], label=F.col("page").endswith(".lbl"), most_pages=most_pages, most_labels=most_labels)
    assert sorted((r.place, r.page, r.depth) for r in got[0].collect()) == [(place[p], p, d) for p, d in pages]
    assert [(r.place, r.label) for r in got[1].orderBy("place").collect()] == list(enumerate(labels, 1))


def test_plans_of_walks_stay_small(spark):
    links = spark.range(0, 600).select(F.col("id").cast("string").alias("page"), (F.col("id") + 30).cast("string").alias("to"))
    found = walk(links, spark.createDataFrame([("0",)], "page string"))
    assert found.count() == 21 and found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0


def test_variant_counts(spark):
    rnd = random.Random(6)

    def made(depth):
        if depth == 0 or rnd.random() < 0.2:
            return rnd.choice([1, "m", None, True, [], {}])
        if rnd.random() < 0.4:
            return [made(depth - 1) for _ in range(rnd.randint(0, 3))]
        return {k: made(depth - 1) for k in rnd.sample(["m", "n", "o"], rnd.randint(0, 3))}

    def count(v):
        if isinstance(v, dict):
            return sum((len(x) if k == "m" and isinstance(x, list) else 0) + count(x) for k, x in v.items())
        return sum(map(count, v)) if isinstance(v, list) else 0

    docs = [made(rnd.randint(0, 7)) for _ in range(60)]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(900, None)]
    df = spark.createDataFrame(rows, "id int, body string").select("id", F.parse_json("body").alias("body"), F.lit(1).alias("matches"))
    got = {r.id: r.matches for r in variant_counts(df, "id", "body", "m").collect()}
    assert got == {i: count(d) for i, d in enumerate(docs)} | {900: 0} and max(got.values()) > 3


@pytest.mark.parametrize("block", [1, 4, 64, 1 << 16])
def test_self_sized_in_blocks(spark, block):
    rnd = random.Random(block)
    seqs = {k: {p: rnd.choice([None, *[rnd.randint(1, m)] * 30]) for p in range(b, b + rnd.choice([1, 40, 500])) if p == b or rnd.random() < 0.98} for k, (b, m) in enumerate((b, m) for b in (0, -70, 900) for m in (1, 5, 90))}
    rows = [(f"k{k}", p, n) for k, s in seqs.items() for p, n in s.items()]
    found = self_sized(spark.createDataFrame(rows, "file string, line long, n long").repartition(5), ["file"], "line", F.col("n"), block=block)
    got = collections.defaultdict(list)
    for r in found.orderBy("file", "record").collect():
        got[r.file].append((r.line, r.size, r.record, r.state))
    assert got == {f"k{k}": chain(s) for k, s in seqs.items()}
    with pytest.raises(ValueError, match="more than once"):
        self_sized(spark.createDataFrame([("a", 1, 1), ("a", 1, 2)], "file string, line long, n long"), ["file"], "line", F.col("n"), block=block)


def test_self_sized_joins_no_places(spark, monkeypatch):
    kept, keep = {}, Scratch.keep

    def counted(self, df, name):
        out = keep(self, df, name)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "keep", counted)
    rows = spark.range(300_000).select(F.lit("a").alias("file"), F.col("id").alias("line"), (F.col("id") % 7 + 1).alias("n"))
    found = self_sized(rows, ["file"], "line", F.col("n"))
    assert found.agg(F.sum("size")).first()[0] >= 300_000
    assert max(kept.values()) < 100, "rounds run on entries of blocks, not on places"
