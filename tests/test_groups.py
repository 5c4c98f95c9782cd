"""Quantiles, bounded distinct values, rules, hash trees and spread tiles against plain Python."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.functions.parsing import spread_tiles
from tallyforge.operators.fixpoints import merkle_roots
from tallyforge.operators.quantiles import bounded_distinct, quantiles
from tallyforge.operators.records import eligibility
from tallyforge.operators.rules import rules_met
from tallyforge.operators.wordpieces import word_codes


@pytest.mark.parametrize("gather", [20, 4096])
def test_quantiles(spark, gather):
    rng = np.random.default_rng(5)
    kinds = {
        "normal": rng.normal(size=3000),
        "heavy": np.exp(rng.normal(0, 60, 3000)),
        "equal": np.full(500, 7.0),
        "two": rng.choice([1.0, 1e300], 900),
        "wide": np.r_[-1.7e308, 1.7e308, rng.normal(size=300)],
        "tiny": np.r_[np.zeros(40), np.full(40, 5e-324)],
        "one": np.array([3.5]),
        None: np.arange(2000) % 17,
    }
    rows = [(k, float(v), float(v) * 2 if abs(v) < 1e300 else None, "x") for k, own in kinds.items() for v in own]
    rows += [("one", None, None, "x"), ("one", math.nan, 1.0, "x"), ("none", None, None, "x")]
    shares = [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]
    found = {r.k: r for r in quantiles(spark.createDataFrame(rows, "k string, v double, w double, _n string").drop("_n"), ["k"], ["v", "w"], shares, gather=gather).collect()}
    assert set(found) == set(kinds)
    for k, own in kinds.items():
        s = np.sort(own)
        for share, got in zip(shares, found[k].v, strict=True):
            h = (len(s) - 1) * share
            low, high = s[math.floor(h)], s[math.ceil(h)]
            assert got == (low if low == high else (math.ceil(h) - h) * low + (h - math.floor(h)) * high)
    assert found["one"].w == pytest.approx([1.0 + 6 * s for s in shares])


def test_quantiles_are_those_of_percentile(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), F.sqrt((F.col("id") * 7919) % 10007).alias("v"))
    shares = [0.1, 0.5, 0.75]
    want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("p")).collect()}
    assert {r.k: r.v for r in quantiles(df, ["k"], ["v"], shares, gather=100).collect()} == want
    whole = quantiles(df, [], ["v"], [0.5], gather=50).first().v
    assert whole == [df.agg(F.median("v")).first()[0]]
    assert quantiles(df.limit(0), ["k"], ["v"], shares).count() == 0


@pytest.mark.parametrize("at_once", [3, 4096])
def test_bounded_distinct(spark, monkeypatch, at_once):
    monkeypatch.setattr("tallyforge.operators.quantiles.GATHER", at_once)
    rnd = random.Random(9)
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, *range(rnd.choice([3, 12, 60]))]), "x") for _ in range(4000)] + [(99, None, "x"), (98, 1, "x")]
    kinds = collections.defaultdict(set)
    for k, v, _ in rows:
        kinds[k] |= {v} - {None}
    df = spark.createDataFrame(rows, "k int, v int, _s string").repartition(6)
    for most in (10, 11, 100):
        got = {r.k: (r.kinds, r.overflow, r["values"]) for r in bounded_distinct(df, ["k"], "v", capacity=most).collect()}
        assert got == {k: (min(len(s), most + 1), len(s) > most, sorted(s) if len(s) <= most else None) for k, s in kinds.items()}
    assert [tuple(r) for r in bounded_distinct(df, [], "v", capacity=9).collect()] == [(10, True, None)]
    assert bounded_distinct(df.limit(0), ["k"], "v").count() == 0


@pytest.mark.parametrize("chars", [40, 1 << 22])
def test_rules(spark, monkeypatch, chars):
    monkeypatch.setattr("tallyforge.operators.rules.NEEDLE_CHARS", chars)
    rnd = random.Random(10)
    letters = lambda n: "".join(rnd.choices("abC ", k=n))
    docs = [(i, letters(rnd.randint(0, 60)), "x") for i in range(80)] + [(7, None, "x"), (None, "ab ba", "x"), (None, "ab ba", "x")]
    rules = [(f"r{i}", [letters(rnd.randint(1, 4)) for _ in range(rnd.randint(1, 4))]) for i in range(150)] + [("all", []), ("all2", [""]), ("never", ["a", None]), ("r1", ["b"]), ("twice", ["AB", "ab"]), (None, ["a"]), ("gone", None)]

    def holds(t):
        met = {r for r, needles in rules if r is not None and needles is not None and None not in needles and all(n.lower() in (t or "").lower() for n in needles)}
        return tuple(sorted(met))

    df = spark.createDataFrame(docs, "doc_id int, text string, rules string")
    table = spark.createDataFrame(rules, "rule_id string, needles array<string>")
    got = rules_met(df, table)
    assert collections.Counter((r.doc_id, tuple(r.rules)) for r in got.collect()) == collections.Counter((i, holds(t)) for i, t, _ in docs)
    assert all(r.rules == [] for r in rules_met(df, table.limit(0)).collect())
    assert rules_met(df.limit(0), table).count() == 0


def test_merkle_roots(spark):
    def twice(b):
        return hashlib.sha256(hashlib.sha256(b).digest()).digest()

    def root(level):
        while len(level) > 1:
            level = level + level[-1:] if len(level) % 2 else level
            level = [twice(a + b) for a, b in zip(level[::2], level[1::2], strict=True)]
        return level[0].hex()

    sizes = [*range(1, 40), 255, 256, 257, 5000]
    rows = [(n, i, twice(f"{n}/{i}".encode()).hex(), "x") for n in sizes for i in range(n)]
    df = spark.createDataFrame(rows, "block int, place int, h string, root string").drop("root").repartition(5)
    join = lambda a, b: F.sha2(F.unhex(F.sha2(F.concat(F.unhex(a), F.unhex(b)), 256)), 256)
    got = {r.block: r.root for r in merkle_roots(df, ["block"], "place", "h", join).collect()}
    assert got == {n: root([twice(f"{n}/{i}".encode()) for i in range(n)]) for n in sizes}
    assert merkle_roots(df.limit(0), ["block"], "place", "h", join).count() == 0
    with pytest.raises(Exception, match="without gaps"):
        merkle_roots(df.where("not (block = 5 and place = 2)"), ["block"], "place", "h", join).collect()


def test_spread_tiles(spark):
    def plain(across, down, most):
        seen = {}
        for q in (1, 2, 3):
            for p in (1, 2, 3):
                x, y = (min(max(int(n > 2), round(f * n / 4)), n - 1 - int(n > 2)) for f, n in ((p, across), (q, down)))
                seen.setdefault(y * across + x, (y * across + x, x, y))
        return list(seen.values())[:most] if across > 0 and down > 0 else []

    rows = [(a, d, m) for a in range(0, 51) for d in (0, 1, 2, 3, 5, 6, 10, 50) for m in (0, 1, 4, 9, 20)]
    found = spark.createDataFrame(rows, "a int, d int, m int").select("a", "d", "m", spread_tiles(F.col("a"), F.col("d"), F.col("m")).alias("t")).collect()
    assert all([tuple(e) for e in r.t] == plain(r.a, r.d, r.m) for r in found)


def test_word_codes(spark):
    rnd = random.Random(12)
    pieces = {}
    for _ in range(40):
        pieces.setdefault(("".join(rnd.choices("abc", k=rnd.randint(1, 4))), rnd.random() < 0.6), len(pieces) + 1)
    words = {"".join(rnd.choices("abcd" if rnd.random() < 0.1 else "abc", k=rnd.randint(0, 9))) for _ in range(200)} | {"abc" * 40}

    def code(w):
        if len(w) > 100:
            return [0]
        out, at = [], 0
        while at < len(w):
            n = next((n for n in range(len(w) - at, 0, -1) if (w[at : at + n], at > 0) in pieces), None)
            if n is None:
                return [0]
            out.append(pieces[w[at : at + n], at > 0])
            at += n
        return out

    table = spark.createDataFrame([*((p, i, n, "x") for (p, i), n in pieces.items()), (*next(iter(pieces)), 999, "x"), ("", False, 5, "x")], "piece string, inside boolean, id int, word string")
    df = spark.createDataFrame([(w, 1) for w in [*words, *words]] + [(None, 1)], "word string, at int")
    got = word_codes(df, table).collect()
    assert {r.word: r.ids for r in got} == {w: code(w) for w in words} and len(got) == len(words)
    assert len({tuple(code(w)) for w in words}) > 60
    assert word_codes(df.limit(0), table).count() == 0
    assert {tuple(r.ids) for r in word_codes(df, table.limit(0)).where("word <> ''").collect()} == {(0,)}


@pytest.mark.parametrize("block", [1 << 22, 40, 12])
def test_word_codes_in_blocks_and_without_a_bound(spark, monkeypatch, block):
    from tallyforge.operators import wordpieces

    monkeypatch.setattr(wordpieces, "BLOCK", block)
    rnd = random.Random(3)
    pieces = {(p, i): n for n, (p, i) in enumerate([("a", False), ("ab", False), ("abca", False), ("b", True), ("ca", True), ("é𝄞", True), ("bcab", True)], -2)}
    words = {"".join(rnd.choices(["a", "b", "ca", "é𝄞", "bc"], k=rnd.randint(0, 8))) for _ in range(150)} | {"ab" + "ca" * 60, "abc" * 50}

    def spelled(w):
        out, at = [], 0
        while at < len(w):
            n = next((n for n in range(len(w) - at, 0, -1) if (w[at : at + n], at > 0) in pieces), None)
            if n is None:
                return [7], None
            out.append(w[at : at + n])
            at += n
        return [pieces[p, k > 0] for k, p in enumerate(out)], out

    table = spark.createDataFrame([*((p, i, n) for (p, i), n in pieces.items()), ("a", None, -9), (None, True, -9)], "piece string, inside boolean, id int")
    df = spark.createDataFrame([(w,) for w in [*words, *words, None]], "w string")
    got = word_codes(df, table, word="w", unknown=7, longest=None).collect()
    assert {r.word: (r.ids, r.pieces) for r in got} == {w: spelled(w) for w in words} and len(got) == len(words)
    assert len(spelled("ab" + "ca" * 60)[1]) == 60 and sum(spelled(w)[1] is None for w in words) > 20


def test_word_codes_take_no_job_a_piece(spark):
    table = spark.createDataFrame([("a", False, 1), ("b", True, 2)], "piece string, inside boolean, id int")
    spark.sparkContext.setJobGroup("pieces", "pieces of a long word")
    try:
        assert [len(r.ids) for r in word_codes(spark.createDataFrame([("a" + "b" * 39,)], "word string"), table).collect()] == [40]
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("pieces")) < 12
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("many", [False, True])
def test_words_in_pieces_of_any_length_and_number(spark, tmp_path, many):
    import duckdb

    from tallyforge.queries import ORACLES, QUERIES

    letters = "abcdefghijklmnopqrstuvwxyz"
    known = [a + b + c + d for a in letters for b in letters for c in letters for d in "abcd"] if many else ["abcc", "accc", "ab"]
    assert len({p for w in known for p in (w[:1], w[:2], w[:3], w)}) > (65_535 if many else 3)
    documents = [("ab" + "c" * 148 + " ABC, abz " + "ab" + "c" * 148 + "z",), (None,), ("",)]
    for name, rows in {"documents": documents, "benchmark": [(" ".join(known),)]}.items():
        spark.createDataFrame(rows, "text string").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    found = sorted((r.word, r.pieces) for r in QUERIES["words_in_pieces"](spark, str(tmp_path)).collect())
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert found == sorted(db.execute(ORACLES["words_in_pieces"]).fetchall())
    assert len(found) == 4 and max(len(p.split()) for _, p in found) > 45


def test_eligibility(spark):
    rows = [("ok", i, i, i % 3) for i in range(9)] + [("few", 1, 1, 1), ("few", 2, 2, 2)] + [("flat", i, i, 4) for i in range(9)] + [("big", i, i, 250 + i) for i in range(9)]
    rows += [("part", i, i, i + 0.5 if i == 5 else i) for i in range(9)] + [("gap", i, i, None if i == 5 else i) for i in range(9)] + [("back", i, 0 if i == 5 else i, i) for i in range(9)] + [("nulls", i, None if i == 5 else i, i) for i in range(9)]
    df = spark.createDataFrame([(k, i, t, None if v is None else float(v)) for k, i, t, v in rows], "k string, i int, t int, v double")
    found = {r.k: r for r in eligibility(df, ["k"], "i", "t", "v", least=9).collect()}
    assert {k for k, r in found.items() if r.selected} == {"ok", "nulls"}
    assert [found[k].complete for k in ("big", "part", "gap")] == [False] * 3 and not found["back"].monotonic
    assert (found["gap"].observations, found["gap"].numeric_values, found["big"].distinct_bytes) == (9, 8, 6)


def test_conflicts_by_one_grouping(spark):
    from tallyforge.plans.cleaning import dedupe_conflict

    rows = [(1, 1, 5.0), (1, 1, 5.0), (1, 2, 5.0), (1, 2, 6.0), (1, 3, None), (1, 4, None), (1, 4, 7.0), (None, 1, 0.0), (None, 1, -0.0), (2, 1, float("nan")), (2, 1, float("nan")), (2, 2, float("nan")), (2, 2, 1.0)]
    found = dedupe_conflict(lambda name: spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_extendedprice double"))
    assert {(r[0], r[1]): (r[2], r[3]) for r in found.collect()} == {(1, 1): (2, False), (1, 2): (2, True), (1, 3): (1, False), (1, 4): (2, False), (None, 1): (2, False), (2, 1): (2, False), (2, 2): (2, True)}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2, "rows are grouped by the keys alone"
