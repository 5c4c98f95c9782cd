"""Fingerprints, the filter audit and vector codes against brute force, with odd rows throughout."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm.filter_audit import audit_filters
from tallyforge.llm.fingerprints import SAMPLES, Sampler, fingerprint_edits, fingerprint_texts, likeness
from tallyforge.llm.vector_codes import Tree, code_vectors, compress
from tests.llm.test_operators import ROWS, SCHEMA, TEXTS, same


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None if i is None else f"s{i % 3}" if i % 7 else "", None, "r", None, "w", None) for i, t in ROWS], SCHEMA).repartition(3)


def bag(text):
    w = text.encode().split()
    return collections.Counter(tuple(w[max(0, i - 4) : i + 1]) for i in range(len(w))) or collections.Counter({(): 1})


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def test_samples_collide_at_the_generalised_jaccard_rate():
    rnd = np.random.default_rng(3)
    sampler = Sampler(4096)
    for spread in (0.0, 1.0, 3.0):
        terms = rnd.integers(0, 1 << 63, 60).astype(np.uint64)
        a, b = (np.exp(rnd.normal(0, spread, 60)) for _ in range(2))
        a[:10], b[10:20] = a[:10] * 7, b[10:20] * 0.2
        one, two = sampler.sign([(terms[:50], a[:50]), (terms[5:], b[5:])])
        both = [np.r_[a[:50], np.zeros(10)], np.r_[np.zeros(5), b[5:]]]
        truth = np.minimum(*both).sum() / np.maximum(*both).sum()
        assert abs((one == two).mean() - truth) < 4 * math.sqrt(truth * (1 - truth) / 4096) + 0.003


def test_samples_do_not_hang_on_how_terms_are_dealt(monkeypatch):
    sampler = Sampler(16)
    sets = [(np.arange(1, n + 1).astype(np.uint64), np.ones(n)) for n in (1, 5, 5000, 7)]
    whole = sampler.sign(sets)
    monkeypatch.setattr("tallyforge.llm.fingerprints.TERMS_AT_ONCE", 3)
    assert (sampler.sign(sets) == whole).all()


@pytest.mark.parametrize("parts", ["1", "4", "40"])
def test_fingerprints_of_edits(spark, docs, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = fingerprint_edits(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert collections.Counter((r.doc_id, r.n_chars) for r in found) == collections.Counter((i, len(t)) for (i, _), t in zip(ROWS, TEXTS, strict=True))
    unique = [r for r in ROWS if r[0] not in (None, 61)]
    by_id = {r.doc_id: r for r in found if r.doc_id not in (None, 61)}
    texts = {i: t or "" for i, t in unique}
    order = sorted(texts, reverse=True)
    follows = {i: texts[j] for i, j in zip(order, order[1:], strict=False)} | {62: TEXTS[61], 61: texts[60]}
    seen = 0
    for i, follower in follows.items():
        if i not in texts:
            continue
        t, r = texts[i], by_id[i]
        new = t[: len(t) - len(t) // 3] + follower[: len(t) // 3]
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        for near, other in ((r.near_edited, new), (r.near_next, follower)):
            truth = jaccard(bag(t), bag(other))
            assert abs(near - truth) <= 5 * math.sqrt(truth * (1 - truth) / SAMPLES) + 0.01
        seen += 1
    assert seen > 80
    prints = collections.defaultdict(set)
    for (i, t), text in zip(ROWS, TEXTS, strict=True):
        if i in by_id:
            prints[text].add(by_id[i].fingerprint)
    assert all(len(x) == 1 for x in prints.values()) and len({next(iter(x)) for x in prints.values()}) > 70


def test_the_last_document_meets_the_first(spark):
    few = spark.createDataFrame([(5, "a b c d e f"), (9, "u v w x y z")], "doc_id long, text string")
    found = {r.doc_id: r.edited_sha256 for r in fingerprint_edits(few).collect()}
    assert found == {9: hashlib.sha256(b"u v w x a b").hexdigest(), 5: hashlib.sha256(b"a b c d u v").hexdigest()}
    alone = fingerprint_edits(few.where("doc_id = 5")).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"a b c d " + b"a b").hexdigest()
    nameless = fingerprint_edits(few.selectExpr("cast(null as long) doc_id", "text")).collect()
    assert sorted(r.n_chars for r in nameless) == [11, 11]
    assert fingerprint_edits(few.limit(0)).count() == 0


def test_fingerprints_without_a_shuffle(docs):
    found = fingerprint_texts(docs)
    assert "Exchange" not in found._jdf.queryExecution().optimizedPlan().toString()
    edits = {(r.doc_id, r.fingerprint) for r in fingerprint_edits(docs).collect()}
    assert {(r.doc_id, r.fingerprint) for r in found.collect()} == edits
    far = fingerprint_edits(docs).select("near_edited", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("x")).collect()
    assert all(r.x == r.near_edited for r in far)


def audited(rows, labels):
    """Every order applied to every row."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    parts = collections.defaultdict(list)
    for i, t, s in rows:
        w = [x for x in re.split("[ \t-\r]+", t) if x]
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > least[t]}
        parts[s].append((fails, any(q == 1 for j, q, _ in labels if j == i and i is not None), any(x == 1 for j, _, x in labels if j == i and i is not None)))
    out, shapley = {}, collections.Counter()
    for part, own in parts.items():
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                kept, gone = [x for x in left if not x[0][f]], [x for x in left if x[0][f]]
                redundant = sum(x[0][f] for x in own) - len(gone)
                alone = sum(x[0][f] and sum(x[0].values()) == 1 for x in own)
                out[part, "".join(order), step] = (len(kept), len(gone), redundant, alone, sum(x[1] for x in gone), sum(x[2] for x in gone))
                shapley[part, f] += len(gone)
                left = kept
    return [(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()]


def test_filter_audit(spark, docs):
    labels = [(i, int(i % 2), int(i % 5 == 0)) for i in range(0, 96, 3)] + [(3, None, None), (3, 1, 1), (None, 1, 1), (61, 1, 0), (61, 0, 1), (1000, 1, 1)]
    rnd = random.Random(5)
    more = [(200 + k, " ".join(rnd.choices(["Ab", "CD", "e#", "f", "g"], k=rnd.choice([3, 60]))), "s1") for k in range(30)]
    rows = [(i, t or "", "" if i is None or i % 7 == 0 else f"s{i % 3}") for i, t in ROWS] + more
    table = docs.select("doc_id", "text", "source").unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit_filters(table, marks)
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    same(found, columns, audited(rows, labels))
    assert audit_filters(docs.limit(0), marks).count() == 0
    assert audit_filters(table, marks.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


def test_filter_audit_stays_in_the_jvm(docs, spark):
    plan = audit_filters(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def quantised(rows, entries=256, rounds=4, parts=4):
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0] or 0, [math.floor(1024 * x) for x in r[1]]))
    v = np.array([[math.floor(1024 * x) for x in r[1]] for r in kept], np.int64)
    width = v.shape[1] // parts
    code, error, books = [], 0, []
    for k in range(parts):
        p = v[:, k * width : (k + 1) * width]
        book = p[:entries].copy()
        for turn in range(rounds + 1):
            away = ((p[:, None] - book[None]) ** 2).sum(axis=2)
            at = away.argmin(axis=1)
            if turn < rounds:
                for e in set(at.tolist()):
                    book[e] = p[at == e].sum(axis=0) // (at == e).sum()
        code.append(at)
        error = error + away.min(axis=1)
        books.append(book)
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()
    by_label = collections.Counter()
    for r, e in zip(kept, error.tolist(), strict=True):
        by_label[r[2]] += e
    return [(r[0], "".join(f"{c[j]:02x}" for c in code), int(error[j]), by_label[r[2]], digest) for j, r in enumerate(kept)]


def vectors(n, seed=4, width=16):
    rnd = random.Random(seed)
    hot = [rnd.uniform(-1, 1) for _ in range(width)]
    rows = [(i, hot if i % 3 == 0 else [round(rnd.gauss(i % 4, 0.3), 2) for _ in range(width)], rnd.choice([None, 1, 2])) for i in range(n)]
    odd = [(n, None, 1), (n + 1, [None] * width, 1), (n + 2, [float("nan")] * width, None), (n + 3, [float("inf")] + [0.0] * (width - 1), 2), (7, [0.5] * width, 1), (7, [0.25] * width, None), (None, [0.1] * width, 1), (n + 4, [-0.0005] * width, 2)]
    return rows + odd


SHAPE = "vec_id long, embedding array<float>, label int, code string, v string"


@pytest.mark.parametrize("n, entries", [(700, 256), (90, 256), (400, 16)])
def test_vector_codes(spark, n, entries):
    rows = vectors(n)
    table = spark.createDataFrame([(*r, "c", "v") for r in rows], SHAPE).repartition(5)
    singles = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]
    same(code_vectors(spark, table, entries=entries), ["vec_id", "code", "error", "label_error", "codebooks_sha256"], quantised(singles, entries))


def test_vector_codes_of_odd_tables(spark):
    def table(rows):
        return spark.createDataFrame([(*r, 1, "c", "v") for r in rows], SHAPE)

    assert code_vectors(spark, table([])).count() == 0
    assert code_vectors(spark, table([(1, None), (2, [None, 1.0])])).count() == 0
    assert [tuple(r)[:4] for r in code_vectors(spark, table([(1, []), (2, [])])).collect()] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]
    for bad in ([(1, [1.0, 2.0])], [(1, [1.0] * 4), (2, [1.0] * 8)], [(1, [1e30] * 4)]):
        with pytest.raises(Exception, match="equal parts|different lengths|too large"):
            code_vectors(spark, table(bad)).collect()


def test_whole_subtrees_are_assigned():
    rnd = np.random.default_rng(2)
    points = rnd.integers(-5, 5, (4000, 2)) + 1000 * rnd.integers(0, 4, (4000, 1))
    points = np.r_[points, np.repeat([[7, 7]], 3000, axis=0)]
    tree = Tree.unpack(Tree.build(points).pack(), 2)
    book = points[:40]
    whole = sum(int((tree.spans[x, 1] - tree.spans[x, 0]).sum()) for x, _, w in tree.settled(book) if w)
    assert whole > 3000
    away = ((points[:, None] - book[None]) ** 2).sum(axis=2)
    codes, error = tree.nearest(book)
    assert (codes == away.argmin(axis=1)).all() and (error == away.min(axis=1)).all()
    sums, counts = tree.totals(book)
    assert (counts == np.bincount(codes, minlength=40)).all() and (sums[codes[0]] == points[codes == codes[0]].sum(axis=0)).all()


def test_compress_returns_the_codebooks(spark):
    table = spark.createDataFrame([(*r, "c", "v") for r in vectors(60)], SHAPE)
    found, books = compress(table, entries=8)
    assert books.shape == (4, 8, 4) and found.columns == ["vec_id", "label", "code", "error"]
