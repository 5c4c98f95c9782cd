"""The ten operators against brute force, libraries and planted cases on small tables.

The fixture has nulls in every column, empty and very long texts, ties, repeated rows and extra
columns whose names clash with working columns.
"""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, meet
from tallyforge.llm.components import connected
from tallyforge.llm.decontamination import find_leaks
from tallyforge.llm.near_duplicates import forest, measured_recall, meeting, near_duplicates
from tallyforge.llm.quality import POLICIES, SYMBOLS, ablation, judge, ledger
from tallyforge.llm.queries import tokenizer_file
from tallyforge.llm.sentencepiece_codec import Codec, Pieces, code_texts, decode_ids, encode_texts
from tallyforge.llm.sharding import assign_shards, shard_rows, write_shards
from tallyforge.llm.substring_dedup import drop_repeats
from tallyforge.llm.suffix_dedup import mark_repeats
from tallyforge.llm.token_counts import count_tokens
from tallyforge.llm.toxicity import cross_validated, score_texts, toxicity, train
from tallyforge.llm.warc_revisits import canonical, resolve_revisits

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, gram int, n_words string, count string"


def make_rows():
    rnd = random.Random(11)
    words = [a + b for a in ("ba", "do", "ki", "lu", "É", "ñu") for b in ("r", "s", "t", "na", "Σ")]
    passage = " ".join(rnd.choices(words, k=60))
    rows = []
    for i in range(60):
        text = " ".join(rnd.choices(words, k=rnd.randint(0, 140)))
        if i % 6 == 0:
            text += "\n" + passage + "\t" + " ".join(rnd.choices(words, k=20))
        if i % 9 == 0:
            text = text.replace(" ", "  ") + " <|endoftext|> ## 's x\x1cy"
        rows.append((i, text))
    rows += [(60, rows[5][1]), (61, rows[5][1]), (61, rows[5][1]), (62, None), (63, ""), (64, " \n\t "), (None, rows[7][1]), (None, None)]
    base = rows[12][1].split()
    for i in range(70, 90):
        near = list(base)
        for at in rnd.sample(range(len(near)), 2):
            near[at] = rnd.choice(words)
        rows.append((i, " ".join(near)))
    rows += [(90, "one"), (91, "one"), (92, "ab " * 9000), (93, "z" * 30000), (94, passage), (95, "İSTANBUL ﬁ 漢字 🙂▁x")]
    return rows


ROWS = make_rows()
#: What a row is known by in expectations: ids repeat, so results are compared as multisets.
TEXTS = [t or "" for _, t in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None, None, None, "r", None, "w", None) for i, t in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, columns, expected):
    assert collections.Counter(tuple(r) for r in df.select(*columns).collect()) == collections.Counter(expected)


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    expected = [(i, len(t.encode()), n := len(library.encode(t, add_special_tokens=False).ids), n > 2048) for (i, _), t in zip(ROWS, TEXTS, strict=True)]
    same(count_tokens(docs, path), ["doc_id", "n_bytes", "n_tokens", "over_limit"], expected)
    assert count_tokens(empty, path).count() == 0


def leaks(rows, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    owners = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if w else 0):
            owners[tuple(w[a : a + n])].add(i)
    sizes = {len(k) for k in owners}
    for i, t in rows:
        w, hit, met = split(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if (k := tuple(w[a : a + n])) in owners:
                    hit |= set(range(a, a + n))
                    met |= owners[k] - {None}
        yield i, len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(map(str, met))).encode()).hexdigest(), bool(hit)


def test_decontamination(spark, docs, empty):
    items = [(1, " ".join(ROWS[6][1].split()[3:30])), (2, "Bar! dos"), (2, None), (None, "kir kis"), (10, "bar dos"), (3, ""), (4, "not there at all")]
    table = spark.createDataFrame(items, "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    found = find_leaks(docs, table, also=("lang",), text_out=True)
    same(found, columns, list(leaks(ROWS, items)))
    assert not find_leaks(found.where("doc_id < 60").select("doc_id", "text"), table.where("item_id = 1")).where("contaminated").count()
    blocks = find_leaks(docs, table, also=("lang",), text_out=True, block_bytes=40)
    same(blocks, [*columns, "text"], found.select(*columns, "text").collect())
    assert find_leaks(empty, table).count() == 0
    assert find_leaks(docs, table.limit(0)).where("contaminated").count() == 0


def test_sharding(docs, empty):
    for limit in (1 << 20, 4000):
        found = assign_shards(docs, limit=limit)
        same(found, ["doc_id", "n_bytes"], [(i, len(t.encode())) for (i, _), t in zip(ROWS, TEXTS, strict=True)])
        shards = found.groupBy("shard").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"), F.min("fits").alias("fits")).collect()
        assert all(r.b <= limit or (r.n == 1 and not r.fits) for r in shards)
        names = sorted(r.shard for r in shards)
        assert not any(b.startswith(a) for a, b in zip(names[:-1], names[1:], strict=True))
    assert assign_shards(empty).count() == 0


def test_shards_are_written_whole(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 50)) for i in range(400)] + [(400, None)], "doc_id long, text string")
    shards = assign_shards(docs, limit=3000)
    assert shards.select("depth").distinct().count() > 1
    write_shards(docs, shards, f"file://{tmp_path}/out")
    back = spark.read.schema("doc_id long, text string, shard string").parquet(f"file://{tmp_path}/out")
    same(back, ["doc_id", "text"], docs.collect())
    assert back.groupBy("shard").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).where("b > 3000").count() == 0


def test_rows_of_any_ids_are_sharded_whole(spark, tmp_path):
    odd = [(1, "a " * 300, "x"), (1, "b " * 300, "y"), (None, "c " * 300, "z"), (None, None, None), (2, "d", "w"), (2, "d", "w")]
    docs = spark.createDataFrame(odd, "doc_id long, text string, depth string")
    shard_rows(docs, f"file://{tmp_path}/out", limit=700)
    back = spark.read.schema("doc_id long, text string, depth string, shard string").parquet(f"file://{tmp_path}/out")
    same(back, ["doc_id", "text", "depth"], odd)
    assert back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("b")).where("b > 700").count() == 0
    with pytest.raises(ValueError, match="different ids"):
        write_shards(docs, assign_shards(docs), f"file://{tmp_path}/other")
    with pytest.raises(ValueError, match="a byte"):
        assign_shards(docs, limit=0)
    shard_rows(docs.limit(0), f"file://{tmp_path}/none")


def test_near_duplicates(docs, empty):
    sets = []
    for t in TEXTS:
        w = t.encode().split()
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[a : a + k]) for a in range(len(w) - k + 1)) if w else frozenset())
    root, links = list(range(len(sets))), [0] * len(sets)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for x in range(len(sets)):
        groups[find(x)].append(ROWS[x][0])
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    expected = [(ROWS[x][0], least[find(x)], links[x], len(groups[find(x)])) for x in range(len(sets))]
    found = near_duplicates(docs, also=("lang",))
    same(found, ["doc_id", "group_id", "n_links", "group_size"], expected)
    assert found.where("first").count() == len(groups)
    assert near_duplicates(empty).count() == 0


def test_measured_recall():
    assert measured_recall({}, 0.8, 6, 24) == pytest.approx(meeting(0.8, 6, 24)) == pytest.approx(1 - (1 - 0.8**6) ** 24)
    high, low = ({b: 100_000} for b in (15, 0))
    assert measured_recall(high, 0.8, 10, 24) > 0.9999 > measured_recall(low, 0.8, 6, 24) > measured_recall(low, 0.8, 7, 24)


def test_forest_edges_hold_the_trie(spark):
    """Edges of level d or more connect exactly the rows that share d values in a tree, over partition borders too."""
    rnd = random.Random(3)
    rows = [(i, [bytes(x for _ in range(4) for x in (0, rnd.choice((1, 1, 1, 2)))) for _ in range(2)]) for i in range(300)]
    found = forest(spark.createDataFrame(rows, "rid long, signature array<binary>").repartition(5), 4, 1, Scratch(spark, "test")).collect()
    for depth in (1, 2, 3, 4):
        root = list(range(300))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for tree in (0, 1):  # by the definition
            first = {}
            for i, signature in rows:
                root[find(i)] = find(first.setdefault(signature[tree][: 2 * depth], i))
        expected = {frozenset(x for x in range(300) if find(x) == r) for r in range(300) if find(r) == r}
        root[:] = range(300)
        for e in found:
            if e.level >= depth:
                root[find(e.u)] = find(e.v)
        assert {frozenset(x for x in range(300) if find(x) == r) for r in range(300) if find(r) == r} == expected


def test_components(spark):
    edges = [(2, 1), (3, 2), (4, 3), (9, 8), (7, 7), (20, 9), (3, 1), (None, 1), (5, None), (3, 1)]
    found = connected(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test"), "c")
    same(found, ["node", "root"], [(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8), (20, 8)])
    assert connected(spark.createDataFrame([], "u long, v long"), Scratch(spark, "test"), "c").count() == 0


def test_components_with_a_hub(spark):
    edges = [(1000, i) for i in range(1500) if i != 1000] + [(5000, 5001)]
    found = connected(spark.createDataFrame(edges, "u long, v long").repartition(3), Scratch(spark, "test"), "c")
    same(found, ["node", "root"], [(i, 0) for i in range(1500)] + [(5000, 5000), (5001, 5000)])


def test_meet_parts_the_hot_keys(spark):
    left = spark.createDataFrame([(1, i) for i in range(900)] + [(k, k) for k in range(2, 60)], "k long, i long")
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.sum("i").alias("s")).where("k < 50")
    same(meet(left, right, ["k"], "n", 958), ["k", "i", "n", "s"], left.join(right, "k").select("k", "i", "n", "s").collect())


def test_quality(docs, empty):
    def measure(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        n, hit = collections.Counter(grams), set()
        for i, g in enumerate(grams):
            hit |= set(range(i, i + 3)) if n[g] > 1 else set()
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), sum(map(t.count, SYMBOLS)), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)

    same(judge(docs), ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"], [(i, *measure(t)) for (i, _), t in zip(ROWS, TEXTS, strict=True)])
    book = ledger(docs)
    rows = {r.rule: r for r in ablation(book, POLICIES["v1"]).collect()}
    failed = [r.failed & POLICIES["v1"].mask for r in book.collect()]
    assert rows["few_words"].n_failed == sum(f & 1 for f in failed) and rows["few_words"].n_failed_alone == failed.count(1)
    assert judge(docs).where("base_failed and kept").count() == 0
    assert judge(empty).count() == 0
    assert {r.n_failed for r in ablation(ledger(empty), POLICIES["v2"]).collect()} == {0}


def test_sentencepiece(docs, empty):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    library, pieces = sentencepiece.SentencePieceProcessor(model_file=path), Pieces.read(path)
    ids = [tuple(library.encode(t)) for t in TEXTS]
    coded = encode_texts(docs, pieces)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in coded.collect()) == collections.Counter((i, x) for (i, _), x in zip(ROWS, ids, strict=True))
    same(decode_ids(coded, pieces), ["doc_id", "text"], [(i, t.replace("▁", " ")) for (i, _), t in zip(ROWS, TEXTS, strict=True)])
    same(code_texts(docs, pieces), ["doc_id", "n_tokens", "round_trip"], [(i, len(x), "▁" not in t) for (i, _), t, x in zip(ROWS, TEXTS, ids, strict=True)])
    assert code_texts(empty, pieces).count() == 0


def test_unigram_viterbi_takes_the_best_sum():
    scores = {"▁": (0, -3.0), "a": (1, -2.0), "b": (2, -2.5), "ab": (3, -3.9), "▁a": (4, -3.2), "ba": (5, -4.0), "aba": (6, -9.0)}
    codec = Codec(Pieces(scores, (), 9, (), False, {}, {}))

    def best(text):
        if not text:
            return 0.0, ()
        return max((best(text[len(p) :])[0] + s, (p, *best(text[len(p) :])[1])) for p, (_, s) in scores.items() if text.startswith(p))

    for text in ("▁ab", "▁abab", "▁aba", "▁bba", "aabb"):
        assert sum(scores[p][1] for p in codec.split(text)) == pytest.approx(best(text)[0])


def test_warc_revisits(spark):
    def capture(i, url, ts, kind, tag=None, modified=None, digest=None, **headers):
        return (i, url, ts, kind, tag, modified, digest, headers or None)

    rows = [
        capture(1, "http://www.A.example/x/", 100, "response", '"e1"', etag='"e1"', server="s", date="d1"),
        capture(2, "https://a.example:443/x?utm_source=q#f", 200_000, "revisit", 'W/"e1"', date="d2", server="edge"),
        capture(3, "http://a.example/x", 300_000, "response", '"e2"'),
        capture(4, "http://a.example/x", 300_000, "revisit", '"e1"', date="d3"),
        capture(5, "http://a.example/x", 300_001, "revisit", '"e1"'),
        capture(6, "http://a.example/x", 50, "revisit", '"e1"'),
        capture(7, "http://b.example/", 5, "response", None, "m", "g"),
        capture(7, "http://b.example/", 5, "response", None, "m", "g"),
        capture(8, "http://b.example", 6, "revisit", None, "m"),
        capture(9, "http://b.example", 7, "revisit", None, None, "g"),
        capture(10, "http://b.example", 8, "revisit"),
        capture(11, None, 8, "revisit"),
        capture(12, "http://b.example", None, "revisit"),
    ]
    schema = "record_id long, url string, ts long, kind string, etag string, last_modified string, digest string, headers map<string,string>"
    table = spark.createDataFrame(rows, schema)
    found = resolve_revisits(table)
    same(
        found.where("kind = 'revisit'"),
        ["record_id", "base_id", "state"],
        [(2, 1, "resolved"), (4, 1, "resolved"), (5, None, "not_matching"), (6, None, "no_response"), (8, 7, "resolved"), (9, 7, "resolved"), (10, None, "not_matching"), (11, None, "no_response"), (12, None, "no_response")],
    )
    assert found.where("record_id = 2").first().headers == 'date: d2\netag: "e1"\nserver: s'
    assert resolve_revisits(table.limit(0)).count() == 0
    extra = table.withColumns({c: F.lit("x" * 5000) for c in ("url_key", "block", "slice", "n", "base", "state", "full")}).withColumn("headers", F.map_concat("headers", F.create_map(F.lit("etag2"), F.lit("y" * 100_000), F.lit("none"), F.lit(None).cast("string"))))
    same(resolve_revisits(extra), ["record_id", "base_id", "state"], found.select("record_id", "base_id", "state").collect())
    same(spark.createDataFrame([("HTTP://WWW.Ex.org:80/A/?ref=1&b=2#z",)], "u string").select(canonical(F.col("u"))), ["*"], [("ex.org/A/?b=2",)])


def test_canonical_keeps_names_that_end_like_tracking_parameters(spark):
    urls = ["http://a.example/?xref=1", "http://a.example/?xref=2", "http://a.example/?b=1&pageref=2", "http://a.example/?utm_source=q&utm_medium=r&xref=1&ref=3"]
    found = spark.createDataFrame([(u,) for u in urls], "u string").select(canonical(F.col("u")))
    same(found, ["*"], [("a.example/?xref=1",), ("a.example/?xref=2",), ("a.example/?b=1&pageref=2",), ("a.example/?xref=1",)])


def test_toxicity(spark, docs, empty):
    rnd = random.Random(3)
    calm = "the river runs past a mill and children read books near old trees in summer".split()
    rude = ["idiot", "moron", "scumbag"]
    rows, labels = [], []
    for i in range(240):
        words, toxic = rnd.choices(calm, k=25), i % 3 == 0
        if toxic:
            words[rnd.randrange(25)] = rnd.choice(rude)
            words[rnd.randrange(25)] = rnd.choice(rude)
        rows.append((i, " ".join(words[:12]) + ". " + " ".join(words[12:])))
        labels.append((i, int(toxic)))
    table, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, None), (0, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity(table, marks).collect()}
    held = [found[i].predicted == y for i, y in labels if found[i].held_out]
    assert len(held) > 50 and sum(held) / len(held) > 0.95
    model = train([(t, y) for (_, t), (_, y) in zip(rows, labels, strict=True)])
    odd = spark.createDataFrame([(1, "you are an id-iot and a moroon"), (2, "the river runs past"), (3, None), (4, "")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in score_texts(odd, model).collect()}
    assert scores[1] > scores[2] and all(0 <= s <= 1 for s in scores.values())
    assert score_texts(docs, model).count() == len(ROWS)
    assert score_texts(empty, train([])).count() == 0


def test_toxicity_of_cut_up_words(spark):
    rnd = random.Random(4)
    calm = "the river runs past a mill and children read books near old trees in summer".split()
    rows = []
    for i in range(240):
        words = rnd.choices(calm, k=25)
        if i % 3 == 0:
            words[rnd.randrange(25)] = rnd.choice(["idiot", "moron", "scumbag"])
        rows.append((" ".join(words[:12]) + ". " + " ".join(words[12:]), int(i % 3 == 0)))
    cut = ["idi-ot", "mo.ron", "mo ron", "i*d*i*o*t", "i__d__i__o__t", "i.d.i.o.t", "i d i o t", "i. d. i. o. t", "m***o***r***o***n", "s c u m b a g", "i\u200bd\u200bi\u200bo\u200bt"]
    clean = ["mill", "old", "u.s.a.", "e.g.", "a b c", "well-read", "mor", "past/near"]
    texts = [f"The river runs past {w} in summer. Children read." for w in cut + clean]
    found = {r.doc_id: r.score for r in score_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), train(rows)).collect()}
    assert [w for i, w in enumerate(cut) if found[i] < 0.7] == []
    assert [w for i, w in enumerate(clean, len(cut)) if found[i] >= 0.7] == []


def repeats(length):
    texts = [t.encode().split() for t in TEXTS]
    n = collections.Counter(tuple(w[a : a + length]) for w in texts for a in range(len(w) - length + 1))
    for (i, _), w in zip(ROWS, texts, strict=True):
        hit = set()
        for a in range(len(w) - length + 1):
            if n[tuple(w[a : a + length])] > 1:
                hit |= set(range(a, a + length))
        yield i, len(w), len(hit), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in hit)).hexdigest()


@pytest.mark.parametrize(("operator", "length"), [(drop_repeats, 35), (mark_repeats, 50)])
def test_repeats(docs, empty, operator, length):
    expected = list(repeats(length))
    same(operator(docs), ["doc_id", "n_words", "n_removed", "kept_sha256"], expected)
    cut = operator(docs, also=("lang",), text_out=True).collect()
    assert collections.Counter((r.doc_id, hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest()) for r in cut) == collections.Counter((i, h) for i, _, _, h in expected)
    assert operator(empty).count() == 0



def test_toxicity_of_held_out_texts(spark):
    from tallyforge.llm.queries import op8_toxicity

    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").distinct()
    found = op8_toxicity(spark, folder).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hit = sum(r.predicted == r.toxic == 1 for r in found)
    assert hit >= 0.9 * sum(r.predicted for r in found) and hit >= 0.7 * sum(r.toxic for r in found) and hit > 10


def test_cross_validation_never_scores_a_text_by_a_model_that_saw_it():
    rows = [(f"you are a blorf number {i} . fine words here", 1) for i in range(30)] + [(f"all is well with number {i} . fine words here", 0) for i in range(60)]
    scores = cross_validated(rows, 5)
    assert min(s for s, (_, y) in zip(scores, rows, strict=True) if y) > max(s for s, (_, y) in zip(scores, rows, strict=True) if not y)
    alone = [("zig zag", 1), *[("plain talk", 0)] * 4]
    assert cross_validated(alone, 5)[0] == 0.0  # the other folds hold no toxic text


def test_phrases_of_a_block_are_small():
    import tracemalloc

    from tallyforge.llm.decontamination import Phrases

    rnd = random.Random(13)
    words = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(30_000)]
    items = [(i, " ".join(rnd.choices(words, k=200))) for i in range(3400)]  # 4 MB
    tracemalloc.start()
    made = Phrases(items, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(made.sizes) == 3400 * 191 and peak < 100e6
    twice = Phrases([(1, "a b c"), (2, "c b"), (2, None), (None, "a b c"), (3, "a b c d e")], 3)
    assert sorted(sorted(twice.items_of(p)) for p in range(len(twice.sizes))) == [[1, 3], [2], [3], [3]] and twice.shortest == 2


def test_model_kinds(tmp_path):
    from tallyforge.llm.sentencepiece_codec import BPE, UNIGRAM, model_kind

    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        assert model_kind(f.read()) == BPE
    assert model_kind(b"") == UNIGRAM and model_kind(b"\x12\x02\x18\x04") == 4
    (tmp_path / "char.model").write_bytes(b"\x12\x02\x18\x04")
    with pytest.raises(ValueError, match="neither"):
        Pieces.read(str(tmp_path / "char.model"))
