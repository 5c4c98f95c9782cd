"""The pipeline's stages against plain Python, each from its own input, on a small corpus with odd rows; and the kernel against its definition."""

import collections
import itertools
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from tallyforge.llm import toxicity as tox
from tallyforge.llm.queries import tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WHITE = r"[^\x20\x09-\x0D]+"
ITEM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(4)
    words = [a + b for a in ("ba", "do", "ki", "lu", "ne") for b in ("r", "st", "na", "tok", "l")]
    talk = lambda n: " ".join(rnd.choices(words, k=n))
    shared, item = talk(60), talk(14)
    rows, labels = [], []
    for i in range(120):
        text = talk(rnd.choice((20, 60, 120)))
        if i % 4 == 0:
            text += ". you blorg grumpfh" + talk(5)
            labels.append((i, 1))
        else:
            labels.append((i, 0))
        if i % 6 == 1:
            text += "\n" + shared + " " + talk(8)
        if i % 10 == 3:
            text = talk(6) + " " + item.upper() + ", " + text
        rows.append((i, text, "en", "s", len(text)))
    near = rows[5][1].split()
    near[3] = "other"
    rows += [(200, " ".join(near), "en", "s", 1), (201, rows[5][1], None, None, None), (201, rows[5][1], None, None, None), (202, None, None, None, None), (203, "", "en", "s", 0), (204, " \n ", "en", "s", 3), (None, "İ 漢字 🙂 lone words", "en", "s", 9), (205, "ab " * 9000, "en", "s", 27000)]
    where = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"file://{where}/documents.parquet")
    spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int").write.parquet(f"file://{where}/labels.parquet")
    spark.createDataFrame([(1, item), (2, "kir"), (3, None), (None, "none of these")], "item_id long, text string").write.parquet(f"file://{where}/benchmark.parquet")
    return f"file://{where}"


def plain(rows):
    return collections.Counter((r.doc_id, r.text or "", r.lang, r.source, len(r.text or "")) for r in rows)


def near_duplicates(rows):
    sets = []
    for r in rows:
        w = (r.text or "").encode().split()
        k = min(5, len(w))
        sets.append(frozenset(tuple(w[a : a + k]) for a in range(len(w) - k + 1)) if w else frozenset())
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    kept = {}
    for r, g in zip(rows, group, strict=True):
        if g not in kept or (r.doc_id or -1) < (kept[g].doc_id or -1):
            kept[g] = r
    return plain(kept.values())


def repeats(rows):
    seen = collections.Counter(tuple(w[a : a + 35]) for r in rows for w in [re.findall(WHITE, r.text or "")] for a in range(len(w) - 34))
    out = collections.Counter()
    for r in rows:
        w = re.findall(WHITE, r.text or "")
        gone = {x for a in range(len(w) - 34) if seen[tuple(w[a : a + 35])] > 1 for x in range(a, a + 35)}
        out[(r.doc_id, tuple(x for i, x in enumerate(w) if i not in gone))] += 1
    return out


def leaks(rows, items):
    low = lambda t: re.findall(ITEM, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[a : a + min(10, len(w))]) for t in items for w in [low(t)] if w for a in range(len(w) - min(10, len(w)) + 1)}
    out = collections.Counter()
    for r in rows:
        w = low(r.text)
        hit = {x for n in {len(x) for x in windows} for a in range(len(w) - n + 1) if tuple(w[a : a + n]) in windows for x in range(a, a + n)}
        out[(r.doc_id, tuple(x for i, x in enumerate(w) if i not in hit))] += 1
    return out, low


def test_every_stage_does_its_whole_work(spark, corpus, tmp_path):
    import sentencepiece

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    model = tox.train(tox.training_rows(docs, spark.read.parquet(f"{corpus}/labels.parquet")))
    rows = docs.collect()
    scores = tox.Scorer(model)([r.text or "" for r in rows])
    expected = plain(r for r, s in zip(rows, scores, strict=True) if s < 0.7)
    flagged = [r.doc_id for r, s in zip(rows, scores, strict=True) if s >= 0.7]
    assert set(range(0, 120, 4)) <= set(flagged) and set(flagged) - set(range(0, 120, 4)) <= {205, None}  # words unlike any of the 80 training texts
    last, columns = rows, docs.columns
    for name, stage in stages.items():
        stage(spark, docs, corpus).write.parquet(f"file://{tmp_path}/{name}")
        docs = spark.read.parquet(f"file://{tmp_path}/{name}")
        rows = docs.collect()
        assert name == "sentencepiece" or (docs.columns == columns and all(r.n_chars == len(r.text) for r in rows))
        if name == "toxicity":
            assert plain(rows) == expected
        elif name == "near_duplicates":
            assert plain(rows) == near_duplicates(last) and len(rows) < len(last)
        elif name == "substring_dedup":
            assert collections.Counter((r.doc_id, tuple(re.findall(WHITE, r.text))) for r in rows) == repeats(last)
        elif name == "decontamination":
            wanted, low = leaks(last, [r.text for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()])
            assert collections.Counter((r.doc_id, tuple(low(r.text))) for r in rows) == wanted
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
            assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == collections.Counter((r.doc_id, len(r.text.encode()), len(library.encode(r.text))) for r in last)
        last = rows


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_every_stage_takes_an_empty_table(spark, corpus, stage):
    assert dict(corpus_pipeline.STAGES)[stage](spark, spark.createDataFrame([], DOCS), corpus).count() == 0


def test_kernel_is_the_subsequence_kernel():
    words = ["idiot", "idi-ot", "i.d.i.o.t", "banana", "b", "idiotic", "toidi"]

    def features(word):
        found, word = collections.defaultdict(float), f"\x02{word}\x03"
        size = 0.0
        for at in itertools.combinations(range(len(word)), 4):
            if at[3] - at[0] < tox.SPAN:
                weight = tox.DECAY ** (at[3] - at[0] - 3)
                found["".join(word[i] for i in at)] += weight
                size += weight**2
        return found, np.sqrt(size + 1e-9)

    each = [features(w) for w in words]
    expected = np.array([[(sum(v * b[k] for k, v in a.items() if k in b) / (m * n)) ** tox.SHARPEN for b, n in each] for a, m in each])
    assert np.allclose(tox.Kernel(words)(words), expected, atol=1e-3)


def test_kernel_of_a_long_word_is_that_of_its_pieces(monkeypatch):
    words = ["idiot" * 40, "x" * 300, "ab"]
    kernel = tox.Kernel(["idiot", "xxxx", "abab"])
    whole = kernel(words)
    monkeypatch.setattr(tox, "WORD_CHARS", 16)
    assert np.allclose(kernel(words), whole, atol=1e-4) and np.allclose(kernel.weigh(words, np.ones(3)), whole.sum(axis=1), atol=1e-4)
