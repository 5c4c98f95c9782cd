"""Toxicity by a gapped-subsequence string kernel, Nyström landmarks and a linear SVM.

The kernel of two words sums, over all four-character subsequences that both have within a
span of six characters, a decay for each character skipped; word ends count as characters. An
insult with up to two inserted or left-out characters so keeps most of its likeness. A power of
the scaled kernel sharpens it. Signs and spaces are no characters of a word: a token with signs
inside counts as its parts and as the whole without the signs, and neighbouring single letters
count joined as well, so an insult with any number of dots, stars or spaces between its letters
counts whole. Longer neighbouring parts are joined in scoring where they spell a toxic
landmark. Sentences end at a line's end, or at a stop before white space that follows no single
letter. Landmarks are words of labelled training sentences; a sentence is
the sum of its distinct words, so after training every word has one number, remembered by the
workers.

A labelled text says only that some of its sentences are toxic: training starts from all
sentences of toxic texts, then keeps those that its own scores rank highest in each text and
fits again. A logistic step turns a text's sentence scores into a probability; it is fitted on scores by
machines that have not seen the text. DECAY, SHARPEN, SPAN and JOINED were chosen by ``cross_validated`` on
training rows alone; held-out rows were scored once, after that.

Training takes at most ``per_class`` toxic and twice as many clean labelled texts, of at most ``max_chars``
characters (parameters), chosen by a hash of their id; scoring reads every text whole.

Defined results: null and empty texts score as a text without sentences; if the training rows
lack a class or any word, the score is 0; a label that is null is not used; of several labels of one
id the least counts; repeated rows score alike; an empty table has no scores; extra columns are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import pick, tune

MEMO = 100_000
BITS = 20
DECAY = 0.4
SHARPEN = 3
#: The hinge losses' total weight against the ridge penalty.
COST = 100_000.0
#: The logistic step sees scores of machines that were fitted without a text's fold, one of so many.
FOLDS = 4
#: Training sentences whose words are held at once.
SENTENCES = 500
#: Characters of texts that are split into words at once, and of words whose kernel values are held at once.
TEXT_CHARS, WORD_CHARS = 1 << 18, 1 << 14
#: Places of a subsequence's characters from its first one on: all choices within six.
SPAN = 6
PLACES = [(0, a, b, c) for a in range(1, SPAN - 2) for b in range(a + 1, SPAN - 1) for c in range(b + 1, SPAN)]
SENTENCE = re.compile(r"(?<!\b\w)[.!?]+(?=\s|$)|\n+")
#: Single letters joined at most.
JOINED = 12
#: Signs part a token; apostrophes and invisible characters do not.
KINDS = ((c, unicodedata.category(chr(c))) for c in range(sys.maxunicode + 1))
SIGNS = {c: " " if kind != "Cf" else None for c, kind in KINDS if kind[0] in "PS" or kind == "Cf"} | {ord("'"): None, ord("’"): None}


def parts_and_wholes(sentence: str, spelled: frozenset[str], starts: frozenset[str]) -> list[str]:
    """The distinct parts of a sentence's tokens, then tokens and neighbouring parts joined over signs and spaces."""
    parts, wholes = [], {}
    for t in sentence.split():
        if t.isalnum():
            parts.append(t)
            continue
        inner = t.translate(SIGNS).split()
        parts += inner
        if len(inner) > 1:
            wholes["".join(inner)] = None
    for a, w in enumerate(parts):
        if len(w) == 1:
            for b in range(a + 1, min(a + JOINED, len(parts))):
                if len(parts[b]) > 1:
                    break
                w += parts[b]
                if b > a + 1:
                    wholes[w] = None
            w = parts[a]
        b = a
        while w in starts and (b := b + 1) < len(parts):
            w += parts[b]
            if w in spelled:
                wholes[w] = None
    return list(dict.fromkeys([*parts, *wholes]))


def beginnings(words: frozenset[str]) -> frozenset[str]:
    return frozenset(w[:n] for w in words for n in range(1, len(w)))


def sentences(text: str, spelled: frozenset[str] = frozenset(), starts: frozenset[str] = frozenset()) -> list[list[str]]:
    """Words by sentence; ``spelled`` are those that neighbouring parts may spell, ``starts`` their beginnings."""
    return [w for s in SENTENCE.split(text.lower()) if (w := parts_and_wholes(s, spelled, starts))]


def pieces(words: list[str]) -> Iterator[tuple[list[str], list[int], np.ndarray]]:
    """(words with their end signs, how many characters may begin a subsequence in each, owners), in bounded lots.

    A word longer than a lot is cut into pieces that overlap by a span less one, so that every
    subsequence begins in one piece alone.
    """
    part, begin, of, held = [], [], [], 0
    for i, w in enumerate(words):
        w = f"\x02{w}\x03"
        for lo in range(0, len(w), WORD_CHARS):
            part.append(w[lo : lo + WORD_CHARS + SPAN - 1])
            begin.append(WORD_CHARS)
            of.append(i)
            held += len(part[-1])
            if held > 2 * WORD_CHARS:
                yield part, begin, np.array(of)
                part, begin, of, held = [], [], [], 0
    if part:
        yield part, begin, np.array(of)


def subsequences(parts: list[str], begin: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, hashed subsequence, weight) of every occurrence that begins in the first ``begin`` characters, in no order."""
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    owner = np.repeat(np.arange(len(parts)), sizes)
    stop = np.cumsum(sizes)[owner]
    inside = np.arange(len(codes)) < (np.cumsum(sizes) - sizes + np.array(begin, np.int64))[owner]
    found = []
    for place in PLACES:
        at = np.flatnonzero(inside & (np.arange(len(codes)) + place[3] < stop))
        key = np.zeros(len(at), np.uint64)
        for p in place:
            key = (key + codes[at + p] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        found.append((owner[at], (key >> np.uint64(64 - BITS)).astype(np.int64), np.full(len(at), DECAY ** (place[3] - 3), np.float32)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Kernel:
    """The scaled kernel, to the power SHARPEN, between words and a fixed list of landmarks."""

    def __init__(self, landmarks: list[str]):
        lots = [(of[o], f, w) for parts, begin, of in pieces(landmarks) for o, f, w in [subsequences(parts, begin)]]
        owner, feature, weight = (np.concatenate(x) for x in zip(*lots, strict=True))
        features, self.row = np.unique(feature), np.full(1 << BITS, -1, np.int32)
        self.row[features] = np.arange(len(features))
        self.table = np.zeros((len(features), len(landmarks)), np.float32)
        np.add.at(self.table, (self.row[feature], owner), weight)
        self.table /= np.sqrt(np.bincount(owner, weight.astype(float) ** 2, len(landmarks)) + 1e-9)

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.table.shape[1]), np.float32)
        size = np.zeros(len(words))
        for parts, begin, of in pieces(words):
            owner, feature, weight = subsequences(parts, begin)
            owner = of[owner]
            size += np.bincount(owner, weight.astype(float) ** 2, len(words))
            row = self.row[feature]
            met = row >= 0
            order = np.argsort(owner[met], kind="stable")
            owner, row, weight = owner[met][order], row[met][order], weight[met][order]
            for a in range(0, len(owner), 20_000):  # bounds the gathered rows
                o, r, w = owner[a : a + 20_000], row[a : a + 20_000], weight[a : a + 20_000]
                first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
                out[o[first]] += np.add.reduceat(self.table[r] * w[:, None], first, axis=0)
        out /= np.sqrt(size + 1e-9)[:, None]
        return out**SHARPEN

    def weigh(self, words: list[str], beta: np.ndarray) -> list[float]:
        """One number a word, its kernel values times ``beta``; few words' values are held at once."""
        out, part, held = [], [], 0
        for w in words:
            part.append(w)
            held += len(w) + 2
            if held > WORD_CHARS:
                out += (self(part) @ beta).tolist()
                part, held = [], 0
        return out + ((self(part) @ beta).tolist() if part else [])


def fit_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, use: np.ndarray, ridge: float = 1.0, active: np.ndarray | None = None) -> np.ndarray:
    """Weights of a linear SVM with squared hinge loss on the rows in ``use``, by Newton steps on the active ones.

    The last column of ``x`` is 1, so that the last weight is the bias. ``active`` are rows to begin with.
    """
    penalty = np.diag(np.r_[np.full(x.shape[1] - 1, ridge), 1e-6])
    active = use if active is None else active & use
    for _ in range(25):
        square, side, rows = penalty.copy(), np.zeros(len(penalty)), np.flatnonzero(active)
        for lo in range(0, len(rows), 4096):
            r = rows[lo : lo + 4096]
            part = x[r].astype(float)
            square += part.T @ (part * cost[r, None])
            side += part.T @ (cost[r] * y[r])
        w = np.linalg.solve(square, side)
        now = use & (y * products(x, w) < 1)
        if (now == active).all():
            break
        active = now
    return w


def products(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x @ w`` without a second ``x`` in double precision."""
    return np.concatenate([x[lo : lo + 4096] @ w for lo in range(0, len(x), 4096)])


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + 1e-2 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(h, g)
    return w


@dataclass
class Model:
    kernel: Kernel | None
    beta: np.ndarray
    bias: float
    scale: np.ndarray
    #: Toxic landmarks, which neighbouring parts may spell.
    spelled: frozenset[str] = frozenset()


def digest(scores: np.ndarray) -> list[float]:
    """What the logistic step sees of a text's sentence scores."""
    if not len(scores):
        return [-2.0, -2.0, -2.0, 0.0]
    top = np.sort(scores)[::-1]
    return [float(top[0]), float(top[:3].mean()), float(scores.mean()), float(np.log1p(len(scores)))]


def train(rows: list[tuple[str, int]], *, landmarks: int = 160) -> Model:
    """A model from (text, label) rows; every step is determined by the rows."""
    known: dict[str, str] = {}
    texts = [[[known.setdefault(w, w) for w in s] for s in sentences(t or "")] for t, _ in rows]
    labels = np.array([y for _, y in rows])
    met: dict[str, list[int]] = {}
    for split, y in zip(texts, labels, strict=True):
        for w in {w for s in split for w in s if len(w) < 40}:
            met.setdefault(w, [0, 0])[int(y)] += 1
    if not met or len(set(labels.tolist())) < 2:
        return Model(None, np.zeros(0), 0.0, np.zeros(5))
    n = np.bincount(labels, minlength=2)
    words = sorted(met)
    clean, toxic = (np.array([met[w][c] for w in words], float) for c in (0, 1))
    odds = (np.log((toxic + 1) / (n[1] + 2)) - np.log((clean + 1) / (n[0] + 2))) / np.sqrt(1 / (toxic + 1) + 1 / (clean + 1))
    best = np.argsort(-odds, kind="stable")[: landmarks * 3 // 4]
    chosen = [words[i] for i in best]
    spelled = frozenset(words[i] for i in best if odds[i] > 0)
    chosen += [words[i] for i in np.argsort(-clean, kind="stable")[: landmarks // 4]]
    chosen = list(dict.fromkeys(chosen))
    kernel = Kernel(chosen)
    values, vectors = np.linalg.eigh(kernel(chosen).astype(float))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T
    flat = [s for t in texts for s in t]
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    x, narrow = np.ones((len(flat), len(chosen) + 1), np.float32), root.astype(np.float32)
    for lo in range(0, len(flat), SENTENCES):  # bounds the words whose kernel values are held
        part = flat[lo : lo + SENTENCES]
        number = {w: i for i, w in enumerate(dict.fromkeys(w for s in part for w in s))}
        table = kernel(list(number))
        at = np.fromiter((number[w] for s in part for w in s), np.int64)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
        x[lo : lo + len(part), :-1] = np.add.reduceat(table[at], np.r_[0, ends[:-1]], axis=0) @ narrow
    y = np.where(labels[of] == 1, 1.0, -1.0)
    use, active = np.ones(len(x), bool), None
    for _ in range(4):
        cost = costs(y, use)
        w = fit_svm(x, y, cost, use, active=active)
        score = products(x, w)
        active = y * score < 1
        use = y < 0
        for d in np.flatnonzero(labels == 1):  # the best third of each toxic text's sentences, one at least
            mine = np.flatnonzero(of == d)
            use[mine[np.argsort(-score[mine], kind="stable")[: max(1, len(mine) // 3)]]] = True
    apart = np.empty_like(score)  # scores by machines that have not seen the text
    fold = (np.arange(len(texts)) % FOLDS)[of]
    for k in range(FOLDS):
        own, rest = fold == k, use & (fold != k)
        if own.any() and (y[rest] > 0).any() and (y[rest] < 0).any():
            apart[own] = products(x[own], fit_svm(x, y, costs(y, rest), rest, active=active))
        else:
            apart[own] = score[own]
    ends = np.searchsorted(of, np.arange(len(texts) + 1))
    seen = np.array([digest(apart[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)])
    return Model(kernel, root @ w[:-1], float(w[-1]), fit_logistic(seen, labels), spelled)


def costs(y: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Each class has half of all costs, however many rows it has."""
    positive, negative = (max(1, int((y[use] * side > 0).sum())) for side in (1, -1))
    return np.where(y > 0, 1 / (2 * positive), 1 / (2 * negative)) * COST


def cross_validated(rows: list[tuple[str, int]], folds: int = 5, **settings: int) -> list[float]:
    """The score of each training text by a model that is trained without its fold: what settings are chosen by."""
    scores = [0.0] * len(rows)
    for k in range(folds):
        own = list(range(k, len(rows), folds))
        model = train([r for i, r in enumerate(rows) if i % folds != k], **settings)
        for i, s in zip(own, Scorer(model)([rows[i][0] or "" for i in own]), strict=True):
            scores[i] = s
    return scores


class Scorer:
    def __init__(self, model: Model):
        self.model, self.memo, self.starts = model, {}, beginnings(model.spelled)

    def __call__(self, texts: list[str]) -> list[float]:
        if self.model.kernel is None:
            return [0.0] * len(texts)
        out, part, held = [], [], 0
        for t in texts:  # a lot's words are held as Python strings, ten times a batch's size
            part.append(t)
            held += len(t)
            if held > TEXT_CHARS:
                out += self._lot(part)
                part, held = [], 0
        return out + self._lot(part)

    def _lot(self, texts: list[str]) -> list[float]:
        m, memo = self.model, self.memo
        if len(memo) > MEMO:
            memo.clear()
        split = [sentences(t, m.spelled, self.starts) for t in texts]
        new = list({w for t in split for s in t for w in s if w not in memo})
        memo.update(zip(new, m.kernel.weigh(new, m.beta), strict=True))
        seen = np.array([digest(np.array([m.bias + sum(map(memo.__getitem__, s)) for s in t])) for t in split]).reshape(len(texts), 4)
        return (1 / (1 + np.exp(-np.clip(seen @ m.scale[:-1] + m.scale[-1], -30, 30)))).tolist()


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, *, per_class: int = 800, max_chars: int = 10_000) -> list[tuple[str, int]]:
    """The bounded training sample: never a held-out row.

    Only ids are shuffled to find it: those whose hash lies below a share of the hash range that
    holds about the wanted number. The chosen ids, at most three times ``per_class``, then meet
    their texts in a broadcast join; of texts with one id the least counts.
    """
    base = pick(docs).where(~held_out("doc_id") & (F.length("text") <= max_chars))
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    ids = base.select("doc_id").distinct().join(marked, "doc_id").select("doc_id", "toxic", place.alias("place"))
    chosen = []
    for y, n in ids.groupBy("toxic").count().collect():
        most = per_class if y else 2 * per_class
        share = int((1 << 32) * min(1.0, 1.2 * most / n))
        found = ids.where((F.col("toxic") == y) & (F.col("place") < share)).collect()
        chosen += sorted(found, key=lambda r: (r.place, r.doc_id))[:most]
    if not chosen:
        return []
    few = docs.sparkSession.createDataFrame(chosen, ids.schema)
    rows = base.join(F.broadcast(few), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    return [(r.text, r.toxic) for r in sorted(rows, key=lambda r: r.doc_id)]


def score_texts(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every text; with columns named in ``also``, these and the text too."""
    spark = docs.sparkSession
    tune(spark)
    shared = spark.sparkContext.broadcast(model)
    base = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), *(docs[c] for c in also))
    out = [f for f in base.schema.fields if f.name != "text" or also]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out)

    def run(batches):
        score = Scorer(shared.value)
        for b in batches:
            scores = pa.array(score(b.column(1).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in out), scores], [*(f.name for f in out), "score"])

    found = base.mapInArrow(run, f"{kinds}, score double")
    return found.select(*(f.name for f in out), held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, **settings: int) -> DataFrame:
    return score_texts(docs, train(training_rows(docs, labels, **settings)))
