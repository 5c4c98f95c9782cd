"""Benchmark decontamination with an FM-index per training shard.

A shard is the documents of one Arrow batch. Its words become numbers; a word that no test
phrase has ends a run, for no phrase can span it, and runs shorter than the shortest phrase are
left out, so the index holds every place where a phrase can stand and nothing else. The runs'
suffix array gives the Burrows-Wheeler transform, kept as a wavelet matrix; all phrases are
searched backwards at once through its ranks, occurrences are located by walking to sampled
suffix positions, and the located spans merge into the removal spans of each document.

Test phrases go to the executors in blocks of about half of ``BLOCK_BYTES`` of text each (or one
longer item), every block searched against all rows. If all phrases fit one block, documents are
never shuffled. Else the driver holds one block at a time, each pass writes the hits of its block
to the shared folder, and at the end the hits meet their rows.

Defined results: null or empty texts have no words and no hits; an item without words has no
phrase; items that repeat count once by their id; an item whose id is null marks words as hit
but is not listed; repeated documents are judged each by itself; empty tables have no rows and no
hits; columns not named in ``also`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, tune
from tallyforge.llm.passages import numbered

BLOCK_BYTES = 16 * 1024 * 1024
#: Every so many-th position of a run keeps its place in the text.
SAMPLE = 8

#: a-z, 0-9 and all bytes from 0x80 are word bytes, A-Z become lower case, all else separates.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_BYTES).split()


class Phrases:
    """The distinct test phrases of one block of items, and the items that have each, in flat arrays."""

    def __init__(self, items: list[tuple], size: int):
        vocabulary: dict[bytes, int] = {}
        lots, widths, owner = [np.zeros((0, size), np.int32)], [], []
        for number, (_, text) in enumerate(items):
            ids = np.fromiter((vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text or "")), np.int32)
            if len(ids):
                width = min(size, len(ids))
                rows = np.zeros((len(ids) - width + 1, size), np.int32)
                rows[:, size - width :] = np.lib.stride_tricks.sliding_window_view(ids, width)  # right-aligned: searched from the last word on
                lots.append(rows)
                widths.append(np.full(len(rows), width, np.int8))
                owner.append(np.full(len(rows), number, np.int32))
        self.vocabulary, self.names = vocabulary, [i for i, _ in items]
        rows, width = np.concatenate(lots), np.concatenate([np.zeros(0, np.int8), *widths])
        del lots
        key = np.zeros(len(rows), np.uint64)
        for k in range(size):
            key = (key ^ rows[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        order = np.argsort(key, kind="stable")
        if (key[order[1:]] == key[order[:-1]]).any():  # equal keys of different phrases are told apart in full
            order = order[np.lexsort((*(rows[order, k] for k in range(size)), key[order]))] if self._clash(rows, key, order) else order
        new = np.ones(len(rows), bool)
        for a in range(1, len(rows), 1 << 16):  # neighbours are compared word by word
            b = min(len(rows), a + (1 << 16))
            new[a:b] = (rows[order[a:b]] != rows[order[a - 1 : b - 1]]).any(axis=1)
        self.words, self.sizes = rows[order[new]], width[order[new]].astype(np.int64)
        pairs = np.unique((np.cumsum(new) - 1) * np.int64(max(1, len(items))) + np.concatenate([np.zeros(0, np.int32), *owner])[order])
        phrase, self.owner = np.divmod(pairs, max(1, len(items)))
        self.owner = self.owner.astype(np.int32)
        self.first = np.searchsorted(phrase, np.arange(len(self.sizes) + 1))
        self.shortest = int(self.sizes.min()) if len(self.sizes) else 0

    @staticmethod
    def _clash(rows: np.ndarray, key: np.ndarray, order: np.ndarray) -> bool:
        same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
        return any((rows[order[same[a : a + 65536] + 1]] != rows[order[same[a : a + 65536]]]).any() for a in range(0, len(same), 1 << 16))

    def items_of(self, phrase: int) -> list:
        return [self.names[i] for i in self.owner[self.first[phrase] : self.first[phrase + 1]] if self.names[i] is not None]


class WaveletMatrix:
    """rank(symbol, i): how often the symbol stands before place i; for many pairs at once."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1
            before = np.r_[0, np.cumsum(ones)]
            zeros = len(symbols) - int(before[-1])
            self.levels.append((bit, before, zeros))
            symbols = np.concatenate([symbols[ones == 0], symbols[ones == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        start, stop = np.zeros_like(at), at
        for bit, before, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            a, b = before[start], before[stop]
            start, stop = np.where(one, zeros + a, start - a), np.where(one, zeros + b, stop - b)
        return stop - start


def suffix_array(ranks: np.ndarray) -> np.ndarray:
    """By prefix doubling; the ranks' last symbol, and every run's end, is unique."""
    step, n = 1, len(ranks)
    while True:
        key = ranks * (n + 1)
        key[: n - step] += ranks[step:] + 1
        order = np.argsort(key, kind="stable")
        ranks = np.empty(n, np.int64)
        ranks[order] = np.cumsum(np.r_[0, np.diff(key[order]) != 0])
        if ranks[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Over runs of word numbers (from 1 on) that are each followed by a 0."""

    def __init__(self, symbols: np.ndarray, top: int):
        ends = symbols == 0
        self.top = top
        dense = np.where(ends, np.cumsum(ends) - 1, symbols + int(ends.sum()))
        _, dense = np.unique(dense, return_inverse=True)
        self.order = suffix_array(dense.astype(np.int64))
        self.last = symbols[self.order - 1]
        self.matrix = WaveletMatrix(self.last, top)
        self.before = np.r_[0, np.cumsum(np.bincount(symbols, minlength=top + 1))]
        run_start = np.maximum.accumulate(np.where(np.r_[True, ends[:-1]], np.arange(len(symbols)), 0))
        sampled = (np.arange(len(symbols)) - run_start) % SAMPLE == 0
        self.sampled = sampled[self.order]
        self.place_of = self.order[self.sampled]
        self.sample_rank = np.cumsum(self.sampled) - 1
        del self.order

    def search(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one-past-last suffix of each right-aligned phrase."""
        lo, hi = np.zeros(len(words), np.int64), np.full(len(words), len(self.last), np.int64)
        for k in range(1, words.shape[1] + 1):
            live = np.flatnonzero((sizes >= k) & (lo < hi))
            if not len(live):
                break
            c = words[live, -k]
            lo[live], hi[live] = (self.before[c] + self.matrix.rank(c, x[live]) for x in (lo, hi))
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps, todo, rows = np.empty(len(rows), np.int64), 0, np.arange(len(rows)), rows.copy()
        while len(todo):
            done = self.sampled[rows]
            out[todo[done]] = self.place_of[self.sample_rank[rows[done]]] + steps
            todo, rows = todo[~done], rows[~done]
            c = self.last[rows]
            rows = self.before[c] + self.matrix.rank(c, rows)
            steps += 1
        return out


def search_shard(texts: list[list[bytes]], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word counted over the whole shard, words, phrase) of every occurrence."""
    none = np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    total = int(sizes.sum())
    if not total or not phrases.shortest:
        return none, none, none
    known = phrases.vocabulary.get
    ids = np.fromiter((known(w, 0) for t in texts for w in t), np.int64, total)
    new = np.zeros(total, bool)
    new[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    inside = ids > 0
    starts = np.flatnonzero(inside & (new | ~np.r_[False, inside[:-1]]))
    breaks = np.flatnonzero(~inside | new)
    after = np.searchsorted(breaks, starts, "right")
    stops = np.r_[breaks, total][after]
    long = stops - starts >= phrases.shortest
    starts, each = starts[long], (stops - starts)[long] + 1
    if not len(starts):
        return none, none, none
    shift = np.cumsum(each) - each
    source = np.arange(int(each.sum())) - np.repeat(shift - starts, each)
    ends = shift + each - 1
    source[ends] = 0
    symbols = ids[source]
    symbols[ends] = 0
    index = FMIndex(symbols, len(phrases.vocabulary))
    lo, hi = index.search(phrases.words, phrases.sizes)
    count = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(count)), count)
    rows = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + lo[which]
    return source[index.locate(rows)], phrases.sizes[which], which


def keep_text(text: str, spans: np.ndarray) -> str:
    """The text without the hit words (given as a mask over its words) and what separates two hit words."""
    data = text.encode()
    plain = np.frombuffer(data.translate(_BYTES), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.r_[False, plain, False].astype(np.int8)))
    first, last = edges[::2], edges[1::2]
    runs = np.flatnonzero(np.diff(np.r_[False, spans, False].astype(np.int8)))
    out, at = [], 0
    for a, b in zip(runs[::2], runs[1::2], strict=True):
        out.append(data[at : first[a]])
        at = last[b - 1]
    return b"".join([*out, data[at:]]).decode()


def shard_hits(raw: list[str], phrases: Phrases) -> tuple[np.ndarray, list[np.ndarray], list[set]]:
    """How many words each text has, a mask over the words that are hit, and the items met."""
    texts = [words_of(t) for t in raw]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at, width, which = search_shard(texts, phrases)
    edge = np.zeros(int(sizes.sum()) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    hit, base = np.cumsum(edge)[:-1] > 0, np.cumsum(sizes) - sizes
    met: list[set] = [set() for _ in texts]
    doc = np.searchsorted(np.cumsum(sizes), at, "right")
    pairs = np.unique(doc * (len(phrases.sizes) + 1) + which)
    for d, p in zip(*divmod(pairs, len(phrases.sizes) + 1), strict=True):
        met[d].update(phrases.items_of(p))
    return sizes, [hit[s : s + n] for s, n in zip(base, sizes, strict=True)], met


def found_in_blocks(rows: DataFrame, items: DataFrame, blocks: int, size: int, scratch: Scratch) -> DataFrame:
    """rid, spans and item ids (as strings) of every row that a block of the items hits, block after block."""
    spark = rows.sparkSession
    dealt = scratch.keep(items.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)).cast("int")), "items")
    out = None
    for k in range(blocks):
        shared = spark.sparkContext.broadcast(Phrases([(r.i, r.t) for r in dealt.where(F.col("block") == k).collect()], size))

        def run(batches, shared=shared):
            for b in batches:
                _, hits, met = shard_hits(b.column(1).to_pylist(), shared.value)
                some = [i for i, h in enumerate(hits) if h.any()]
                runs = [np.flatnonzero(np.diff(np.r_[False, hits[i], False].astype(np.int8))).tolist() for i in some]
                ids = [sorted(map(str, met[i])) for i in some]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(some, pa.int64())), pa.array(runs, pa.list_(pa.int64())), pa.array(ids, pa.list_(pa.string()))], ["rid", "runs", "items"])

        hits = scratch.keep(rows.select("rid", "text").mapInArrow(run, "rid long, runs array<long>, items array<string>"), f"hits-{k}")
        shared.destroy()
        out = hits if out is None else out.unionByName(hits)
    return out.groupBy("rid").agg(F.collect_list("runs").alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def find_leaks(
    docs: DataFrame, items: DataFrame, *, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", also: tuple[str, ...] = (), text_out: bool = False, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the columns
    named in ``also``; with ``text_out`` the clean text too."""
    spark = docs.sparkSession
    tune(spark)
    items = items.select(items[item_id_col].alias("i"), items[item_text_col].alias("t")).where("t is not null").distinct()
    held = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    columns = {"doc_id": id_col, "text": text_col, **{c: c for c in also}}
    if held <= block_bytes:
        shared = spark.sparkContext.broadcast(Phrases([tuple(r) for r in items.collect()], size))
        fed = numbered(docs, columns).drop("rid")
    else:
        scratch = Scratch(spark, "decontamination")
        rows = scratch.keep(numbered(docs, columns), "rows")
        hits = found_in_blocks(rows, items, -(-2 * held // block_bytes), size, scratch)
        fed = rows.join(scratch.keep(hits, "hits"), "rid", "left").select(*columns, "runs", "items")
        shared = None
    kept = [f for f in fed.schema.fields if f.name in ("doc_id", *also)]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)

    def masks(raw: list[str], runs: list, items: list) -> tuple[np.ndarray, list[np.ndarray], list[set]]:
        """As ``shard_hits``, from the hits of the blocks."""
        sizes = np.fromiter((len(words_of(t)) for t in raw), np.int64, len(raw))
        hits = [np.zeros(n, bool) for n in sizes]
        for hit, each in zip(hits, runs, strict=True):
            for run in each or []:
                for a, b in zip(run[::2], run[1::2], strict=True):
                    hit[a:b] = True
        return sizes, hits, [set(x or []) for x in items]

    def run(batches):
        for b in batches:
            raw = b.column(1).to_pylist()
            sizes, hits, met = shard_hits(raw, shared.value) if shared else masks(raw, b.column(len(columns)).to_pylist(), b.column(len(columns) + 1).to_pylist())
            names = [sorted(map(str, s)) for s in met]
            made = [*(b.column(f.name) for f in kept), pa.array(sizes), pa.array([int(h.sum()) for h in hits], pa.int64()), pa.array(list(map(len, names)), pa.int64()), pa.array([hashlib.sha256(",".join(n).encode()).hexdigest() for n in names])]
            labels = [*(f.name for f in kept), "n_words", "n_hit", "n_items", "items_sha256"]
            if text_out:
                made.append(pa.array([keep_text(t, h) if h.any() else t for t, h in zip(raw, hits, strict=True)], pa.string()))
                labels.append("text")
            yield pa.RecordBatch.from_arrays(made, labels)

    found = fed.mapInArrow(run, f"{kinds}, n_words long, n_hit long, n_items long, items_sha256 string" + ", text string" * text_out)
    return found.withColumn("contaminated", F.col("n_hit") > 0)
