"""Token counts by rank-synchronous merging of batched pre-tokens.

The distinct pre-tokens of a batch lie end to end in one ragged numpy array of symbol ids.
In each round every sequence finds its lowest-ranked adjacent pair and merges it; all
sequences do so at once, and those without a pair left are retired with their symbol count.

Defined results: a null or empty text has 0 tokens; repeated rows are counted each by itself; an empty
table has no rows; ids may be null or repeated; nothing is ranked, so there are no ties;
a text of any length is read whole (memory follows one Arrow batch and its distinct pre-tokens).
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import pick, tune

#: Distinct chunks, and characters of chunks, that a worker remembers before it starts anew.
MEMO, MEMO_CHARS = 300_000, 1 << 23
#: Symbols that one round of merging works on.
ROUND_SYMBOLS = 2_000_000


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the other bytes for code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class MergeTable:
    """The pair ranks of a byte-level BPE vocabulary with word ends, as sorted arrays."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        names = byte_symbols()
        self.inner = np.array([vocab[c] for c in names], np.int64)
        self.last = np.array([vocab[c + end] for c in names], np.int64)
        self.size = max(vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.slots = self._slots(left * self.size + right)
        self.none = len(pairs)
        # A merge whose product starts or ends a pair of lower rank can be overtaken by that
        # pair, so such a merge takes the leftmost place only; all others take every place.
        n = len(pairs)
        lowest = np.full(self.size, n, np.int64)
        np.minimum.at(lowest, left, np.arange(n))
        np.minimum.at(lowest, right, np.arange(n))
        self.careful = lowest[self.made] < np.arange(n)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]

    @staticmethod
    def _slots(keys: np.ndarray) -> list[tuple]:
        """Hash tables of (multiplier, shift, keys, ranks); what collides in one goes to the next."""
        tables, rank, random = [], np.arange(len(keys)), np.random.default_rng(1)
        while len(rank):
            bits = max(4, int(len(rank)).bit_length() + 3)
            factor, shift = np.uint64(int(random.integers(1 << 62, 1 << 63)) | 1), np.uint64(64 - bits)
            _, first = np.unique((keys[rank].astype(np.uint64) * factor) >> shift, return_index=True)
            held, ranks = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
            at = ((keys[rank[first]].astype(np.uint64) * factor) >> shift).astype(np.int64)
            held[at], ranks[at] = keys[rank[first]], rank[first]
            tables.append((factor, shift, held, ranks))
            rank = np.delete(rank, first)
        return tables

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        hashed, out = key.view(np.uint64), np.full(len(key), self.none, np.int64)
        for factor, shift, held, ranks in self.slots:
            at = ((hashed * factor) >> shift).view(np.int64)
            hit = held[at] == key
            out[hit] = ranks[at[hit]]
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        """How many symbols each non-empty pre-token ends as."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out, start = np.empty(len(words), np.int64), 0
        while start < len(words):
            total = np.cumsum(sizes[start:])
            stop = start + max(1, int(np.searchsorted(total, ROUND_SYMBOLS, "right")))
            out[start:stop] = self._merge(words[start:stop], sizes[start:stop])
            start = stop
        return out

    def _merge(self, words: list[bytes], sizes: np.ndarray) -> np.ndarray:
        none = self.none
        data = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[data[ends]]
        owner = np.repeat(np.arange(len(words)), sizes)
        left = sizes.copy()
        while len(symbols) > 1:
            rank = self.ranks(symbols[:-1], symbols[1:])
            rank[owner[:-1] != owner[1:]] = none
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(np.r_[rank, none], first)
            live = best < none
            if not live.any():
                break
            each = np.diff(np.r_[first, len(owner)])
            if not live.all():  # retire what is finished
                keep = np.repeat(live, each)
                symbols, owner, rank = symbols[keep], owner[keep], np.r_[rank, none][keep][:-1]
                best, each = best[live], each[live]
                first = np.cumsum(each) - each
            hit = rank == np.repeat(best, each)[:-1]
            if hit.size > 1 and (hit[1:] & hit[:-1]).any():  # a run of one symbol: every other place of it
                at = np.flatnonzero(hit)
                run = np.cumsum(np.r_[True, np.diff(at) != 1]) - 1
                head = at[np.flatnonzero(np.r_[True, np.diff(run) != 0])]
                hit[at[(at - head[run]) % 2 == 1]] = False
            careful = self.careful[best]
            if careful.any():
                at = np.flatnonzero(hit)
                seq = np.searchsorted(first, at, "right") - 1
                leading = np.r_[True, seq[1:] != seq[:-1]]
                hit[at[careful[seq] & ~leading]] = False
            at = np.flatnonzero(hit)
            symbols[at] = self.made[rank[at]]
            np.subtract.at(left, owner[at], 1)
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return left


class Counter:
    """Counts the tokens of texts with a memo of the white-space-free chunks met so far.

    No pre-token holds white space, so the chunks of a text are counted each by itself.
    """

    def __init__(self, table: MergeTable):
        self.table, self.memo, self.held = table, {}, 0
        self.find = regex.compile(table.pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, table.special))) if table.special else None
        self.odd = regex.compile("[\x1c-\x1f]")  # white space to str.split() only

    def chunks(self, text: str) -> tuple[list[str], int]:
        n = 0
        if self.special and "<|" in text:
            text, n = self.special.subn("\n", text)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        return (regex.split(r"\s+", text) if self.odd.search(text) else text.split()), n

    def learn(self, chunks: list[str]) -> None:
        found = [[c] if c.isalpha() else self.find(c) for c in chunks]  # only letters: one pre-token
        words = list({w for each in found for w in each})
        count = dict(zip(words, self.table.counts([w.encode() for w in words]).tolist(), strict=True))
        self.held += sum(map(len, chunks))
        self.memo.update((c, sum(map(count.__getitem__, each))) for c, each in zip(chunks, found, strict=True))

    def __call__(self, texts: list[str]) -> list[int]:
        if len(self.memo) > MEMO or self.held > MEMO_CHARS:
            self.memo.clear()
            self.held = 0
        memo, split = self.memo, list(map(self.chunks, texts))
        self.learn(list({c for chunks, _ in split for c in chunks if c not in memo}))
        return [n + sum(map(memo.__getitem__, chunks)) for chunks, n in split]


def count_tokens(docs: DataFrame, vocab_path: str, *, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text under the vocabulary file at ``vocab_path``.

    The driver reads the file (a few MB, fixed by the vocabulary) and broadcasts its arrays.
    """
    spark = docs.sparkSession
    tune(spark)
    with open(vocab_path, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(MergeTable(json.load(f)))

    def run(batches):
        count = Counter(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(count(b.column(2).to_pylist()), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    base = pick(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()
    fed = base.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    return fed.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
