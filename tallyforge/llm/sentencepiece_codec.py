"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one Viterbi pass.

The automaton reads a word once and, through its output links, names every piece that ends at
each place. A place keeps the best way to reach it, relaxed over those pieces:

* a unigram model adds piece scores, and the higher sum is better;
* a BPE model ranks merges instead of summing scores. There, a piece is a way on only if the
  merges of the last piece before it and its own would leave the two apart; exactly one piece
  at each place is, and the last place's chain is what merging the whole word gives.

Texts are coded in chunks that no piece can cross, remembered up to a bound: no piece holds a
word mark after another character, and the piece list tells which signs never follow a letter. A character without a piece becomes its bytes' pieces, or else the
unknown piece.

Defined results: null and empty texts have no pieces; an empty table has no rows, repeated rows are coded each by
itself, and of equal ways to code a text the library's is taken (between merges of one rank the left one); decoding gives the text back, but for
U+2581 (the word mark) which becomes a space, and for characters without bytes' pieces.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import pick, tune

MEMO, MEMO_CHARS = 100_000, 1 << 22
MARK = "▁"


def chunk_pattern(names: Iterable[str]) -> str:
    """A pattern for chunks whose borders stand inside no piece: before marks, between Latin
    letters and the signs that follow none of them in any piece, and around line ends."""
    plain = f"{MARK}+[^{MARK}]*|[^{MARK}]+"
    if any("\n" in name for name in names):
        return plain
    letters = "".join(c for c in map(chr, range(0x250)) if c.isalpha())
    after = {name[i + 1] for name in names for i in range(len(name) - 1) if name[i] in letters}
    signs = "".join(re.escape(c) for c in string.punctuation if c not in after)
    return f"{MARK}*[{letters}]+(?=[{MARK}\n{signs}]|$)|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+"


def merge(text: str, ranks: dict[str, int], least: int = 1) -> list[str]:
    """Byte-pair merging from single characters until ``least`` parts are left, first rank and leftmost first."""
    parts = list(text)
    while len(parts) > least:
        found = [(ranks[p], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in ranks]
        if not found:
            break
        _, at = min(found)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


# Model types as the model files number them, and where a file holds its own.
UNIGRAM, BPE = 1, 2
TRAINER_FIELD, TYPE_FIELD = 2, 3
# end of the fixed values


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields: whole numbers, or the bytes of what has a length."""
    at = 0

    def whole() -> int:
        nonlocal at
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value

    while at < len(data):
        number, kind = divmod(whole(), 8)
        if kind == 0:
            yield number, whole()
            continue
        n = {1: 8, 5: 4}.get(kind) or whole()
        at += n
        yield number, data[at - n : at]


def model_kind(data: bytes) -> int:
    """The type that a model file states; files that state none are unigram models."""
    trainer = next((v for n, v in fields(data) if n == TRAINER_FIELD), b"")
    return next((v for n, v in fields(trainer) if n == TYPE_FIELD), UNIGRAM)


@dataclass(frozen=True)
class Pieces:
    """A model file's pieces: what is matched in texts, and what every id decodes to."""

    scores: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    unknown: int
    output: tuple[bytes, ...]
    bpe: bool
    #: For BPE: place in the order of merges, and the two pieces that a piece is merged from.
    ranks: dict[str, int]
    halves: dict[str, tuple[str, str]]

    @classmethod
    def read(cls, model_path: str) -> Pieces:
        import sentencepiece

        with open(model_path, "rb") as f:
            kind = model_kind(f.read())
        if kind not in (UNIGRAM, BPE):
            raise ValueError(f"{model_path} is neither a unigram nor a BPE model")
        bpe, model = kind == BPE, sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = range(model.vocab_size())
        names = [model.id_to_piece(i) for i in ids]
        special = [model.is_control(i) or model.is_unknown(i) for i in ids]
        single = {int(names[i][3:5], 16): i for i in ids if model.is_byte(i)}
        plain = {names[i]: (i, model.get_score(i)) for i in ids if not (special[i] or model.is_byte(i) or model.is_unused(i))}
        for name in plain:
            if MARK in name.lstrip(MARK):
                raise ValueError(f"piece {name!r} holds a word mark inside, so words can't be coded apart")
        value = {i: bytes([b]) for b, i in single.items()}
        output = tuple(b"" if special[i] else value.get(i, names[i].replace(MARK, " ").encode()) for i in ids)
        ranks = {p: r for r, p in enumerate(sorted(plain, key=lambda p: (-plain[p][1], plain[p][0])))} if bpe else {}
        halves = {p: tuple(parts) for p in ranks if len(p) > 1 and len(parts := merge(p, ranks, 2)) == 2 and "".join(parts) == p}
        return cls(plain, tuple(single[b] for b in range(256)) if len(single) == 256 else (), model.unk_id(), output, bpe, ranks, halves)


class Codec:
    def __init__(self, pieces: Pieces):
        import ahocorasick

        self.pieces, self.words, self.apart, self.held = pieces, {}, {}, 0
        self.chunks = re.compile(chunk_pattern(pieces.scores))
        self.automaton = ahocorasick.Automaton()
        for name in pieces.scores:
            if pieces.bpe and len(name) > 1 and name not in pieces.halves:
                continue  # merging never makes it
            self.automaton.add_word(name, name)
        self.automaton.make_automaton()

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether merging keeps the border of two pieces that each come out of merging whole.

        Goes back in time from the finished pieces: the later-made of the two at the border is
        undone until a merge across the border would have come first, or nothing is left to undo.
        """
        halves, ranks = self.pieces.halves, self.pieces.ranks
        limit = len(ranks)
        while ranks.get(left + right, limit) >= limit:
            x, y = (ranks[p] if p in halves else -1 for p in (left, right))
            if x > y:
                limit, left = x, halves[left][1]
            elif y >= 0:
                limit, right = y + 1, halves[right][0]  # among equal merges the left one, across, is first
            else:
                return True
        return False

    def _merged(self, word: str) -> list[str]:
        """The last piece at each place of a word under a BPE model, and so the pieces of the word.

        The automaton names the pieces at a place from the longest to the shortest; the first
        that may follow is the one. A place without a name has its character alone.
        """
        last, settled, apart = [""] * (len(word) + 1), 0, self.apart
        for end, name in self.automaton.iter(word):
            if end < settled:
                continue
            while settled < end:
                settled += 1
                last[settled] = word[settled - 1]
            before = last[end + 1 - len(name)]
            if before:
                known = apart.get(before)
                if known is None:
                    if len(apart) > MEMO // 8:
                        apart.clear()
                    known = apart[before] = {}
                good = known.get(name)
                if good is None:
                    good = known[name] = self._stay_apart(before, name)
                if not good:
                    continue
            settled = end + 1
            last[settled] = name
        while settled < len(word):
            settled += 1
            last[settled] = word[settled - 1]
        return last

    def _best(self, word: str) -> list[str]:
        """The last piece at each place of a word on the way of the highest score sum under a unigram model."""
        scores = self.pieces.scores
        worst = min((s for _, s in scores.values()), default=0.0) - 10.0
        ways: list[list[str]] = [[c] for c in word]
        for end, name in self.automaton.iter(word):
            if len(name) > 1:
                ways[end].append(name)
        last, score = [""] * (len(word) + 1), [0.0] + [-np.inf] * len(word)
        for end, names in enumerate(ways):
            for p in names:
                s = score[end + 1 - len(p)] + scores.get(p, (0, worst))[1]
                if s > score[end + 1]:
                    score[end + 1], last[end + 1] = s, p
        return last

    def split(self, word: str) -> list[str]:
        """The pieces of one word, by the Viterbi pass."""
        last = self._merged(word) if self.pieces.bpe else self._best(word)
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _ids(self, word: str) -> tuple[int, ...]:
        out: list[int] = []
        for p in self.split(word):
            found = self.pieces.scores.get(p)
            if found:
                out.append(found[0])
            elif self.pieces.byte_ids:
                out += [self.pieces.byte_ids[b] for b in p.encode()]
            elif not out or out[-1] != self.pieces.unknown:
                out.append(self.pieces.unknown)
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if len(self.words) > MEMO or self.held > MEMO_CHARS:
            self.words.clear()
            self.held = 0
        known, words = self.words, self.chunks.findall(MARK + text.replace(" ", MARK))
        for w in words:
            if w not in known:
                known[w] = self._ids(w)
                self.held += len(w)
        return list(chain.from_iterable(map(known.__getitem__, words)))

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.pieces.output.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


def _coded(docs: DataFrame, pieces: Pieces, kinds: str, columns: Callable[[Codec, list], list[pa.Array]]) -> DataFrame:
    spark = docs.sparkSession
    tune(spark)
    shared = spark.sparkContext.broadcast(pieces)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [k.split()[0] for k in kinds.split(", ")]

    def run(batches):
        codec = Codec(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *columns(codec, b.column(1).to_pylist())], ["doc_id", *names])

    return docs.mapInArrow(run, f"doc_id {kind}, {kinds}")


def encode_texts(docs: DataFrame, pieces: Pieces, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the piece ids of every text."""
    return _coded(pick(docs, id_col, text_col), pieces, "ids array<int>", lambda codec, texts: [pa.array([codec.encode(t) for t in texts], pa.list_(pa.int32()))])


def decode_ids(coded: DataFrame, pieces: Pieces, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and the text of every id list; a null list is an empty text."""
    fed = coded.select(coded[id_col].alias("doc_id"), coded[ids_col].alias("ids"))
    return _coded(fed, pieces, "text string", lambda codec, lists: [pa.array([codec.decode(x or []) for x in lists], pa.string())])


def code_texts(docs: DataFrame, pieces: Pieces, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, ids_sha256 (of the ids as little-endian 32-bit), round_trip of every text."""

    def columns(codec: Codec, texts: list) -> list[pa.Array]:
        coded = [codec.encode(t) for t in texts]
        return [
            pa.array([len(t.encode()) for t in texts], pa.int64()),
            pa.array(list(map(len, coded)), pa.int64()),
            pa.array([hashlib.sha256(np.array(x, "<i4").tobytes()).hexdigest() for x in coded]),
            pa.array([codec.decode(x) == t for x, t in zip(coded, texts, strict=True)]),
        ]

    return _coded(pick(docs, id_col, text_col), pieces, "n_bytes long, n_tokens long, ids_sha256 string, round_trip boolean", columns)
