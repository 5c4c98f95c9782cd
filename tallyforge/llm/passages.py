"""What the two substring operators share: word and window hashes, content-selected places, cutting.

A window is ``length`` consecutive words. Its place is the leftmost smallest hash among the
``k``-word grams inside it, so equal windows choose the same place, and the windows of a text
that choose one place are consecutive: a *region* of ``count`` windows from word ``start``.
Regions with equal hashes cover equal words. All hashes have 64 bits and are compared only
among rows whose 64-bit gram hashes agree, so a false match takes a double collision.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Window starts that are worked on at once; the arrays of a block hold a few words more.
BLOCK = 1 << 18
MEMO = 100_000
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MEMO:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def later(x: np.ndarray, by: int) -> np.ndarray:
    """x[i + by] at i; zeros beyond the end, which no valid window reaches."""
    out = np.zeros_like(x)
    if by < len(x):
        out[: len(x) - by] = x[by:]
    return out


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` words from each place, out of hashes of powers of two."""
    level, width, have, acc = mixed(words), 1, 0, None
    while True:
        if size & width:
            acc = level if acc is None else mixed(acc * _A + later(level, have))
            have += width
        width *= 2
        if width > size:
            return acc
        level = mixed(level * _A + later(level, width // 2))


def lowest(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The place and value of the leftmost smallest of the ``width`` values from each place on."""
    at, size = np.arange(len(values), dtype=np.int64), 1
    while size < width:
        step = min(size, width - size)
        other, place = later(values, step), later(at, step)
        take = (other < values) & (place > 0)
        values, at, size = np.where(take, other, values), np.where(take, place, at), size + step
    return at, values


def regions(words: np.ndarray, ends: np.ndarray, length: int, k: int):
    """(start, count, place of the gram, gram hash, region hash) of every region, block by block.

    words: hashes of the words of some texts, end to end; ends: for each word, its text's end.
    """
    for lo in range(0, len(words), BLOCK):
        part = words[lo : lo + BLOCK + length]
        starts = np.flatnonzero(np.arange(lo, min(lo + BLOCK, len(words))) + length <= ends[lo : lo + BLOCK])
        if not len(starts):
            continue
        whole = grams(part, length)
        place, value = lowest(grams(part, k), length - k + 1)
        place, value = place[starts], value[starts]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        count = np.diff(np.r_[first, len(starts)])
        start, stop = starts[first], starts[first + count - 1]
        region = mixed(mixed(whole[start] * _A + whole[stop]) + count.astype(np.uint64) * _B + (place[first] - start).astype(np.uint64))
        yield start + lo, count, place[first] + lo, value[first].view(np.int64), region.view(np.int64)


def flat(texts: list[str], memo: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and how many words each text has."""
    hashed = [memo.of(t.encode().split()) for t in texts]
    return (np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)), np.fromiter(map(len, hashed), np.int64, len(hashed))


def numbered(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The wanted columns under their own names, a null text as an empty one, and a row number ``rid``."""
    kept = [F.coalesce(docs[c], F.lit("")).alias(n) if n == "text" else docs[c].alias(n) for n, c in columns.items()]
    return docs.select(F.monotonically_increasing_id().alias("rid"), *kept)


def find_regions(rows: DataFrame, length: int, k: int) -> DataFrame:
    """rid, start, count, place, gram, region of every region of (rid, text) rows; one pass, no shuffle."""

    def run(batches):
        memo = WordHashes()
        for b in batches:
            rid = b.column(0).to_numpy(zero_copy_only=False)
            words, sizes = flat(b.column(1).to_pylist(), memo)
            ends = np.cumsum(sizes)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            for start, count, place, gram, region in regions(words, ends[owner], length, k):
                doc = owner[start]
                at, place = (pa.array((x - (ends - sizes)[doc]).astype(np.int32)) for x in (start, place))
                yield pa.RecordBatch.from_arrays([pa.array(rid[doc]), at, pa.array(count.astype(np.int32)), place, pa.array(gram), pa.array(region)], ["rid", "start", "count", "place", "gram", "region"])

    return rows.select("rid", "text").mapInArrow(run, "rid long, start int, count int, place int, gram long, region long")


def spread_windows(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The single windows of the wanted regions: rid, start, gram, window (hash), weight.

    wanted: rid, start, count, gram, weight. A text's own list is as long as the text at most.
    """
    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("start", "count", "gram", "weight")).alias("parts"))

    def run(batches):
        memo = WordHashes()
        for b in batches:
            lists = b.column(2)
            each = np.diff(lists.offsets.to_numpy())
            start, count, gram, weight = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in lists.flatten().flatten())
            words, sizes = flat(b.column(1).to_pylist(), memo)
            base = np.cumsum(sizes) - sizes
            doc = np.repeat(np.arange(len(each)), each)
            at = np.repeat(base[doc] + start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            by = np.repeat(np.arange(len(count)), count)
            hashes = np.empty(len(at), np.uint64)
            for lo in range(0, len(words), BLOCK):
                mine = (at >= lo) & (at < lo + BLOCK)
                if mine.any():
                    hashes[mine] = grams(words[lo : lo + BLOCK + length], length)[at[mine] - lo]
            rid = b.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(at), BLOCK):
                cut = by[lo : lo + BLOCK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[doc[cut]]), pa.array((at[lo : lo + BLOCK] - base[doc[cut]]).astype(np.int32)), pa.array(gram[cut]), pa.array(hashes[lo : lo + BLOCK].view(np.int64)), pa.array(weight[cut].astype(np.int32))],
                    ["rid", "start", "gram", "window", "weight"],
                )

    return rows.select("rid", "text").join(lists, "rid").select("rid", "text", "parts").mapInArrow(run, "rid long, start int, gram long, window long, weight int")


def merged(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal spans of the union of [start, stop)."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.flatnonzero(np.r_[True, starts[1:] > stops[:-1]])
    return list(zip(starts[new].tolist(), stops[np.r_[new[1:], len(starts)] - 1].tolist(), strict=True))


def cut_words(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    out, at = [], 0
    for a, b in spans:
        out += words[at:a]
        at = b
    return out + words[at:]


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and without the white space behind each span."""
    data, out, at = text.encode(), [], 0
    places = [m.span() for m in WORD.finditer(data)]
    for a, b in spans:
        out.append(data[at : places[a][0]])
        at = places[b][0] if b < len(places) else len(data)
    return b"".join([*out, data[at:]]).decode()


def with_spans(rows: DataFrame, covered: DataFrame, columns: list[str], *, text_out: bool) -> DataFrame:
    """Every row of ``rows`` with the merged spans of ``covered`` (rid, start, stop) taken out.

    Digest: the columns, n_words, n_removed, spans, kept_sha256. With ``text_out``: the columns
    with the cut text, and n_removed.
    """
    lists = covered.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    fed = rows.join(lists, "rid", "left").select(*columns, "text", "spans")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fed.schema.fields if f.name in columns)
    extra = "text string, n_removed long" if text_out else "n_words long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>, kept_sha256 string"

    def run(batches):
        for b in batches:
            texts, lists = b.column(len(columns)).to_pylist(), b.column(len(columns) + 1)
            bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            start, stop = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            each = [merged(start[i:j], stop[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
            removed = pa.array([sum(y - x for x, y in spans) for spans in each], pa.int64())
            kept = [b.column(i) for i in range(len(columns))]
            if text_out:
                made = [pa.array([cut_text(t, s) if s else t for t, s in zip(texts, each, strict=True)], pa.string()), removed]
                names = ["text", "n_removed"]
            else:
                words = [t.encode().split() for t in texts]
                digest = [hashlib.sha256(b" ".join(cut_words(w, s))).hexdigest() for w, s in zip(words, each, strict=True)]
                spans = pa.array([[{"start": x, "stop": y} for x, y in s] for s in each], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
                made = [pa.array(list(map(len, words)), pa.int64()), removed, pa.array(list(map(len, each)), pa.int64()), spans, pa.array(digest)]
                names = ["n_words", "n_removed", "n_spans", "spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(kept + made, [*columns, *names])

    return fed.mapInArrow(run, f"{kinds}, {extra}")
