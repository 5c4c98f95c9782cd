"""Document fingerprints by consistent weighted sampling, and what they say of edited texts.

A text's terms are its words, each with the (up to) four words before it, weighted by how often they
stand in the text. For every sample a term draws r and c from Gamma(2, 1) and b from [0, 1), the same
wherever the term is met: its hash picks them from tables of draws. With weight w its level is
t = floor(ln w / r + b), its rank ln c - r (t - b) - r, and the sample is the term and level of least rank.
Two texts agree in a sample with the probability of their generalised Jaccard similarity: the sum of the
smaller weights over the sum of the larger ones.

Texts are fingerprinted where they lie, in one pass, without a shuffle (``fingerprint_texts``). The query's edited
texts need each document's follower in the order of ids. Bounds of blocks of ids, which are ids themselves, come from
a sketch over the ids alone; every text is shuffled once, to its block, and a block's first document goes to the
block before as well, so each block is sorted and read as a stream and no task needs another's rows.

Defined results: a null text is an empty one; all texts without words have one fingerprint of their own;
documents whose ids are equal or null (these come last) follow each other by a hash of their texts; repeated rows are
documents each, and share a block, which streams and may spill, so rows of one id are never all in memory; a single
document follows itself; an empty table has no rows; columns not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import let, pick, tune
from tallyforge.llm.passages import WordHashes, mixed

SAMPLES = 128
#: Draws in the tables, a power of two; terms and characters that are worked on at once.
DRAWS, TERMS_AT_ONCE, CHARS_AT_ONCE = 1 << 16, 4096, 1 << 18
#: Each sample takes four hex digits.
DIGITS = 4
NO_WORDS = np.uint64(0x6E6F20776F726473)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _uniform(n: int, stream: int) -> np.ndarray:
    """Numbers between 0 and 1, the same on every machine and in every release of numpy."""
    x = mixed(mixed((np.arange(n, dtype=np.uint64) + np.uint64(stream * n + 1)) * _STEP))
    return ((x >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)


def _sortable(x: np.ndarray) -> np.ndarray:
    """Floats as whole numbers of the same order, in the upper half of 64 bits."""
    bits = x.astype(np.float32).view(np.uint32)
    flipped = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))
    return flipped.astype(np.uint64) << np.uint64(32)


class Sampler:
    """Samples of weighted terms; its tables are made once a worker."""

    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        self.r = -np.log(_uniform(DRAWS, 0) * _uniform(DRAWS, 1))
        self.ln_c = np.log(-np.log(_uniform(DRAWS, 2) * _uniform(DRAWS, 3)))
        self.b = _uniform(DRAWS, 4)
        self.once = _sortable(self.ln_c + self.r * self.b - self.r)  # the ranks of weight 1, whose level is 0
        self.factors = mixed(np.arange(1, samples + 1, dtype=np.uint64) * _STEP) | np.uint64(1)

    def ranks(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """By term and sample the rank, and under it 32 bits that stand for the term and its level."""
        draw = (terms[:, None] * self.factors) >> np.uint64(64 - 16)
        out = self.once[draw]
        out |= (mixed(terms) >> np.uint64(32))[:, None]
        more = np.flatnonzero(weights != 1)
        if len(more):
            draw = draw[more]
            r, b = self.r[draw], self.b[draw]
            level = np.floor(np.log(weights[more])[:, None] / r + b)
            mark = mixed(terms[more][:, None] + level.astype(np.int64).view(np.uint64) * _STEP) >> np.uint64(32)
            out[more] = _sortable(self.ln_c[draw] - r * (level - b) - r) | mark
        return out

    def sign(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The samples of each (terms, weights): a row of 16-bit numbers a set, none of which is empty."""
        best = np.full((len(sets), self.samples), np.iinfo(np.uint64).max, np.uint64)
        owner = np.repeat(np.arange(len(sets)), [len(t) for t, _ in sets])
        terms, weights = (np.concatenate(x) for x in zip(*sets, strict=True))
        for a in range(0, len(terms), TERMS_AT_ONCE):
            part = slice(a, a + TERMS_AT_ONCE)
            own, pair = owner[part], mixed(terms[part] + weights[part].view(np.uint64) * _STEP)
            _, first, back = np.unique(pair, return_index=True, return_inverse=True)
            rows = self.ranks(terms[part][first], weights[part][first])[back]
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            best[own[starts]] = np.minimum(best[own[starts]], np.minimum.reduceat(rows, starts, axis=0))
        return best.astype(np.uint16)


def weighted_terms(text: str, size: int, memo: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct terms of a text and how often each stands in it."""
    words = memo.of(text.encode().split())
    if not len(words):
        return np.array([NO_WORDS]), np.ones(1)
    terms = mixed(words)
    for k in range(1, size):
        before = np.zeros_like(words)
        before[k:] = words[:-k] if k < len(words) else 0
        terms = mixed(terms * _STEP + before)
    terms, counts = np.unique(terms, return_counts=True)
    return terms, counts.astype(float)


def hexed(samples: np.ndarray) -> list[str]:
    return [x.tobytes().hex() for x in samples.astype(">u2")]


def likeness(a: Column, b: Column) -> Column:
    """The share of samples in which two fingerprints agree."""
    n = F.length(a) / DIGITS
    at = F.sequence(F.lit(0), n.cast("int") - 1)
    return F.size(F.filter(at, lambda i: F.substr(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substr(b, i * DIGITS + 1, F.lit(DIGITS)))) / n


def fingerprint_texts(docs: DataFrame, *, samples: int = SAMPLES, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint of every document."""
    tune(docs.sparkSession)
    rows = pick(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, sampler = WordHashes(), Sampler(samples)
        for b in batches:
            if b.num_rows:
                texts = b.column(1).to_pylist()
                signed = hexed(sampler.sign([weighted_terms(t, size, memo) for t in texts]))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(signed)], ["doc_id", "n_chars", "fingerprint"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, fingerprint string")


def id_bounds(rows: DataFrame, parts: int) -> list[int]:
    """Ids, descending, that cut the rows into about so many even blocks; the first is the largest id."""
    shares = [k / parts for k in range(parts + 1)]
    most, cuts = rows.agg(F.max("doc_id"), F.percentile_approx("doc_id", shares[1:-1] or [0.5], max(10_000, 10 * parts))).first()
    return sorted({most, *cuts}, reverse=True) if most is not None else []


def block_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the descending bounds are no less than the id, less one: counted in steps, then within one step."""
    step = max(1, int(len(bounds) ** 0.5))
    fine = F.lit(bounds)
    return let(
        F.size(F.filter(F.lit(bounds[::step]), lambda b: b >= doc_id)) - 1,
        lambda k: k * step + F.size(F.filter(F.slice(fine, k * step + 1, F.lit(step)), lambda b: b >= doc_id)) - 1,
    )


def in_blocks(rows: DataFrame) -> DataFrame:
    """block, ghost, doc_id, text: sorted blocks of descending ids, each ending with the next block's first document as a ghost."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = id_bounds(rows, parts)
    least = rows.where("doc_id is null").agg(F.min(F.xxhash64("text"))).first()[0]
    blocks = len(bounds) + (least is not None)
    if not blocks:
        return rows.select(F.lit(0).alias("block"), F.lit(False).alias("ghost"), "doc_id", "text")
    number, leads = F.lit(len(bounds)), F.xxhash64("text") == (0 if least is None else least)
    if bounds:
        known = F.col("doc_id").isNotNull()
        number = F.when(known, block_of(F.col("doc_id"), bounds)).otherwise(number)
        leads = F.when(known, F.get(F.lit(bounds), F.col("block")) == F.col("doc_id")).otherwise(leads)
    own = F.struct(F.col("block"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.pmod(F.col("block") - 1, F.lit(blocks)).alias("block"), F.lit(True).alias("ghost"))
    sent = rows.withColumn("block", number).select("doc_id", "text", F.inline(F.when(leads, F.array(own, ghost)).otherwise(F.array(own))))
    dealt = sent.repartitionById(max(parts, blocks), "block")
    return dealt.sortWithinPartitions("block", "ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text").select("block", "ghost", "doc_id", "text")


def edited(text: str, follower: str, share: int = 3) -> str:
    """The text with its last third, rounded down, replaced by the follower's first characters."""
    cut = len(text) // share
    return text[: len(text) - cut] + follower[:cut]


def fingerprint_edits(docs: DataFrame, *, samples: int = SAMPLES, size: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every document."""
    tune(docs.sparkSession)
    rows = pick(docs, id_col, text_col)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, sampler = WordHashes(), Sampler(samples)

        def told(pairs: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            changed = [edited(text, follower) for _, text, follower in pairs]
            place: dict[str, int] = {}
            own, new, after = (
                np.array([place.setdefault(t, len(place)) for t in texts]) for texts in ([p[1] for p in pairs], changed, [p[2] for p in pairs])
            )
            signed = sampler.sign([weighted_terms(t, size, memo) for t in place])
            shown = hexed(signed)
            arrays = [
                pa.array([p[0] for p in pairs], kind),
                pa.array([len(p[1]) for p in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                pa.array([shown[k] for k in own]),
                pa.array([shown[k] for k in new]),
                pa.array((signed[own] == signed[new]).mean(axis=1)),
                pa.array((signed[own] == signed[after]).mean(axis=1)),
            ]
            return pa.RecordBatch.from_arrays(arrays, names)

        last, pairs, chars, kind = None, [], 0, None
        for b in batches:
            kind = b.schema.field(2).type
            for block, ghost, doc_id, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if last is not None and last[0] == block:
                    pairs.append((last[1], last[2], text))
                    chars += len(last[2])
                    if chars > CHARS_AT_ONCE:
                        yield told(pairs, kind)
                        pairs, chars = [], 0
                last = None if ghost else (block, doc_id, text)
        if pairs:
            yield told(pairs, kind)

    out = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_blocks(rows).mapInArrow(run, out)
