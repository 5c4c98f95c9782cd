"""Words coded by a vocabulary of pieces, greedily, the longest piece first."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.session import Scratch, ship

#: Characters of pieces, and eight more a piece, that a pass over the words holds; a larger vocabulary is met in several passes.
BLOCK = 1 << 22


def word_codes(words: DataFrame, vocabulary: DataFrame, *, word: str = "word", unknown: int = 0, longest: int | None = 100) -> DataFrame:
    """word, ids, pieces of every distinct word: its pieces from left to right, and their ids.

    vocabulary: piece, inside, id; a piece may begin a word, or stand ``inside`` it. A word with a place at which no piece goes on, and
    one longer than ``longest`` (None sets no bound), is ``unknown`` as a whole, without pieces (null); an empty word has none, a null word
    no row. Of pieces that stand twice the least id counts.

    A word is followed from its beginning to its end in one task, so words are shuffled once, to find the distinct ones, however
    many pieces they have. Pieces come to the driver and the tasks in blocks of a bounded size. Where there are several blocks, a pass
    a block keeps the longest piece at each of a word's places, and the last pass follows the words.
    """
    spark = words.sparkSession
    ship(spark)
    scratch = Scratch(spark, "words")
    pieces = scratch.keep(vocabulary.where("piece <> '' AND inside IS NOT NULL").groupBy("piece", "inside").agg(F.min("id").cast("int").alias("id")), "pieces")
    blocks = max(1, -(-(pieces.agg(F.sum(F.length("piece") + 8)).first()[0] or 0) // BLOCK))
    none = F.array().cast("array<int>")
    rows = words.select(F.col(word).alias("word")).where(F.col("word").isNotNull()).distinct().select("word", none.alias("sizes"), none.alias("met"))
    block = lambda k: pieces.where(F.pmod(F.xxhash64("piece", "inside"), F.lit(blocks)) == k).select("piece", "inside", "id").toArrow()
    for k in range(blocks - 1):
        rows = scratch.keep(rows.mapInArrow(_met(block(k), longest), "word string, sizes array<int>, met array<int>"), f"met-{k}")
    return rows.mapInArrow(_spelled(block(blocks - 1), unknown, longest), "word string, ids array<int>, pieces array<string>")


def _longest(block: pa.Table) -> Callable[[str, int], tuple[int, int | None]]:
    """The size and id of the block's longest piece that goes on at a place of a word; the size is 0 if none does."""
    ids: tuple[dict[str, int], dict[str, int]] = {}, {}
    for piece, inside, at in zip(*(c.to_pylist() for c in block.columns), strict=True):
        ids[inside][piece] = at
    sizes = [sorted({len(p) for p in own}, reverse=True) for own in ids]

    def find(w: str, at: int) -> tuple[int, int | None]:
        own = ids[at > 0]
        for n in sizes[at > 0]:
            piece = w[at : at + n]  # shorter than n at the end of a word, and then all that is left of it
            if piece in own:
                return len(piece), own[piece]
        return 0, None

    return find


def _met(block: pa.Table, longest: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One pass: the longest piece at each place, of this block and those before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _longest(block)
        for b in batches:
            sizes, met = [], []
            for w, size, own in zip(*(c.to_pylist() for c in b.columns), strict=True):
                places = range(len(w) if longest is None or len(w) <= longest else 0)
                best = [max(find(w, at), (size[at], own[at]) if size else (0, None), key=lambda e: e[0]) for at in places]
                sizes.append([n for n, _ in best])
                met.append([i for _, i in best])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.list_(pa.int32())), pa.array(met, pa.list_(pa.int32()))], ["word", "sizes", "met"])

    return run


def _spelled(block: pa.Table, unknown: int, longest: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The last pass: words followed from piece to piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _longest(block)
        for b in batches:
            ids, pieces = [], []
            for w, size, met in zip(*(c.to_pylist() for c in b.columns), strict=True):
                at, own, cut = 0, [], []
                while at < len(w) and (longest is None or len(w) <= longest):
                    n, i = find(w, at)
                    if size and size[at] > n:
                        n, i = size[at], met[at]
                    if not n:
                        break
                    own.append(i)
                    cut.append(w[at : at + n])
                    at += n
                ids.append(own if at == len(w) else [unknown])
                pieces.append(cut if at == len(w) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(pieces, pa.list_(pa.string()))], ["word", "ids", "pieces"])

    return run
