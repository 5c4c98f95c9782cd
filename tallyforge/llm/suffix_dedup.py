"""Suffix-array dedup over a sparse suffix array.

Only the suffixes at minimiser positions are retained: the leftmost smallest ``k``-word gram of
each window of ``length`` words, so that every window keeps at least one suffix and equal
windows keep it at the same offset. Of these, suffixes whose first ``k`` words stand nowhere
else are put aside. The others are sorted over the whole cluster by their words, from the
minimiser on to the end of the windows around it, then by the words before it, nearest first;
the sort is range-partitioned by words and row, so that even a suffix that stands in a third of
all documents is dealt over many tasks.

Neighbours are then compared word by word. A suffix whose neighbour agrees with it in all words
on both sides repeats with everything around it. For the others the longest common prefix with
a neighbour is the longest with any suffix: it bounds how far a match extends to the right, so
which windows can be repeats at all. The match is extended to the left by these windows, which
are sorted (by 64-bit hashes, under their gram) and compared with their neighbours in turn. No
step looks beyond a row's neighbours, and only the two outermost rows of each partition go to
the driver, to meet those of the next partition.

Words are compared as 32-bit numbers, whole surroundings also by a 64-bit hash of their words.

Defined results: a null text has no words; a text of fewer than ``length`` words has no repeat;
a repeated row repeats all its windows; ties in the sort are broken by row and place; an empty
table has no rows; columns not named in ``also`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, meet, tune
from tallyforge.llm.passages import WordHashes, find_regions, flat, numbered, spread_windows, with_spans


def compare_neighbours(rows: DataFrame, head: str, tail: str, scratch: Scratch, name: str) -> DataFrame:
    """``rows`` sorted by (head, tail, rid, start), each with two facts about its neighbours:

    twin: a neighbour has the same head and tail; kin: a neighbour has the same head only;
    ``rows`` must have the columns rid and start, and be readable again.
    """
    columns = rows.columns
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, head, tail, "rid", "start").sortWithinPartitions(head, tail, "rid", "start")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    h, t = columns.index(head), columns.index(tail)

    def facts(batch: pa.RecordBatch, before, after) -> tuple[np.ndarray, np.ndarray]:
        """before, after: (head, tail) of the rows around the batch, or None."""
        head, tail = (batch.column(i).to_numpy(zero_copy_only=False) for i in (h, t))
        same = head[1:] == head[:-1]
        both = same & (tail[1:] == tail[:-1])
        ends = [(bool(x and x[0] == head[i]), bool(x and x == (head[i], tail[i]))) for x, i in ((before, 0), (after, -1))]
        twin = np.r_[ends[0][1], both] | np.r_[both, ends[1][1]]
        kin = np.r_[ends[0][0] and not ends[0][1], same & ~both] | np.r_[same & ~both, ends[1][0] and not ends[1][1]]
        return twin, kin

    def run(batches):
        part, held, before = TaskContext.get().partitionId(), None, None

        def done(batch, after, edge):
            twin, kin = facts(batch, before, after)
            n = batch.num_rows
            edges = np.zeros(n, np.int32)
            edges[0] |= 1 if before is None else 0
            edges[-1] |= 2 if edge else 0
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(twin), pa.array(kin), pa.array(edges), pa.array(np.full(n, part, np.int32))], [*columns, "twin", "kin", "edge", "part"])

        for b in batches:
            if not b.num_rows:
                continue
            key = lambda i, b=b: (b.column(h)[i].as_py(), b.column(t)[i].as_py())
            if held is not None:
                yield done(held, key(0), False)
                before = (held.column(h)[held.num_rows - 1].as_py(), held.column(t)[held.num_rows - 1].as_py())
            held = b
        if held is not None:
            yield done(held, None, True)

    kept = scratch.keep(ordered.mapInArrow(run, f"{kinds}, twin boolean, kin boolean, edge int, part int"), name)
    outer = sorted(kept.where("edge > 0").collect(), key=lambda r: (r.part, r.edge == 2))  # two rows a partition at most
    outer = [r.asDict() for r in outer]
    for a, b in zip(outer[:-1], outer[1:], strict=True):
        if a["part"] != b["part"] and a[head] == b[head]:
            fact = "twin" if a[tail] == b[tail] else "kin"
            a[fact] = b[fact] = True
    met = rows.sparkSession.createDataFrame(outer, kept.schema)
    return kept.where("edge = 0").unionByName(met).drop("edge", "part")


def with_words(rows: DataFrame, retained: DataFrame, length: int) -> DataFrame:
    """The retained suffixes with their words: ``right`` from the place on, ``left`` before it, nearest first."""
    lists = retained.groupBy("rid").agg(F.collect_list(F.struct("start", "count", "place", "gram", "region")).alias("parts"))

    def run(batches):
        memo = WordHashes()
        for b in batches:
            lists = b.column(2)
            each = np.diff(lists.offsets.to_numpy())
            start, count, place, gram, region = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
            words, sizes = flat(b.column(1).to_pylist(), memo)
            forward = (words >> np.uint64(32)).astype(">u4")
            backward = forward[::-1].tobytes()
            forward, n = forward.tobytes(), len(words)
            doc = np.repeat(np.arange(len(each)), each)
            base = (np.cumsum(sizes) - sizes)[doc]
            first, at, stop = base + start, base + place, base + start + count - 1 + length
            right = [forward[4 * x : 4 * y] for x, y in zip(at.tolist(), stop.tolist(), strict=True)]
            left = [backward[4 * (n - x) : 4 * (n - y)] for x, y in zip(at.tolist(), first.tolist(), strict=True)]
            rid = b.column(0).to_numpy(zero_copy_only=False)[doc]
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in (rid, start, place, gram, region)), pa.array(right, pa.binary()), pa.array(left, pa.binary())], SUFFIX)

    return rows.select("rid", "text").join(lists, "rid").mapInArrow(run, "rid long, start int, place int, gram long, region long, right binary, left binary")


SUFFIX = ["rid", "start", "place", "gram", "region", "right", "left"]


def common(texts: list[bytes]) -> np.ndarray:
    """For each but the first, how many four-byte words it has in common with the one before it, from the beginning."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) // 4
    if not sizes.max(initial=0):
        return np.zeros(len(texts) - 1, np.int64)
    padded = np.frombuffer(b"".join(t.ljust(4 * int(sizes.max()), b"\0") for t in texts), ">u4").reshape(len(texts), -1)
    alike = np.logical_and.accumulate(padded[1:] == padded[:-1], axis=1).sum(axis=1)
    return np.minimum(alike, np.minimum(sizes[1:], sizes[:-1]))


def suffix_array(suffixes: DataFrame, scratch: Scratch) -> DataFrame:
    """The suffixes sorted by their words, each with the facts that its two neighbours tell.

    twin: a neighbour agrees in all words on both sides; reach: the most words from the place on
    that a neighbour which is no twin has in common with it.
    """
    parts = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["right", "left", "rid", "start"]
    ordered = suffixes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    names = ["rid", "start", "place", "gram", "twin", "reach", "stop", "edge", "part", "region", "right", "left"]

    def between(region: np.ndarray, right: list[bytes], left: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each but the first is a twin of the one before it, and else its common words."""
        alike = np.array([x == y for x, y in zip(right[1:], right[:-1], strict=True)], bool) & np.array([x == y for x, y in zip(left[1:], left[:-1], strict=True)], bool)
        twin = alike & (region[1:] == region[:-1])
        return twin, np.where(twin, 0, common(right))

    def run(batches):
        part, held, before = TaskContext.get().partitionId(), None, None

        def done(b: pa.RecordBatch, after) -> pa.RecordBatch:
            region, right, left = b.column(4).to_numpy(), b.column(5).to_pylist(), b.column(6).to_pylist()
            around = [x for x in (before, after) if x]
            region = np.r_[[x[0] for x in around if x is before], region, [x[0] for x in around if x is after]].astype(np.int64)
            right = [x[1] for x in around if x is before] + right + [x[1] for x in around if x is after]
            left = [x[2] for x in around if x is before] + left + [x[2] for x in around if x is after]
            twin, reach = between(region, right, left)
            twin, reach = np.r_[False, twin, False], np.r_[0, reach, 0]
            lo, n = (1 if before else 0), b.num_rows
            twin = twin[lo : lo + n] | twin[lo + 1 : lo + n + 1]
            reach = np.maximum(reach[lo : lo + n], reach[lo + 1 : lo + n + 1]).astype(np.int32)
            edge = np.zeros(n, np.int32)
            edge[0] |= 0 if before else 1
            edge[-1] |= 0 if after else 2
            stop = b.column(2).to_numpy() + np.array([len(x) // 4 for x in right[lo : lo + n]], np.int32)
            words = [pa.array(b.column(i).to_pylist(), b.column(i).type, mask=np.asarray(edge == 0)) for i in (5, 6)]
            return pa.RecordBatch.from_arrays([*(b.column(i) for i in range(4)), pa.array(twin), pa.array(reach), pa.array(stop), pa.array(edge), pa.array(np.full(n, part, np.int32)), b.column(4), *words], names)

        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                yield done(held, tuple(b.column(i)[0].as_py() for i in (4, 5, 6)))
                before = tuple(held.column(i)[held.num_rows - 1].as_py() for i in (4, 5, 6))
            held = b
        if held is not None:
            yield done(held, None)

    found = scratch.keep(ordered.mapInArrow(run, "rid long, start int, place int, gram long, twin boolean, reach int, stop int, edge int, part int, region long, right binary, left binary"), "sorted")
    outer = sorted((r.asDict() for r in found.where("edge > 0").collect()), key=lambda r: (r["part"], r["edge"] == 2))  # two rows a partition at most
    for a, b in zip(outer[:-1], outer[1:], strict=True):
        if a["part"] != b["part"]:
            twin, reach = between(np.array([a["region"], b["region"]]), [bytes(a["right"]), bytes(b["right"])], [bytes(a["left"]), bytes(b["left"])])
            for x in (a, b):
                x["twin"], x["reach"] = x["twin"] or bool(twin[0]), max(x["reach"], int(reach[0]))
    met = suffixes.sparkSession.createDataFrame(outer, found.schema)
    return found.where("edge = 0").unionByName(met).select(*names[:7])


def repeats(rows: DataFrame, length: int, k: int, scratch: Scratch) -> DataFrame:
    """rid, start, stop (words) of the repeats, not yet merged."""
    retained = scratch.keep(find_regions(rows, length, k), "suffixes")
    counts = scratch.keep(retained.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    again = scratch.keep(meet(retained, counts, ["gram"], "n", retained.count()).drop("n"), "again")
    scratch.drop("suffixes")
    met = suffix_array(with_words(rows, again, length), scratch)
    whole = met.where("twin").select("rid", "start", "stop")
    count = (F.col("place") + F.col("reach") - length - F.col("start") + 1).cast("int")
    wanted = met.select("rid", "start", count.alias("count"), "gram", F.when(F.col("twin"), 2).otherwise(1).alias("weight")).where("count > 0")
    windows = scratch.keep(spread_windows(rows, wanted, length), "windows")
    extended = compare_neighbours(windows, "gram", "window", scratch, "extended")
    single = extended.where("twin and weight = 1").select("rid", "start", (F.col("start") + length).alias("stop"))
    kept = scratch.keep(whole.unionByName(single), "repeats")
    for name in ("counts", "again", "sorted", "windows", "extended"):
        scratch.drop(name)
    return kept


def mark_repeats(docs: DataFrame, *, length: int = 50, k: int = 16, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = (), text_out: bool = False) -> DataFrame:
    """Every text with its maximal repeats of ``length`` words or more, and what is left without them.

    Digest rows (doc_id, n_words, n_removed, n_spans, spans, kept_sha256), or with ``text_out``
    doc_id, the columns named in ``also``, the cut text and n_removed.
    """
    tune(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    rows = scratch.keep(numbered(docs, {"doc_id": id_col, "text": text_col, **{c: c for c in also}}), "rows")
    return with_spans(rows, repeats(rows, length, k, scratch), ["doc_id", *also], text_out=text_out)
