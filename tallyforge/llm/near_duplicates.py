"""N-gram Jaccard join by a MinHash LSH forest and exact verification.

A text is the set of its five-word shingles (a shorter one is a single shingle of all its
words). Texts with equal sets are one *class*: its first row stands for it, its size is a
weight, and copies are never expanded into pairs. Every class has ``trees`` signatures of
``deepest`` MinHash values. A tree is a prefix trie kept as a sorted table: the signatures are
range-sorted over the cluster, and each row's match is the longest common prefix with the row
before it. One edge a row, to the first row of the run that shares this prefix and labelled
with its length, holds the whole trie: the edges of length d or more connect exactly the rows
that share d values. So a prefix that a third of all rows share lies over many tasks.

The longest prefixes are matched first. Their components are verified exactly, and the
similarities of the links met say which recall this length has: a link of similarity s is met
with probability 1 - (1 - s^d)^trees, so every link met stands for the inverse of that. Three
links at the threshold itself are added (the rule of three: what n links met cannot rule out),
so with few links the worst case counts. While the measured recall is below the target, the
prefixes are shortened, and only components that grew by it are verified again.

All pairs inside a component, met or not, are verified inside tasks; a large component is
dealt out as pairs of bounded blocks, and only sums and one edge a member and block leave a task.

Defined results: a null text is an empty one; texts without words have no links and a group
each; equal sets are linked (similarity 1); repeated rows are copies like others; ``group_id`` is
the smallest id of a group, of rows with one id the first stays; an empty table has no rows;
columns not named in ``also`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, meet, tune
from tallyforge.llm.components import connected
from tallyforge.llm.passages import WordHashes, grams, mixed, numbered

#: A block of a component: so many members and so many shingles at most (or one longer text).
BLOCK_MEMBERS, BLOCK_SHINGLES = 1024, 400_000


#: Bins of the similarities from the threshold to 1 by which the recall is measured.
BINS = 20


def meeting(similarity: float, depth: int, trees: int) -> float:
    """The probability that two sets of this similarity share a prefix of this length in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def measured_recall(met: dict[int, int], threshold: float, depth: int, trees: int) -> float:
    """Of the links met (by bin of similarity) and three at the threshold, the share that this depth meets."""
    wanted = 3 / meeting(threshold, depth, trees) + sum(k / meeting(threshold + b * (1 - threshold) / BINS, depth, trees) for b, k in met.items())
    return (3 + sum(met.values())) / wanted


def shingles(text: str, size: int, memo: WordHashes) -> np.ndarray:
    words = memo.of(text.encode().split())
    width = min(size, len(words))
    if not width:
        return np.zeros(0, np.uint64)
    return np.unique(grams(words, width)[: len(words) - width + 1] + np.uint64(width))


def describe(rows: DataFrame, size: int, trees: int, deepest: int) -> DataFrame:
    """rid, n, two sums that stand for the shingle set, and a signature of ``deepest`` two-byte values for each tree."""
    random = np.random.default_rng(7)
    flips, factors = (random.integers(0, 1 << 32, trees * deepest, np.uint32) | np.uint32(1) for _ in range(2))

    def run(batches):
        memo = WordHashes()
        for b in batches:
            sets = [shingles(t, size, memo) for t in b.column(1).to_pylist()]
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            some = np.flatnonzero(n)
            first = (np.cumsum(n) - n)[some]
            one, two, values = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.zeros((len(n), trees * deepest), ">u2")
            if len(some):
                flat = np.concatenate(sets)
                one[some] = np.add.reduceat(mixed(flat ^ np.uint64(0x5851F42D4C957F2D)), first).view(np.int64)
                two[some] = np.add.reduceat(mixed(flat + np.uint64(0x14057B7EF767814F)), first).view(np.int64)
                half = (mixed(flat) >> np.uint64(32)).astype(np.uint32)
                for j in range(trees * deepest):
                    least = np.minimum.reduceat((half ^ flips[j]) * factors[j], first)
                    values[some, j] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
            ends = np.arange(0, values.nbytes + 1, 2 * deepest, dtype=np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(n) * trees, [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) * trees + 1, trees, dtype=np.int32)), words)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(one), pa.array(two), lists], ["rid", "n", "one", "two", "signature"])

    return rows.select("rid", "text").mapInArrow(run, "rid long, n long, one long, two long, signature array<binary>")


def forest(classes: DataFrame, deepest: int, shortest: int, scratch: Scratch) -> DataFrame:
    """(u, v, level) edges of all trees: v is the first row of the run of rows that share ``level`` values with u.

    Of runs that go on in the next partition only the two rows at the border, two a partition, pass through the driver.
    """
    spark = classes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["tree", "word", "rid"]
    sorted_rows = classes.select(F.posexplode("signature").alias("tree", "word"), "rid").repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def shared(tree: np.ndarray, values: np.ndarray) -> np.ndarray:
        """How many values each row has in common with the row before it; the first row counts as alone."""
        alike = (values[1:] == values[:-1]) & (tree[1:] == tree[:-1])[:, None]
        return np.r_[0, np.logical_and.accumulate(alike, axis=1).sum(axis=1)]

    def edge(u: np.ndarray, v: np.ndarray, level: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(u), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(level.astype(np.int32)), none, none, pa.nulls(len(u), pa.binary())], names)

    def border(rid: int, part: int, tree: int, word: bytes) -> pa.RecordBatch:
        made = [pa.array([rid]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([part], pa.int32()), pa.array([tree], pa.int32()), pa.array([word], pa.binary())]
        return pa.RecordBatch.from_arrays(made, names)

    names = ["u", "v", "level", "part", "tree", "word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, heads = 2 * TaskContext.get().partitionId(), None, {}
        for b in batches:
            if not b.num_rows:
                continue
            tree, rid = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            values = np.frombuffer(b"".join(b.column(1).to_pylist()), ">u2").reshape(len(rid), deepest)
            if last is None:
                yield border(int(rid[0]), part, int(tree[0]), values[0].tobytes())
                level = shared(tree, values)
            else:
                level = shared(np.r_[last[0], tree], np.concatenate([last[1], values]))[1:]
            for d in range(shortest, deepest + 1):
                start = np.maximum.accumulate(np.where(level < d, np.arange(len(rid)), -1))
                head = np.where(start >= 0, rid[start], heads.get(d, rid[0]))
                heads[d] = int(head[-1])
                mine = np.flatnonzero(level == d)
                if len(mine):
                    yield edge(rid[mine], head[mine], level[mine])
            last = tree[-1:], values[-1:], int(rid[-1])
        if last is not None:
            yield border(last[2], part + 1, int(last[0][0]), last[1].tobytes())

    found = scratch.keep(sorted_rows.mapInArrow(run, "u long, v long, level int, part int, tree int, word binary"), "forest")
    outer = sorted(found.where("part is not null").select("part", "tree", "word", "u").collect())
    across = []
    for a, b in zip(outer[1:-1:2], outer[2::2], strict=True):  # a partition's last row, and the next one's first
        values = np.frombuffer(a.word + b.word, ">u2").reshape(2, deepest)
        across.append((b.u, a.u, int(shared(np.array([a.tree, b.tree]), values)[1])))
    met = spark.createDataFrame([x for x in across if x[2] >= shortest], "u long, v long, level int")
    pairs = found.where("part is null").select("u", "v", "level").unionByName(met)
    pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), "level").where("u != v").groupBy("u", "v").agg(F.max("level").alias("level"))
    pairs = scratch.keep(pairs, "edges")
    scratch.drop("forest")
    return pairs


def verify(members: DataFrame, threshold: float) -> DataFrame:
    """comp, rid, linked (weight of the members linked to it), peer (a linked member or itself) for each block.

    members: part, comp, side, rid, copies, shingles; a part is bounded, and holds the two sides
    of a pair of blocks (side 0 and 1) or whole components (side -1). Rows without a rid say how
    many links (linked) a block has in a bin of similarity (peer).
    """

    def compare(sets: list[np.ndarray], sizes: np.ndarray, copies: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, flat = np.unique(np.concatenate(sets), return_inverse=True)
        first, mark = np.cumsum(sizes) - sizes, np.zeros(int(flat.max()) + 1, np.int32)
        linked, root, bins = np.zeros(len(sets), np.int64), np.arange(len(sets)), np.zeros(BINS + 1, np.int64)

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = int(root[x])
            return x

        whole = (side == -1).all()
        for x in range(len(sets)) if whole else np.flatnonzero(side == 0):
            mine = flat[first[x] : first[x] + sizes[x]]
            mark[mine] = 1
            lo = x + 1 if whole else 0
            others = np.arange(lo, len(sets)) if whole else np.flatnonzero(side == 1)
            if len(others):
                begin = first[others[0]]  # side 1 comes last, so the others end the list
                common = np.add.reduceat(mark[flat[begin:]], first[others] - begin)
                alike = common / (sizes[x] + sizes[others] - common)
                hit = others[alike >= threshold]
                bins += np.bincount(((alike[alike >= threshold] - threshold) * (BINS / (1 - threshold + 1e-12))).astype(int), minlength=BINS + 1)
                linked[x] += copies[hit].sum()
                linked[hit] += copies[x]
                for y in hit:
                    a, b = sorted((find(x), find(int(y))))
                    root[b] = a
            mark[mine] = 0
        return linked, np.array([find(i) for i in range(len(sets))]), bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by([("comp", "ascending"), ("side", "ascending"), ("rid", "ascending")])
        if not table.num_rows:
            return
        comp, side, rid, copies = (table[c].to_numpy() for c in ("comp", "side", "rid", "copies"))
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        edges = np.r_[np.flatnonzero(np.r_[True, comp[1:] != comp[:-1]]), len(comp)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            linked, root, bins = compare(sets[a:b], sizes[a:b], copies[a:b], side[a:b])
            some = np.flatnonzero(bins)
            made = [np.r_[comp[a:b], np.full(len(some), comp[a])], pa.array([*rid[a:b].tolist(), *[None] * len(some)], pa.int64()), np.r_[linked, bins[some]], np.r_[rid[a:b][root], some]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["comp", "rid", "linked", "peer"])

    return members.groupBy("part").applyInArrow(run, "comp long, rid long, linked long, peer long")


def verified(near: DataFrame, sizes: DataFrame, rows: DataFrame, size: int, threshold: float, scratch: Scratch, name: str) -> DataFrame:
    """``verify`` over the components ``near`` (node, root, copies) of the given ``sizes`` (root, members, shingles)."""
    members, total = sizes.agg(F.sum("members"), F.sum(F.when(F.col("blocks") == 1, F.col("shingles")))).first()
    shared = max(1, -(-(total or 0) // BLOCK_SHINGLES))  # small components share so many parts
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.col("other")
    dealt = meet(near, sizes.select("root", "members", "blocks"), ["root"], "members", members or 0)
    dealt = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    one = F.col("blocks") == 1
    part = F.when(one, F.pmod(F.xxhash64("root"), F.lit(shared)).cast("string")).otherwise(F.concat_ws("-", "root", F.least("mine", other), F.greatest("mine", other)))
    side = F.when(one | (F.col("mine") == other), -1).when(F.col("mine") < other, 0).otherwise(1)
    dealt = dealt.select(F.col("node").alias("rid"), F.col("root").alias("comp"), "copies", part.alias("part"), side.alias("side"))

    def gather(batches):
        memo = WordHashes()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingles(t, size, memo).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["rid", "shingles"])

    sets = rows.select("rid", "text").join(dealt.select("rid").distinct(), "rid", "left_semi").mapInArrow(gather, "rid long, shingles binary")
    sets = scratch.keep(sets, "sets")
    links = scratch.keep(verify(dealt.join(sets, "rid").select("part", "comp", "side", "rid", "copies", "shingles"), threshold), name)
    scratch.drop("sets")
    return links


def near_duplicates(
    docs: DataFrame, *, size: int = 5, threshold: float = 0.8, trees: int = 24, deepest: int = 10, recall: float = 0.9999, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()
) -> DataFrame:
    """Every row with group_id, n_links, group_size and ``first`` (whether it is the row that stays for its group)."""
    tune(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near-duplicates")
    rows = scratch.keep(numbered(docs, {"doc_id": id_col, "text": text_col, **{c: c for c in also}}), "rows")
    described = scratch.keep(describe(rows, size, trees, deepest), "described")
    whole = ["n", "one", "two"]
    classes = described.where("n > 0").groupBy(*whole).agg(F.count("*").alias("copies"), F.min(F.struct("rid", "signature")).alias("x"))
    classes = scratch.keep(classes.select("x.rid", "copies", *whole, "x.signature"), "classes")
    shortest = next((d for d in range(deepest, 1, -1) if meeting(threshold, d, trees) >= recall), 1)
    some = classes.where(F.col("n") / (F.col("n") + 1) >= threshold)  # a smaller set has equal sets as its only links
    edges = forest(some, deepest, shortest, scratch)

    depth, links, before = deepest, None, None
    while True:
        near = connected(edges.where(F.col("level") >= depth), scratch, f"near-{depth}")
        near = scratch.keep(near.join(classes.select(F.col("rid").alias("node"), "copies", "n"), "node"), f"near-{depth}")
        sizes = near.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
        blocks = F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
        sizes = scratch.keep(sizes.withColumn("blocks", blocks), f"sizes-{depth}")
        grown = sizes if before is None else sizes.join(before.select("root", "members"), ["root", "members"], "left_anti")
        fresh = verified(near.select("node", "root", "copies"), grown, rows, size, threshold, scratch, f"links-{depth}")
        if links is not None:
            same = sizes.join(before.select("root", "members"), ["root", "members"], "left_semi").select(F.col("root").alias("comp"), "members")
            fresh = fresh.unionByName(meet(links, same, ["comp"], "members", sizes.agg(F.sum("members")).first()[0] or 0).drop("members"))
        links, before = fresh, sizes
        met = {r.peer: r.k for r in links.where("rid is null").groupBy("peer").agg(F.sum("linked").alias("k")).collect()}
        if depth == shortest or measured_recall(met, threshold, depth, trees) >= recall:
            break
        depth = next((d for d in range(depth - 1, shortest, -1) if measured_recall(met, threshold, d, trees) >= recall), shortest)

    links = links.where("rid is not null")
    roots = connected(links.select(F.col("rid").alias("u"), F.col("peer").alias("v")), scratch, "links")
    sums = links.groupBy("rid").agg(F.sum("linked").alias("linked"))
    heads = classes.select("rid", "copies", *whole).join(sums, "rid", "left").join(roots.select(F.col("node").alias("rid"), "root"), "rid", "left")
    heads = scratch.keep(heads.select(*whole, "copies", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rid").alias("root")), "heads")
    scratch.drop("classes")
    each = described.select("rid", *whole).join(rows.select("rid", "doc_id"), "rid")
    total = heads.agg(F.sum("copies")).first()[0] or 0
    known = meet(each, heads, whole, "copies", total).select("rid", "doc_id", "root", "n_links")
    each = scratch.keep(known.unionByName(each.where("n = 0").select("rid", "doc_id", F.col("rid").alias("root"), F.lit(0).cast("long").alias("n_links"))), "each")
    scratch.drop("described")
    groups = each.groupBy("root").agg(F.min("doc_id").alias("group_id"), F.count("*").alias("group_size"), F.min(F.struct("doc_id", "rid")).alias("head"))
    groups = scratch.keep(groups, "groups")
    out = meet(each, groups, ["root"], "group_size", each.count()).select("rid", "doc_id", "group_id", "n_links", "group_size", (F.col("rid") == F.col("head.rid")).alias("first"))
    return out if not also else rows.join(out.drop("doc_id"), "rid")
