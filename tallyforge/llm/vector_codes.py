"""Vector code compression: product quantisation by Lloyd's rounds over kd-trees that filter the codebook.

Vectors become whole numbers and are cut into equal consecutive parts. Every partition packs its
vectors into chunks and builds one kd-tree a chunk and part, with the box, sum and count of every
node; these trees are written once and read again in each round. A round sends the codebooks (a
bounded model) to the chunks. Entries go down the tree level by level: the entry nearest to a
box's middle rules out each entry that is no nearer to the box's corner on its side, and a node
that is left with one entry is assigned whole, by its cached sum and count. Only sums by
part and entry are shuffled, and 256 rows a part come to the driver as the next codebooks. All
arithmetic is on whole numbers, so partitions and executors lost on the way change nothing.

Defined results: a null vector, or one with a null or non-finite component, has no row; an empty
vector has parts of no components, error 0 and the first code; vectors of different lengths, a length
that the parts do not divide and a component beyond 2^25 are errors; codebooks start with the smallest
ids (ids that are equal: by vector; null ids last), with fewer entries where there are fewer vectors;
repeated rows count each; equal distances go to the lower index; a null label is a label like others;
an empty table has no rows; columns not named are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, meet, tune

#: Components of a chunk's vectors at most, and points of a leaf.
CHUNK_COMPONENTS, LEAF = 1 << 20, 12
#: Nodes or points that meet all entries at once.
AT_ONCE = 4096
#: Squared distances below this are exact in double floats, which the comparisons use.
EXACT = 1 << 53


class Tree:
    """A kd-tree in arrays: points in tree order, and by node its span, children, box and sum.

    Nodes are split at the middle of their widest side; one of equal points is never split.
    """

    FIELDS = ("points", "order", "spans", "below", "low", "high", "sums")

    def __init__(self, *arrays: np.ndarray):
        self.points, self.order, self.spans, self.below, self.low, self.high, self.sums = arrays

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        order, spans, below, low, high, sums = np.arange(len(points)), [(0, len(points))], [], [], [], []
        at = 0
        while at < len(spans):
            a, b = spans[at]
            own = points[order[a:b]]
            least, most = own.min(axis=0), own.max(axis=0)
            low.append(least), high.append(most), sums.append(own.sum(axis=0))
            wide = most - least
            if b - a > LEAF and wide.any():
                axis = int(wide.argmax())
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, axis], middle)]
                below.append(len(spans))
                spans += [(a, a + middle), (a + middle, b)]
            else:
                below.append(-1)
            at += 1
        return cls(points[order], order, np.array(spans), np.array(below), np.array(low), np.array(high), np.array(sums))

    def pack(self) -> dict[str, bytes]:
        return {f: np.ascontiguousarray(getattr(self, f), np.int64 if f == "sums" else np.int32).tobytes() for f in self.FIELDS}

    @classmethod
    def unpack(cls, row: dict[str, bytes], width: int) -> Tree:
        arrays = {f: np.frombuffer(row[f], np.int64 if f == "sums" else np.int32).astype(np.int64) for f in cls.FIELDS}
        nodes, points = len(arrays["below"]), len(arrays["order"])
        shapes = {"points": (points, width), "order": (points,), "below": (nodes,), "spans": (nodes, 2)}
        return cls(*(a.reshape(shapes.get(f, (nodes, width))) for f, a in arrays.items()))

    def settled(self, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(nodes, entries, True) of subtrees assigned whole, and (points, entries, False) of points of mixed leaves."""
        entries = book.astype(float)
        square = np.einsum("ij,ij->i", entries, entries)
        ahead: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        nodes, may = np.zeros(1, np.int64), np.ones((1, len(book)), bool)
        while len(nodes):
            deeper = []
            for a in range(0, len(nodes), AT_ONCE):
                x = nodes[a : a + AT_ONCE]
                left = self._filter(x, may[a : a + AT_ONCE], entries, square, ahead)
                alone, inner = left.sum(axis=1) == 1, self.below[x] >= 0
                if alone.any():
                    yield x[alone], left[alone].argmax(axis=1), True
                down, leaf = ~alone & inner, ~alone & ~inner
                deeper.append(((self.below[x[down]][:, None] + np.arange(2)).reshape(-1), np.repeat(left[down], 2, axis=0)))
                yield from self._leaves(x[leaf], left[leaf], entries, square)
            nodes, may = (np.concatenate(v) for v in zip(*deeper, strict=True))

    def _filter(self, nodes: np.ndarray, may: np.ndarray, entries: np.ndarray, square: np.ndarray, ahead: dict) -> np.ndarray:
        """Of the entries that may be nearest to a place in each node's box, those that still may.

        An entry's lead over the box's champion, as a difference of squared distances, is linear in the place
        and so least at the corner on the entry's side: the upper bound where the entry is above the champion.
        """
        low, high = self.low[nodes].astype(float), self.high[nodes].astype(float)
        champion = np.where(may, square - (low + high) @ entries.T, np.inf).argmin(axis=1)
        order = np.argsort(champion, kind="stable")
        stays = np.empty_like(may)
        for own in np.split(order, np.flatnonzero(np.diff(champion[order])) + 1):
            c = int(champion[own[0]])
            if c not in ahead:
                off = entries - entries[c]
                ahead[c] = np.maximum(off, 0).T, np.minimum(off, 0).T
            above, under = ahead[c]
            lead = square - square[c] - 2 * (high[own] @ above + low[own] @ under)
            stays[own] = may[own] & ((lead < 0) | ((lead == 0) & (np.arange(len(entries)) <= c)))
        return stays

    def _leaves(self, nodes: np.ndarray, may: np.ndarray, entries: np.ndarray, square: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Each point of the leaves against its leaf's entries."""
        points, leaf = self._points(nodes)
        for a in range(0, len(points), AT_ONCE):
            some = points[a : a + AT_ONCE]
            away = np.where(may[leaf[a : a + AT_ONCE]], square - 2 * (self.points[some].astype(float) @ entries.T), np.inf)
            yield some, away.argmin(axis=1), False

    def _points(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of all points of the nodes, and for each the place of its node in ``nodes``."""
        sizes = self.spans[nodes, 1] - self.spans[nodes, 0]
        return np.repeat(self.spans[nodes, 0] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum()), np.repeat(np.arange(len(nodes)), sizes)

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By entry the sum and the count of the points nearest to it."""
        sums, counts = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
        for what, entries, whole in self.settled(book):
            np.add.at(sums, entries, self.sums[what] if whole else self.points[what])
            np.add.at(counts, entries, self.spans[what, 1] - self.spans[what, 0] if whole else 1)
        return sums, counts

    def nearest(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each point and its squared distance, in the order in which the points came."""
        found = np.zeros(len(self.points), np.int64)
        for what, entries, whole in self.settled(book):
            if whole:
                what, own = self._points(what)
                entries = entries[own]
            found[what] = entries
        off = self.points - book[found]
        codes, error = np.empty_like(found), np.empty_like(found)
        codes[self.order], error[self.order] = found, np.einsum("ij,ij->i", off, off)
        return codes, error


def whole_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, v (whole components) of the vectors without null or non-finite components."""
    most = math.isqrt(EXACT // 64) / scale  # narrowed by the parts' width later
    v = F.transform(vectors[vector_col], lambda x: x.cast("double"))
    rows = vectors.select(vectors[id_col].alias("vec_id"), vectors[label_col].alias("label"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    near = F.when(F.exists("v", lambda x: F.abs(x) > most), F.raise_error(F.lit("a component is too large to be coded"))).otherwise(F.transform("v", lambda x: F.floor(x * scale)))
    return rows.where(F.col("v").isNotNull() & fine).select("vec_id", "label", near.cast("array<int>").alias("v"))


def chunked(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """Chunks of vectors: vec_id, label (arrays), and for each part a packed kd-tree."""
    kinds = dict(rows.dtypes)
    size = max(1, CHUNK_COMPONENTS // max(1, width))
    step = width // parts
    packed = ", ".join(f"{f}: binary" for f in Tree.FIELDS)

    def pack(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        n = table.num_rows
        v = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, width).astype(np.int64)
        trees = [Tree.build(v[:, k * step : (k + 1) * step]).pack() for k in range(parts)]
        bound = pa.array([0, n], pa.int32())
        lists = [pa.ListArray.from_arrays(bound, table[c].combine_chunks()) for c in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.list_(pa.struct([(f, pa.binary()) for f in Tree.FIELDS])))], ["vec_id", "label", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            while b.num_rows:
                room = size - sum(x.num_rows for x in held)
                held.append(b.slice(0, room))
                b = b.slice(room)
                if sum(x.num_rows for x in held) == size:
                    yield pack(pa.Table.from_batches(held))
                    held = []
        if held:
            yield pack(pa.Table.from_batches(held))

    return rows.mapInArrow(run, f"vec_id array<{kinds['vec_id']}>, label array<{kinds['label']}>, trees array<struct<{packed}>>")


def trained(chunks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks (part, entry, component) after so many rounds; an unused entry stays."""
    step = books.shape[2]
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for trees in b.column(0).to_pylist():
                    found = [Tree.unpack(t, step).totals(book) for t, book in zip(trees, books, strict=True)]
                    counts = np.array([c for _, c in found])
                    part, entry = np.nonzero(counts)
                    sums = np.array([s for s, _ in found])[part, entry]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * step, pa.int32()), pa.array(sums.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), lists], ["part", "entry", "n", "sums"])

        found = chunks.select("trees").mapInArrow(run, "part int, entry int, n long, sums array<long>")
        columns = [F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(step)]
        books = books.copy()
        for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *columns).collect():  # at most an entry each
            books[r.part, r.entry] = np.array(r[3:], np.int64) // r.n
    return books


def coded(chunks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error of every vector."""
    kinds, step = dict(chunks.dtypes), books.shape[2]
    digits = [f"{k:02x}" for k in range(256)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, trees in enumerate(b.column(2).to_pylist()):
                found = [Tree.unpack(t, step).nearest(book) for t, book in zip(trees, books, strict=True)]
                codes = ["".join(digits[x] for x in row) for row in np.array([c for c, _ in found]).T.tolist()]
                error = np.sum([e for _, e in found], axis=0)
                ids, labels = (b.column(c).slice(k, 1).flatten() for c in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(codes), pa.array(error)], ["vec_id", "label", "code", "error"])

    return chunks.select("vec_id", "label", "trees").mapInArrow(run, f"vec_id {kinds['vec_id'][6:-1]}, label {kinds['label'][6:-1]}, code string, error long")


def codebooks_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def compress(
    vectors: DataFrame, *, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of the vectors that can be coded, as a written table, and the codebooks."""
    spark = vectors.sparkSession
    tune(spark)
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index must fit two hex digits")
    scratch = Scratch(spark, "vector-codes")
    rows = whole_vectors(vectors, scale, id_col, vector_col, label_col)
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    width = len(start[0].v) if start else 0
    if width % parts:
        raise ValueError(f"{parts} equal parts cannot be cut from {width} components")
    kinds = dict(rows.dtypes)
    if not start:
        none = spark.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
        return none, np.zeros((parts, 0, 0), np.int64)
    most = math.isqrt(EXACT // (64 * max(1, width // parts)))
    fits = F.when(F.exists("v", lambda x: F.abs(x) > most), F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(F.col("v"))
    same = F.when(F.size("v") == width, fits).otherwise(F.raise_error(F.lit("vectors of different lengths")))
    chunks = scratch.keep(chunked(rows.withColumn("v", same), width, parts), "chunks")
    books = np.array([r.v for r in start], np.int64).reshape(len(start), parts, width // parts).swapaxes(0, 1)
    books = trained(chunks, books, rounds)
    found = scratch.keep(coded(chunks, books), "codes")
    scratch.drop("chunks")
    return found, books


def code_vectors(spark: SparkSession, vectors: DataFrame, **options) -> DataFrame:
    """The contract's digest: vec_id, code, error, label_error, codebooks_sha256."""
    found, books = compress(vectors, **options)
    keys = [F.col("label").isNull().alias("bare"), F.coalesce(F.col("label").cast("string"), F.lit("")).alias("key")]
    each = found.select("vec_id", "code", "error", *keys)
    sums = each.groupBy("bare", "key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    out = meet(each, sums, ["bare", "key"], "n", found.count())
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


_ROUND = """
s{k} AS MATERIALIZED (SELECT p.id, p.part, min({{'d': p.n - 2 * list_dot_product(p.v, b.v) + b.n, 'e': b.entry}}) AS m FROM p JOIN b{j} b USING (part) GROUP BY ALL),"""
_BOOK = """
a{k} AS MATERIALIZED (SELECT part, entry, i, floor(sum(v[i]) / count(*)) AS x FROM (SELECT part, m.e AS entry, v, unnest(range(1, len(v) + 1)) AS i FROM s{k} JOIN p USING (id, part)) GROUP BY ALL),
u{k} AS MATERIALIZED (SELECT part, entry, list(x ORDER BY i) AS v FROM a{k} GROUP BY ALL),
b{k} AS MATERIALIZED (SELECT part, entry, coalesce(u.v, b.v) AS v, list_dot_product(coalesce(u.v, b.v), coalesce(u.v, b.v)) AS n FROM b{j} b LEFT JOIN u{k} u USING (part, entry)),"""

#: Distances of every part to every entry; doubles hold these whole numbers exactly.
ORACLE = (
    """
WITH f AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS id, * FROM f),
p AS MATERIALIZED (SELECT id, part, v, list_dot_product(v, v) AS n FROM (SELECT id, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS v FROM kept, range(4) AS r(part))),
b0 AS MATERIALIZED (SELECT part, id - 1 AS entry, v, n FROM p WHERE id <= 256),"""
    + "".join((_ROUND + _BOOK).format(k=k, j=k - 1) for k in range(1, 5))
    + _ROUND.format(k=5, j=4)
    + """
c AS (SELECT id, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM s5 GROUP BY id),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b4)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN c USING (id), h
"""
)
