"""Steps repeated until nothing changes: records that state their own size, sums over trees, walks over links.

Every round's tables are written to the shared folder, so plans do not grow with the rounds and a lost
executor costs a reread. Rounds end by counting, never by a number that is fixed beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyforge.operators.ranks import placed
from tallyforge.session import Scratch

#: Places of a sequence that are followed through in one row.
BLOCK = 1 << 16
#: Sizes beyond this are as good as endless.
FAR = 1 << 61


def self_sized(rows: DataFrame, keys: list[str], place: str, size: Column, *, block: int = BLOCK) -> DataFrame:
    """keys, place, size, record, state of the records of sequences whose records say how long they are.

    ``rows`` has the places of each sequence, from its first to its last, one row a place; places at which no
    record can start may be left out, other than the last. ``size`` is how many places a record takes that starts
    at the row: null or below 1 where none can. Each record begins where the one before it ends; ``followed`` says how starts are found.

    state: ``whole``; ``truncated`` where a record ends beyond its sequence; ``malformed`` where none can start at
    the end of the one before. The last two end their sequence. ``record`` counts from 0. A sequence with a null
    key or place is left out; repeated places of a sequence are an error; no rows, no records.
    """
    own = [F.col(k).alias(k) for k in keys]
    given = rows.where(F.col(place).isNotNull()).select(*own, F.col(place).cast("long").alias("_p"), F.coalesce(size.cast("long"), F.lit(0)).alias("_n"))
    held = given.withColumns({"_b": block_of("_p", block), "_p": F.expr(f"pmod(_p, {block})").cast("int")})
    return followed(held.groupBy(*keys, "_b").agg(F.collect_list("_p").alias("_p"), F.collect_list("_n").alias("_n")), keys, place, block)


def block_of(place: str, block: int) -> Column:
    return F.expr(f"({place} - pmod({place}, {block})) div {block}")


def followed(blocks: DataFrame, keys: list[str], place: str, block: int) -> DataFrame:
    """``self_sized`` of sequences that are cut into blocks of so many places already: keys, _b (the block), _p (places in it), _n (sizes).

    Instead of _p there may be _low, the first of the block's places, if none is left out behind it; sizes below 256 may be a binary, a byte each.
    _m, where there is one, is what holds from a place on: structs with _p, by which they are in order, whose other fields come out beside each record for its first place.
    A block is a row, and is followed through in one go. Where the chains of all its places leave it tells at which places other blocks can
    be entered, few as chains run together; from entry to entry, starts are found by pointer jumping: the first place
    is a start, and in each round what 2^k entries further lies from the starts known is added and the jumps are
    doubled. Then each block is read from its entry on. A sequence of n blocks takes log2 n rounds of two joins of
    entries; one of a single block takes none.
    """
    scratch = Scratch(blocks.sparkSession, "self-sized")
    for k in keys:
        blocks = blocks.where(F.col(k).isNotNull())
    marks = [f for f in blocks.schema["_m"].dataType.elementType if f.name != "_p"] if "_m" in blocks.columns else []
    own = [*keys, "_b", "_p" if "_p" in blocks.columns else "_low", "_n", *(["_m"] if marks else [])]
    if "_p" in own:
        blocks = blocks.select(*own, (F.size(F.array_distinct("_p")) < F.size("_p")).alias("_again"), F.array_min("_p").alias("_low"), F.array_max("_p").alias("_high"))
    else:
        many = F.length("_n") if blocks.schema["_n"].dataType.typeName() == "binary" else F.size("_n")
        blocks = blocks.select(*own, (F.col("_low") + many - 1).alias("_high"))
    blocks = scratch.keep(blocks, "blocks")
    if "_p" in own and blocks.where("_again").head(1):
        raise ValueError("a place stands more than once in its sequence")
    full = F.col("_b") * block
    ends = blocks.groupBy(*keys).agg(F.min(full + F.col("_low")).alias("_first"), F.max(full + F.col("_high")).alias("_last"), F.count("*").alias("_blocks"))
    ends = scratch.keep(ends, "ends")
    blocks = blocks.select(*own)
    starts = scratch.keep(ends.select(*keys, F.col("_first").alias("_p"), F.lit(0).cast("long").alias("record")), "starts-0")
    kinds = StructType([ends.schema[k] for k in keys])
    if ends.where("_blocks > 1").head(1):
        out = StructType([*kinds, StructField("_to", LongType())])
        left = blocks.mapInArrow(partial(_exits, keys=keys, block=block), out).distinct()
        inside = left.join(ends, keys).where("_to <= _last").select(*keys, F.col("_to").alias("_p"))
        entries = scratch.keep(inside.unionByName(starts.select(*keys, "_p")).withColumn("_b", block_of("_p", block)), "entries")
        met = entries.groupBy(*keys, "_b").agg(F.collect_list("_p").alias("_in")).join(blocks, [*keys, "_b"])
        out = StructType([*kinds, StructField("_from", LongType()), StructField("_to", LongType()), StructField("_w", LongType())])
        jumps = met.mapInArrow(partial(_crossings, keys=keys, block=block), out).join(ends, keys).where("_to <= _last").select(*keys, "_from", "_to", "_w")
        starts = _jumped(scratch, starts, scratch.keep(jumps, "jumps-0"), keys)
    begun = starts.join(ends.select(*keys, "_last"), keys).select(*keys, block_of("_p", block).alias("_b"), F.array("_p").alias("_in"), "record", "_last")
    out = StructType([*kinds, StructField(place, LongType()), StructField("size", LongType()), StructField("record", LongType()), StructField("_last", LongType()), *marks])
    known = begun.join(blocks, [*keys, "_b"], "left").mapInArrow(partial(_starts, keys=keys, block=block, names=out.names), out)
    end = F.col(place) + F.col("size") - 1
    state = F.when(F.col("size").isNull(), "malformed").when(end > F.col("_last"), "truncated").otherwise("whole")
    return known.where(F.col(place) <= F.col("_last")).select(*keys, place, "size", "record", state.alias("state"), *(f.name for f in marks))


def _jumped(scratch: Scratch, starts: DataFrame, jumps: DataFrame, keys: list[str]) -> DataFrame:
    """The places that jumps (_from, _to, _w records on) lead to from the starts, each with its record's number."""
    found, turn = starts.count(), 0
    while True:
        met = starts.join(jumps.withColumnRenamed("_from", "_p"), [*keys, "_p"]).select(*keys, F.col("_to").alias("_p"), (F.col("record") + F.col("_w")).alias("record"))
        starts = scratch.keep(starts.unionByName(met), f"starts-{turn + 1}")
        if (now := starts.count()) == found:
            return starts
        further = jumps.select(*keys, F.col("_from").alias("_to"), F.col("_to").alias("_end"), F.col("_w").alias("_more"))
        jumps = scratch.keep(jumps.join(further, [*keys, "_to"]).select(*keys, "_from", F.col("_end").alias("_to"), (F.col("_w") + F.col("_more")).alias("_w")), f"jumps-{turn + 1}")
        for name in (f"starts-{turn}", f"jumps-{turn}"):
            scratch.drop(name)
        found, turn = now, turn + 1


class _Places:
    """The places of a batch of blocks in order, with the places that records in them or ``also`` lead to; ``next`` is a record's end, or itself where that lies beyond the block."""

    def __init__(self, batch: pa.RecordBatch, block: int, also: np.ndarray | None = None):
        sizes = batch.column("_n")
        packed = pa.types.is_binary(sizes.type) or pa.types.is_large_binary(sizes.type)
        many = pc.fill_null((pc.binary_length if packed else pc.list_value_length)(sizes), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), many)
        if "_p" in batch.schema.names:
            at = batch.column("_p").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            low = pc.fill_null(batch.column("_low"), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.arange(len(row)) + np.repeat(low - np.cumsum(many) + many, many)
        flat = np.frombuffer(b"".join(sizes.drop_null().to_pylist()), np.uint8) if packed else sizes.flatten().to_numpy(zero_copy_only=False)
        n = np.minimum(flat.astype(np.int64), FAR)
        inside = (n >= 1) & (n < block - at)
        named = (row * block + at + n)[inside]
        at = row * block + at
        order = np.argsort(at, kind="stable")
        at, n = at[order], n[order]
        named = named if also is None else np.concatenate([named, also])
        found = np.minimum(np.searchsorted(at, named), max(0, len(at) - 1))
        lost = np.unique(named[at[found] != named]) if len(at) else np.unique(named)
        if len(lost):
            at, n = np.concatenate([at, lost]), np.concatenate([n, np.zeros(len(lost), np.int64)])
            order = np.argsort(at, kind="stable")
            at, n = at[order], n[order]
        self.row, self.at, self.n = at // block, at, n
        self.inside = (n >= 1) & (n < block - at % block)
        self.next = np.arange(len(at))
        self.next[self.inside] = np.searchsorted(at, (at + n)[self.inside])
        self.place = batch.column("_b").to_numpy(zero_copy_only=False)[self.row] * block + at % block

    def last(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each place the last one of its chain inside the block, and how many records lie between."""
        to, count = self.next, self.inside.astype(np.int64)
        while not np.array_equal(further := to[to], to):
            count, to = count + count[to], further
        return to, count


def _entered(batch: pa.RecordBatch, block: int) -> np.ndarray:
    lists = batch.column("_in")
    row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    return row * block + lists.flatten().to_numpy(zero_copy_only=False) % block


def _rows(batch: pa.RecordBatch, keys: list[str], row: np.ndarray, columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    own = {k: batch.column(k).take(pa.array(row)) for k in keys}
    return pa.RecordBatch.from_pydict(own | {k: v if isinstance(v, pa.Array) else pa.array(v, pa.int64()) for k, v in columns.items()})


def _exits(batches: Iterator[pa.RecordBatch], keys: list[str], block: int) -> Iterator[pa.RecordBatch]:
    """Where the chains of any place leave their block."""
    for batch in batches:
        x = _Places(batch, block)
        to = np.unique(x.last()[0])
        to = to[x.n[to] >= 1]
        yield _rows(batch, keys, x.row[to], {"_to": x.place[to] + x.n[to]})


def _crossings(batches: Iterator[pa.RecordBatch], keys: list[str], block: int) -> Iterator[pa.RecordBatch]:
    """From each entry of a block to where its chain leaves it, and how many records further that is."""
    for batch in batches:
        x = _Places(batch, block, also := _entered(batch, block))
        at = np.searchsorted(x.at, also)
        to, count = (v[at] for v in x.last())
        on = x.n[to] >= 1
        at, to, count = at[on], to[on], count[on]
        yield _rows(batch, keys, x.row[at], {"_from": x.place[at], "_to": x.place[to] + x.n[to], "_w": count + 1})


def _marked(batch: pa.RecordBatch, block: int, row: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    """What holds at places of a batch's blocks by their _m; null in blocks that have none."""
    if "_m" not in batch.schema.names:
        return []
    lists = batch.column("_m")
    own, held = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)), lists.flatten()
    nth = np.searchsorted(own * block + held.field("_p").to_numpy(zero_copy_only=False).astype(np.int64), at, side="right") - 1
    none = nth < 0
    none[~none] = own[nth[~none]] != row[~none]
    return [held.field(f.name).take(pa.array(nth, mask=none)) for f in held.type if f.name != "_p"]


def _starts(batches: Iterator[pa.RecordBatch], keys: list[str], block: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The records of blocks, each read from its one entry on."""
    for batch in batches:
        x = _Places(batch, block, also := _entered(batch, block))
        to, found, count = x.next.tolist(), [], []
        for at in np.searchsorted(x.at, also).tolist():
            held = len(found)
            found.append(at)
            while (further := to[at]) != at:
                found.append(at := further)
            count.append(len(found) - held)
        at = np.array(found, np.int64)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count).astype(np.int64)
        record, last = (batch.column(c).to_numpy(zero_copy_only=False)[x.row[at]] for c in ("record", "_last"))
        columns = (x.place[at], pa.array(x.n[at], pa.int64(), mask=x.n[at] < 1), record + nth, last, *_marked(batch, block, x.row[at], x.at[at]))
        yield _rows(batch, keys, x.row[at], dict(zip(names[len(keys) :], columns, strict=True)))


def subtree_sums(nodes: DataFrame, node: str, parent: str, values: dict[str, Column]) -> DataFrame:
    """node, depth (0 at a root), below (nodes in its subtree, itself included), and each value summed over its subtree.

    ``nodes`` has a row a node with its parent, null for a root; depth is unknown and may be uneven. Pointers double:
    in round k every node adds what it gathered to its ancestor 2^k steps up, so a tree of depth d takes log2 d rounds.
    Children of one parent are added up before they are sent, whatever their number.
    A cycle, a parent that is no node and a node with two rows are errors; null nodes and null values count as nothing.
    """
    scratch = Scratch(nodes.sparkSession, "subtrees")
    names = list(values)
    sums = [F.coalesce(v.cast("long"), F.lit(0)).alias(n) for n, v in values.items()]
    given = nodes.where(F.col(node).isNotNull()).select(F.col(node).alias("_v"), F.col(parent).alias("_up"), F.lit(1).cast("long").alias("below"), *sums)
    state = scratch.keep(given.withColumn("depth", F.col("_up").isNotNull().cast("long")), "round-0")
    total, different = state.agg(F.count("*"), F.count_distinct("_v")).first()
    if total != different:
        raise ValueError("a node stands more than once")
    orphans = state.where("_up is not null").select(F.col("_up").alias("_v")).distinct().join(state.select("_v"), "_v", "left_anti")
    if orphan := orphans.head(1):
        raise ValueError(f"no node {orphan[0][0]}, which others name as their parent")
    turn = 0
    while (active := state.where("_up is not null")).head(1):
        if 1 << turn > total:
            raise ValueError("the nodes' parents form a cycle")
        sent = active.groupBy("_up").agg(*(F.sum(c).alias(f"_{c}") for c in ("below", *names))).withColumnRenamed("_up", "_v")
        above = state.select(F.col("_v").alias("_up"), F.col("_up").alias("_further"), F.col("depth").alias("_steps"))
        moved = active.join(above, "_up").select("_v", F.col("_further").alias("_up"), "below", *names, (F.col("depth") + F.col("_steps")).alias("depth"))
        both = moved.unionByName(state.where("_up is null")).join(sent, "_v", "left")
        added = [(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in ("below", *names)]
        state = scratch.keep(both.select("_v", "_up", *added, "depth"), f"round-{turn + 1}")
        scratch.drop(f"round-{turn}")
        turn += 1
    return state.select(F.col("_v").alias(node), "depth", "below", *names)


def walk(links: DataFrame, start: DataFrame, *, steps: int | None = None, within: Column | None = None) -> DataFrame:
    """(page, depth) of the pages that links (page, to) lead to from the start, each at its least depth.

    Every step joins only the newest pages with the links and takes off the pages seen, which are read back
    from where the steps wrote them. ``within`` is a condition on ``page`` that pages must meet to be visited.
    It ends when a step finds nothing new, or after ``steps``. Null pages are none.
    """
    scratch, spark = Scratch(start.sparkSession, "walk"), start.sparkSession
    fits = F.col("page").isNotNull() if within is None else F.col("page").isNotNull() & within
    ahead, depth, seen = start.select("page").where(fits).distinct(), 0, None
    while True:
        newest = scratch.keep(ahead, f"pages/depth={depth}")
        schema = spark.createDataFrame([], newest.schema).withColumn("depth", F.lit(0)).schema
        seen = spark.read.schema(schema).parquet(f"{scratch.base}/pages")
        if depth == steps or not newest.head(1):
            return seen
        depth += 1
        to = newest.join(links, "page").select(F.col("to").alias("page")).where(fits).distinct()
        ahead = to.join(seen.select("page"), "page", "left_anti")


def crawl(links: DataFrame, seeds: DataFrame, *, prefixes: list[str], label: Column, most_pages: int, most_labels: int) -> tuple[DataFrame, DataFrame]:
    """(pages, labels) of a bounded crawl: pages with depth and place, labels with their place, no more than asked for.

    A page or label is only taken if it begins with one of the prefixes; ``label`` tells on ``page`` what is a label,
    which ends there. Pages are visited by depth, then by name, and the first ``most_pages`` of them are read. Labels
    stand in the order of the first page that names them, then by name, up to ``most_labels``. Pages beyond the bound
    are never read: a step keeps what room is left, so that a bound ends the walk early.
    """
    scratch, spark = Scratch(seeds.sparkSession, "crawl"), seeds.sparkSession
    inside = F.lit(False)
    for p in prefixes:
        inside = inside | F.col("page").startswith(p)
    shape = "page string, depth int, place long"
    seen = spark.createDataFrame([], shape)
    ahead, room, depth = seeds.select("page").where(inside & ~label).distinct(), most_pages, 0
    while room > 0:
        ranked = placed(ahead, ["page"], "place", scratch=scratch).where(F.col("place") <= room)
        newest = scratch.keep(ranked.select("page", F.lit(depth).alias("depth"), (F.col("place") + (most_pages - room)).alias("place")), f"pages/part={depth}")
        scratch.drop("places-place")
        if not (found := newest.count()):
            break
        seen = spark.read.schema(shape).parquet(f"{scratch.base}/pages").select("page", "depth", "place")
        room, depth = room - found, depth + 1
        to = newest.select("page").join(links, "page").select(F.col("to").alias("page")).where(inside & ~label).distinct()
        ahead = to.join(seen.select("page"), "page", "left_anti")
    named = seen.select("page", "place").join(links, "page").select(F.col("to").alias("page"), "place").where(inside & label)
    first = named.groupBy("page").agg(F.min("place").alias("by"))
    labels = placed(first, ["by", "page"], "place", scratch=scratch).where(F.col("place") <= most_labels)
    return seen, labels.select(F.col("page").alias("label"), "place")


def variant_counts(rows: DataFrame, key: str, value: str, wanted: str) -> DataFrame:
    """key, matches: how many elements all arrays named ``wanted`` hold anywhere inside a nested variant value.

    Objects and arrays are opened one level a round, all rows at once, until nothing nested is left; the depth need
    not be known. A ``wanted`` that is no array counts nothing but is searched; its elements are searched too.
    A row without such an array, or with a null value, has 0. ``key`` must be unique and not null.
    """
    scratch = Scratch(rows.sparkSession, "variants")
    level = scratch.keep(rows.select(F.col(key), F.col(value).alias("_v"), F.lit(None).cast("string").alias("_name")), "level-0")
    turn = 0
    while True:
        kind = F.schema_of_variant("_v")
        array, nested = kind.startswith("ARRAY"), kind.startswith("ARRAY") | kind.startswith("OBJECT")
        opened = level.where(F.col("_v").isNotNull() & nested).select(key, (array & (F.col("_name") == wanted)).alias("_hit"), "_v")
        inner = opened.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("_v").outer())).select(key, "_hit", F.col("value").alias("_v"), F.col("key").alias("_name"))
        below = scratch.keep(inner, f"level-{turn + 1}")
        mine = below.where("_hit").groupBy(key).agg(F.count("*").alias("n"))
        mine = scratch.keep(mine, f"counts/part={turn}")
        scratch.drop(f"level-{turn}")
        level, turn = below.select(key, "_v", "_name"), turn + 1
        if not below.head(1):
            break
    counted = rows.sparkSession.read.schema(mine.schema).parquet(f"{scratch.base}/counts").groupBy(key).agg(F.sum("n").alias("matches"))
    return rows.select(key).join(counted, key, "left").select(key, F.coalesce("matches", F.lit(0)).alias("matches"))


def merkle_roots(leaves: DataFrame, keys: list[str], place: str, digest: str, join) -> DataFrame:
    """keys and ``root`` of the hash tree over each block's leaves in the order of ``place``, which counts from 0.

    A level is one grouping by half a place, so a block of any size is spread over the cluster and n leaves take
    log2 n rounds. ``join`` makes a parent of two digests; the last of an odd level meets itself; a single leaf is its
    own root. Places must count without gaps; a block without leaves has no row.
    """
    scratch = Scratch(leaves.sparkSession, "merkle")
    level = leaves.select(*keys, F.col(place).cast("long").alias("_p"), F.col(digest).alias("root"))
    level = level.join(level.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_p").alias("_low"), F.max("_p").alias("_high")), keys)
    gaps = F.raise_error(F.lit("the places of a block must count from 0 without gaps"))
    level = scratch.keep(level.select(*keys, "_p", F.when((F.col("_low") == 0) & (F.col("_high") == F.col("_n") - 1), F.col("_n")).otherwise(gaps).cast("long").alias("_n"), "root"), "level-0")
    done, turn = level.where("_n = 1").select(*keys, "root"), 0
    while (open_blocks := level.where("_n > 1")).head(1):
        pairs = open_blocks.groupBy(*keys, F.expr("_p div 2").alias("_p"), F.expr("(_n + 1) div 2").alias("_n"))
        level = scratch.keep(pairs.agg(join(F.min_by("root", "_p"), F.max_by("root", "_p")).alias("root")).select(*keys, "_p", "_n", "root"), f"level-{turn + 1}")
        done, turn = done.unionByName(level.where("_n = 1").select(*keys, "root")), turn + 1
    return done
