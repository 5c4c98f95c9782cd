"""Connected components of an edge table by alternating large-star and small-star steps, in Spark throughout.

A node with very many neighbours meets its least neighbour in a broadcast join (see ``meet``), so no
task has to take all its edges. Defined results: null ends and loops are no edges, repeated edges
count once, an empty table has no components, other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, meet


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """(u, v, m) of every edge, m being the least v of its u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k"))
    return meet(edges, least, ["u"], "k", total).drop("k")


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, 2 * total).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    moved = _with_least(down, total).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
    return moved.select("e.*").where("u != v").distinct()


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node of the (u, v) edges, the root being the smallest node of its component."""
    state, turn, before = scratch.keep(edges.select("u", "v").where("u != v").distinct(), f"{name}-0"), 0, None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before, turn = mark, turn + 1
        # every edge of a small star has a large star's edges behind it, never more than these
        state = scratch.keep(_small_star(_large_star(state, mark[0]), mark[0]), f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
