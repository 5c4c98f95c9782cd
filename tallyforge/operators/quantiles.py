"""Exact quantiles and distinct values of groups of any size, with a bounded state for each group."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.session import Scratch, ship

#: Bins of a round, and how many values may at last be gathered to find one of them.
BINS, GATHER = 1024, 4096
LARGEST = sys.float_info.max


def _same(keys: list[str], other: str) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(f"rows.{k}").eqNullSafe(F.col(f"{other}.{k}"))
    return test


def quantiles(df: DataFrame, keys: list[str], values: list[str], shares: list[float], *, gather: int = GATHER) -> DataFrame:
    """keys, and for each value column an array of its quantiles by linear interpolation, as ``percentile`` gives them.

    A wanted rank is narrowed down by histograms: each round counts the values between the bounds it has so far, in
    bins between the lowest and the highest of them, and takes the bin that holds the rank. When at most ``gather`` values are left
    between the bounds (or they are all equal) these are sorted. So a group's state is its bins, however many rows it has,
    and each round shuffles bins, not rows. Values are compared as doubles; nulls and NaN are left out, infinite
    ones count as the largest double, and a group without values has no row. Null keys are groups like others.
    """
    scratch = Scratch(df.sparkSession, "quantiles")
    doubles = (F.col(v).cast("double") for v in values)
    column = F.posexplode(F.array(*(F.when(F.isnan(v), v).otherwise(F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(LARGEST)), F.lit(-LARGEST)))) for v in doubles))).alias("_c", "_v")
    rows = df.select(*keys, column).where("_v is not null and not isnan(_v)")
    by = [*keys, "_c"]
    facts = scratch.keep(rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "facts")
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(h), F.ceil(h)) for s in shares for h in [(F.col("_n") - 1) * F.lit(s)]))))
    state = scratch.keep(facts.select(*by, F.explode(ranks).alias("_rank"), "_n", "_lo", "_hi").withColumn("_at", F.col("_rank")), "round-0")
    turn = 0
    while (wide := state.where((F.col("_n") > gather) & (F.col("_lo") < F.col("_hi")))).head(1):
        spans = wide.select(*by, "_lo", "_hi").distinct().alias("spans")
        met = rows.alias("rows").join(spans, _same(by, "spans") & F.col("_v").between(F.col("_lo"), F.col("_hi")))
        half = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        share = F.when(F.col("_hi") - F.col("_lo") < LARGEST, (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(half)
        cells = met.select(*(F.col(f"rows.{k}").alias(k) for k in by), "_lo", "_hi", "_v", F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("_bin"))
        cells = cells.groupBy(*by, "_lo", "_hi", "_bin").agg(F.count("*").alias("_k"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        earlier = W.partitionBy(*by, "_lo", "_hi").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
        cells = cells.withColumn("_before", F.coalesce(F.sum("_k").over(earlier), F.lit(0))).alias("rows")
        held = F.col("wide._at").between(F.col("_before"), F.col("_before") + F.col("_k") - 1)
        found = cells.join(wide.alias("wide"), _same([*by, "_lo", "_hi"], "wide") & held)
        narrow = found.select(*(F.col(f"wide.{k}").alias(k) for k in by), "_rank", F.col("_k").alias("_n"), F.col("_low").alias("_lo"), F.col("_high").alias("_hi"), (F.col("_at") - F.col("_before")).alias("_at"))
        done = state.where((F.col("_n") <= gather) | (F.col("_lo") == F.col("_hi")))
        state = scratch.keep(done.unionByName(narrow), f"round-{turn + 1}")
        scratch.drop(f"round-{turn}")
        turn += 1
    few = state.where(F.col("_lo") < F.col("_hi")).select(*by, "_lo", "_hi").distinct().alias("spans")
    met = rows.alias("rows").join(few, _same(by, "spans") & F.col("_v").between(F.col("_lo"), F.col("_hi")))
    lists = met.groupBy(*(F.col(f"rows.{k}").alias(k) for k in by), "_lo", "_hi").agg(F.sort_array(F.collect_list("_v")).alias("_all")).alias("rows")
    at = state.alias("state").join(lists, _same([*by, "_lo", "_hi"], "state"), "left")
    known = at.select(*(F.col(f"state.{k}").alias(k) for k in by), F.struct("_rank", F.coalesce(F.get("_all", F.col("_at").cast("int")), F.col("state._lo")).alias("v")).alias("_e"))
    maps = known.groupBy(*by).agg(F.map_from_entries(F.collect_list("_e")).alias("_m")).alias("rows")
    maps = maps.join(facts.alias("facts"), _same(by, "facts")).select(*(F.col(f"rows.{k}").alias(k) for k in by), "_m", "_n")

    def share_of(s: float) -> Column:
        h = (F.col("_n") - 1) * F.lit(s)
        low, high = F.element_at("_m", F.floor(h)), F.element_at("_m", F.ceil(h))
        return F.when(low == high, low).otherwise((F.ceil(h) - h) * low + (h - F.floor(h)) * high)

    each = maps.select(*by, F.array(*map(share_of, shares)).alias("_q"))
    wanted = [F.max(F.when(F.col("_c") == i, F.col("_q"))).alias(v) for i, v in enumerate(values)]
    return each.groupBy(*keys).agg(*wanted)


def bounded_distinct(df: DataFrame, keys: list[str], value: str, *, capacity: int = 256) -> DataFrame:
    """keys, kinds, overflow, values: a group's distinct values, sorted, or no values and ``overflow`` where there are more than ``capacity``.

    Every task keeps at most ``capacity`` + 1 values of a group and sends these on; they are merged group by group in
    the same way, as a stream that is sorted by group. ``kinds`` is at most ``capacity`` + 1. Nulls are no values, a group of nulls
    has none; null keys are groups like others.
    """
    ship(df.sparkSession)
    rows = df.select(*keys, F.col(value).alias("_v"))
    kinds = dict(rows.dtypes)
    shape = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"_s array<{kinds['_v']}>", "_full boolean"])
    names = [*keys, "_s", "_full"]

    def told(states: dict[tuple, set | None], types: list[pa.DataType]) -> pa.RecordBatch:
        columns = [pa.array([k[i] for k in states], types[i]) for i in range(len(keys))]
        lists = pa.array([None if s is None else sorted(s) for s in states.values()], pa.list_(types[-1]))
        return pa.RecordBatch.from_arrays([*columns, lists, pa.array([s is None for s in states.values()])], names)

    def add(states: dict[tuple, set | None], key: tuple, more) -> None:
        held = states.setdefault(key, set())
        if held is not None:
            held.update(more)
            if len(held) > capacity:
                states[key] = None

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, types = {}, None
        for b in batches:
            types = [f.type for f in b.schema]
            pairs = pa.Table.from_batches([b]).group_by(b.schema.names).aggregate([]).to_pylist()
            for r in pairs:
                *key, v = r.values()
                add(states, tuple(key), () if v is None else (v,))
            if len(states) > GATHER:  # whatever was gathered may be sent on at any time
                yield told(states, types)
                states = {}
        if states:
            yield told(states, types)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, types = {}, None
        for b in batches:
            types = [*(b.schema.field(i).type for i in range(len(keys))), b.schema.field(len(keys)).type.value_type]
            for *key, values, full in zip(*(c.to_pylist() for c in b.columns), strict=True):
                key = tuple(key)
                if key not in states and len(states) > GATHER:  # sorted by group, so all but the last are complete
                    yield told(states, types)
                    states = {}
                if full:
                    states[key] = None
                else:
                    add(states, key, values)
        if states:
            yield told(states, types)

    partial = rows.mapInArrow(gathered, shape)
    dealt = (partial.repartition(*keys).sortWithinPartitions(*keys) if keys else partial.coalesce(1)).mapInArrow(merged, shape)
    n = F.when(F.col("_full"), F.lit(capacity + 1)).otherwise(F.size("_s")).cast("bigint")
    return dealt.select(*keys, n.alias("kinds"), F.col("_full").alias("overflow"), F.col("_s").alias("values"))
