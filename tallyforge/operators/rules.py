"""Rules kept as a table: each holds where a text contains all of its needles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.session import Scratch, ship

#: Characters of needles that go into one automaton; more rules are met in several passes.
NEEDLE_CHARS = 1 << 22


def rules_met(docs: DataFrame, rules: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rule_col: str = "rule_id", needles_col: str = "needles") -> DataFrame:
    """id_col, rules (sorted array of the rules that hold) of every text; upper and lower case are alike.

    One automaton holds all needles, so a text is read once however many rules there are. The needles found in it
    count towards their rules, and a rule holds that has all of its own: work grows with what is found, not with
    rules times texts. A rule without needles, or with empty ones alone, holds everywhere; repeated needles count once; a rule
    whose needles hold a null never holds, and one without a name is none; a null text is an empty one. Rules of one name are one rule, which
    holds if any of them does. Rules come to the driver in blocks of a bounded size.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"))
    needles = F.array_sort(F.array_distinct(F.filter(F.transform(needles_col, F.lower), lambda n: n != "")))
    wanted = rules.where(F.col(rule_col).isNotNull() & ~F.exists(needles_col, lambda n: n.isNull())).select(F.col(rule_col).cast("string").alias("rule"), needles.alias("needles")).distinct()
    sized = wanted.withColumn("chars", F.coalesce(F.aggregate("needles", F.lit(0), lambda a, n: a + F.length(n)), F.lit(0)) + 1)
    total = sized.agg(F.sum("chars")).first()[0] or 0
    blocks = max(1, -(-total // NEEDLE_CHARS))
    rows = texts.select(F.monotonically_increasing_id().alias("_row"), id_col, "_t")
    if blocks > 1:  # each row keeps its number from pass to pass
        rows = Scratch(docs.sparkSession, "rules").keep(rows, "texts")
    out = None
    for k in range(blocks):
        mine = sized.where(F.pmod(F.xxhash64("rule", "needles"), F.lit(blocks)) == k)
        part = _met(rows, sorted((r.rule, tuple(r.needles)) for r in mine.collect()), id_col)
        out = part if out is None else out.unionByName(part)
    if blocks > 1:
        out = out.groupBy("_row", id_col).agg(F.flatten(F.collect_list("rules")).alias("rules"))
    return out.select(id_col, F.array_sort(F.array_distinct("rules")).alias("rules"))


def _met(rows: DataFrame, rules: list[tuple[str, tuple[str, ...]]], id_col: str) -> DataFrame:
    number: dict[str, int] = {}
    owners: list[list[int]] = []
    for at, (_, needles) in enumerate(rules):
        for n in needles:
            if n not in number:
                number[n] = len(number)
                owners.append([])
            owners[number[n]].append(at)
    need = np.array([len(n) for _, n in rules], np.int64)
    names = [r for r, _ in rules]
    always = [names[i] for i in np.flatnonzero(need == 0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for needle, at in number.items():
            automaton.add_word(needle, at)
        automaton.make_automaton()
        for b in batches:
            found = []
            for t in b.column(2).to_pylist():
                hits = {at for _, at in automaton.iter(t)} if number else ()
                met = [r for at in hits for r in owners[at]]
                rule, count = np.unique(np.array(met, np.int64), return_counts=True)
                found.append([*always, *(names[r] for r in rule[count == need[rule]])])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.string()))], ["_row", id_col, "rules"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"_row long, `{id_col}` {kind}, rules array<string>")
