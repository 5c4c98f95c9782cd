"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of every ``length``-word window the smallest ``k``-word gram, so
windows that are equal share an anchor at the same offset, and about two words in
``length - k + 2`` carry one. Documents meet on equal anchors. An anchor extends both ways over
all windows that chose it (its region): regions that agree whole are repeats at once; only
where the regions of one anchor differ, at the ends of a shared passage, are the single windows
compared. Overlapping repeats then merge into the maximal ones.

Documents meet in the anchor, not in pairs: anchors are counted with partial aggregation, and an
anchor, region or window that more than a small share of the rows has meets its rows in a
broadcast join (see ``meet``), so a passage that a third of all documents share is dealt over
all tasks. The windows that an anchor extends to are compared by 64-bit hashes of their words,
and only with windows of the same anchor.

Defined results: a null text has no words; a text of fewer than ``length`` words loses none;
a repeated row repeats all its windows; windows may overlap their own copy in the same text; an
empty table has no rows; columns not named in ``also`` are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import Scratch, meet, tune
from tallyforge.llm.passages import find_regions, numbered, spread_windows, with_spans


def repeats(rows: DataFrame, length: int, k: int, scratch: Scratch) -> DataFrame:
    """rid, start, stop (words) of the repeats, not yet merged, for (rid, text) rows that can be read again."""
    anchors = scratch.keep(find_regions(rows, length, k).select("rid", "start", "count", "gram", "region"), "anchors")
    seen = anchors.groupBy("gram").agg(F.count("*").alias("n"), F.min("region").alias("lo"), F.max("region").alias("hi")).where("n > 1")
    seen = scratch.keep(seen.select("gram", "n", (F.col("lo") == F.col("hi")).alias("same")), "seen")
    met = scratch.keep(meet(anchors, seen, ["gram"], "n", anchors.count()).select("rid", "start", "count", "gram", "region", "same"), "met")
    scratch.drop("anchors")
    odd = met.where("not same")
    groups = scratch.keep(odd.groupBy("gram", "region").agg(F.count("*").alias("n"), F.min(F.struct("rid", "start", "count")).alias("one")), "groups")
    wanted = groups.select("one.*", "gram", F.least("n", F.lit(2)).cast("int").alias("weight"))
    windows = scratch.keep(spread_windows(rows, wanted, length), "windows")
    again = scratch.keep(windows.groupBy("gram", "window").agg(F.sum("weight").alias("n")).where("n > 1"), "again")
    span = (F.col("start") + F.col("count") + (length - 1)).alias("stop")
    alike = meet(odd, groups.where("n > 1").select("gram", "region", "n"), ["gram", "region"], "n", odd.count())
    single = meet(windows.where("weight = 1"), again, ["gram", "window"], "n", windows.agg(F.sum("weight")).first()[0] or 0)
    found = met.where("same").select("rid", "start", span).unionByName(alike.select("rid", "start", span)).unionByName(single.select("rid", "start", (F.col("start") + length).alias("stop")))
    kept = scratch.keep(found, "repeats")
    for name in ("seen", "met", "groups", "windows", "again"):
        scratch.drop(name)
    return kept


def drop_repeats(docs: DataFrame, *, length: int = 35, k: int = 8, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = (), text_out: bool = False) -> DataFrame:
    """Every text without the words of its repeats of ``length`` words or more.

    Digest rows (doc_id, n_words, n_removed, n_spans, spans, kept_sha256), or with ``text_out``
    doc_id, the columns named in ``also``, the cut text and n_removed.
    """
    tune(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    rows = scratch.keep(numbered(docs, {"doc_id": id_col, "text": text_col, **{c: c for c in also}}), "rows")
    return with_spans(rows, repeats(rows, length, k, scratch), ["doc_id", *also], text_out=text_out)
