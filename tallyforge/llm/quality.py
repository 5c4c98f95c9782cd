"""Quality rules as a bitmask ledger, in native DataFrame functions throughout.

``ledger`` measures every text once, evaluates every rule once and stores one bit a rule.
``apply_policy`` is then a bitwise AND with a versioned mask, and ``ablation`` counts what
each rule alone is to blame for, by bitwise aggregation over the stored masks.

Defined results: a null text has no words and fails the base rule; repeated rows are judged
each by itself; an empty table has no rows; ties cannot occur, as nothing is ranked; no window crosses a text's end.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import let, pick

#: Words are separated by the space and U+0009 to U+000D; these count as symbols.
SYMBOLS = "#*$%&|<>"

#: Each rule's bit is its place here; new rules go to the end, so stored masks stay valid.
RULES = ("few_words", "repeated_windows", "symbols", "word_length", "duplicate_lines", "shouting", "long_words")


@dataclass(frozen=True)
class Policy:
    """A version of which rules decide; the rules' thresholds belong to the ledger."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(r) for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = {p.version: p for p in (BASE, Policy("v1", RULES[:5]), Policy("v2", RULES))}


def measured(text: Column) -> Column:
    """A struct of the measurements of one text, each array made once a row."""
    words = F.filter(F.split(text, "[ \\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\x09-\\x0D]"))
    return let(
        words,
        lambda w: let(
            F.array_join(w, ""),
            lambda solid: let(
                lines,
                lambda x: F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    F.length(solid).cast("long").alias("word_chars"),
                    (F.length(solid) - F.length(reduce(lambda c, s: F.replace(c, F.lit(s), F.lit("")), SYMBOLS, solid))).cast("long").alias("n_symbols"),
                    (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                    repeated_words(w).alias("n_repeat_words"),
                    F.size(x).cast("long").alias("n_lines"),
                    F.length(F.regexp_replace(solid, "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"),
                ),
            ),
        ),
    )


def repeated_words(words: Column) -> Column:
    """Words inside a 3-word window that stands twice or more in the text.

    Where the windows' hashes are all distinct, so are the windows, and the count is 0. Else the
    windows are sorted with their places; equal neighbours are the repeated ones, and the
    sorted places of those cover up to three words each.
    """
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    windows = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("w"), i.alias("i")))
    places = let(
        F.sort_array(windows),
        lambda s: F.sort_array(F.filter(s, lambda e, k: F.get(s, k + 1).w.eqNullSafe(e.w) | F.get(s, k - 1).w.eqNullSafe(e.w)).i),
    )
    covered = let(
        places,
        lambda p: F.aggregate(
            F.transform(p, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - i, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda a, m: a + m,
        ),
    )
    none = (F.size(words) < 3) | (F.size(F.array_distinct(hashes)) == F.size(words) - 2)
    return F.when(none, F.lit(0).cast("long")).otherwise(covered)


def failures() -> Column:
    """The failed rules as bits, from the measurements beside them."""
    n, chars = F.col("n_words"), F.col("word_chars")
    tests = (
        n < 50,
        100 * F.col("n_repeat_words") > 50 * n,
        100 * F.col("n_symbols") > 10 * n,
        (chars < 3 * n) | (chars > 10 * n),
        100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
        100 * F.col("n_upper") > 35 * chars,
        chars > 15 * n,
    )
    return sum((F.when(t, F.lit(1 << k)).otherwise(F.lit(0)) for k, t in enumerate(tests)), F.lit(0)).cast("long")


def ledger(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, every measurement, and ``failed``: one bit for each rule of RULES."""
    return pick(docs, id_col, text_col).select("doc_id", measured(F.col("text")).alias("m")).select("doc_id", "m.*").withColumn("failed", failures())


def apply_policy(book: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``base_failed`` and the policy's verdict ``kept``; no rule runs again."""
    base = F.col("failed").bitwiseAND(F.lit(BASE.mask)) != 0
    return book.withColumn("base_failed", base).withColumn("kept", ~base & (F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0))


def ablation(book: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: texts that fail it, and texts that fail it alone and so come back without it."""
    mine = F.col("failed").bitwiseAND(F.lit(policy.mask))
    bits = {r: 1 << RULES.index(r) for r in policy.rules}
    sums = book.agg(
        F.count("*").alias("n"),
        *(F.sum((mine.bitwiseAND(F.lit(b)) != 0).cast("long")).alias(f"any_{r}") for r, b in bits.items()),
        *(F.sum((mine == b).cast("long")).alias(f"alone_{r}") for r, b in bits.items()),
    )
    rows = F.array(*(F.struct(F.lit(policy.version).alias("policy"), F.lit(r).alias("rule"), F.col("n").alias("n_docs"), F.coalesce(F.col(f"any_{r}"), F.lit(0)).alias("n_failed"), F.coalesce(F.col(f"alone_{r}"), F.lit(0)).alias("n_failed_alone")) for r in policy.rules))
    return sums.select(F.inline(rows))


def judge(docs: DataFrame, policy: str = "v2", **columns: str) -> DataFrame:
    """The contract's digest: measurements, base_failed, kept, and the mask itself."""
    return apply_policy(ledger(docs, **columns), POLICIES[policy])
