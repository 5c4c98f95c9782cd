"""Text functions that Spark has no expression for, as Arrow-batched functions."""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def strip_accents(texts: pd.Series) -> pd.Series:
    """Canonically decomposed, combining marks left out; null stays null."""

    def one(t):
        return None if t is None else t if t.isascii() else "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")

    return texts.map(one, na_action="ignore")


@F.pandas_udf(T.DoubleType())
def packed_ratio(data: pd.Series) -> pd.Series:
    """Compressed size by size at level 9; null where there is nothing."""
    return data.map(lambda b: len(zlib.compress(b, 9)) / len(b) if b else None)


def word_pieces(vocabulary: dict[str, int], unknown: int, longest: int = 100) -> Callable[[Column], Column]:
    """A column function that codes a word greedily, longest piece first; pieces inside a word start with ##."""

    def code(word: str) -> list[int]:
        if len(word) > longest:
            return [unknown]
        out, at = [], 0
        while at < len(word):
            for end in range(len(word), at, -1):
                if (found := vocabulary.get(word[at:end] if not at else "##" + word[at:end])) is not None:
                    out.append(found)
                    at = end
                    break
            else:
                return [unknown]
        return out

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def coded(words: pd.Series) -> pd.Series:
        return words.map(lambda w: [] if w is None else code(w))

    return coded


def code_units(text: Column) -> Column:
    """The 16-bit code units of a text, surrogates apart."""
    data = F.hex(F.encode(text, "UTF-16LE"))
    n = (F.length(data) / 4).cast("int")
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.conv(F.concat(F.substr(data, i * 4 + 3, F.lit(2)), F.substr(data, i * 4 + 1, F.lit(2))), 16, 10).cast("int"))
