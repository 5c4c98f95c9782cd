"""Column functions that read numbers, times and labels out of untidy text; what does not fit is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def safe_float(text: Column) -> Column:
    """A finite double; suffixes such as 1d or 1.0f, which a plain cast takes, do not count as numbers."""
    number = F.trim(text).try_cast("double")
    return F.when(F.trim(text).rlike(NUMBER) & (F.abs(number) < F.lit(float("inf"))), number)


def safe_integral(text: Column) -> Column:
    """A 64-bit integer from decimal text whose value is whole."""
    exact = F.trim(text).try_cast("decimal(38,10)")
    return F.when(F.trim(text).rlike(NUMBER) & (exact == F.floor(exact)), exact.try_cast("decimal(38,0)").try_cast("bigint"))


def truncated(text: Column) -> Column:
    """The whole part, toward zero."""
    return safe_float(text).try_cast("bigint")


def decimal_comma(text: Column) -> Column:
    return safe_float(F.replace(text, F.lit(","), F.lit(".")))


def suffixed(text: Column) -> Column:
    """10.00K, 2M, 1.5B as numbers."""
    scale = F.upper(F.regexp_extract(text, r"([KkMmBb])$", 1))
    by = F.when(scale == "K", 1e3).when(scale == "M", 1e6).when(scale == "B", 1e9).otherwise(1.0)
    return safe_float(F.regexp_replace(text, r"[KkMmBb]$", "")) * by


def scaled(value: Column, factor: int) -> Column:
    """Fixed point, half to even."""
    return F.bround(value * factor).cast("bigint")


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def strict_bool(json: Column, path: str) -> Column:
    """1 or 0 for a JSON boolean, null for anything else, numbers and quoted words too."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant"))
    value = F.get_json_object(json, path)
    return F.when((kind == "BOOLEAN") & (value == "true"), 1).when((kind == "BOOLEAN") & (value == "false"), 0)


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def snake(text: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(text, "([A-Z]+)([A-Z][a-z])", "$1_$2"), "([a-z0-9])([A-Z])", "$1_$2"))


def ordinal_day(date: Column) -> Column:
    """Days counted from 1 on 1 January of year 1."""
    return F.date_diff(date, F.lit("0001-01-01").cast("date")) + 1


def packed_date(date: Column) -> Column:
    return F.year(date) * 10_000 + F.month(date) * 100 + F.dayofmonth(date)


def month_ordinal(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def clock_seconds(text: Column) -> Column:
    """h:m:s as seconds, hours without a bound."""
    parts = F.split(text, ":")
    return parts[0].cast("int") * 3600 + parts[1].cast("int") * 60 + parts[2].cast("int")


def full_year(short: Column, pivot: int = 70) -> Column:
    return F.when(short >= 100, short).when(short >= pivot, short + 1900).otherwise(short + 2000)


def short_digest(*columns: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("\t", *columns)), 1, 8)


def file_name(text: Column, most: int) -> Column:
    """What is safe in a file name; every run of other characters becomes one underscore."""
    return F.substring(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", ""), 1, most)


def iso_seconds(text: Column) -> Column:
    """Seconds since 1970 of an ISO date and time, which is UTC where it names no offset; other texts are null."""
    shape = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"
    whole = F.when(text.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(shape), F.unix_seconds(whole.try_cast("timestamp")))


def with_exponent(mantissa: Column, exponent: Column) -> Column:
    """The double nearest to mantissa x 10^exponent, both decimal text."""
    return safe_float(F.concat(F.trim(mantissa), F.lit("e"), F.trim(exponent)))


def integers(line: Column) -> Column:
    """The numbers of a line of space-separated integers."""
    return F.transform(F.filter(F.split(F.trim(line), "[ \\t]+"), lambda x: x != ""), lambda x: x.cast("bigint"))


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def from_keyed(rows: DataFrame, body: str, kind: str) -> DataFrame:
    """Rows of (key, value) of a JSON object whose keys are data; text that is no object has none."""
    return rows.select(*(c for c in rows.columns if c != body), F.explode(F.from_json(body, f"map<string,{kind}>")).alias("key", "value"))


def spread_tiles(across: Column, down: Column, most: Column | int) -> Column:
    """Up to ``most`` tiles of a grid: an array of (tile, x, y) at the nine quarter points, row by row.

    Halves go to the even tile. Points keep off the border where a side has more than two tiles; of points that fall
    on one tile the first stays. A grid without tiles has none.
    """

    def near(quarter: int, side: Column) -> Column:
        edge = F.when(side > 2, 1).otherwise(0)
        return F.least(F.greatest(edge, F.bround(quarter * side / 4, 0).cast("int")), side - 1 - edge)

    points = [F.struct((y * across + x).alias("tile"), x.alias("x"), y.alias("y")) for q in (1, 2, 3) for p in (1, 2, 3) for x, y in [(near(p, across), near(q, down))]]
    none = F.array().cast("array<struct<tile:int, x:int, y:int>>")
    return F.when((across < 1) | (down < 1), none).otherwise(F.slice(F.array_distinct(F.array(*points)), F.lit(1), F.greatest(F.lit(0), F.lit(most) if isinstance(most, int) else most)))
