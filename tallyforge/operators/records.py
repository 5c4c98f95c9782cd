"""Natural records: tables unpivoted to series, series grouped to records, records audited."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyforge.operators.quantiles import quantiles
from tallyforge.operators.ranks import placed
from tallyforge.session import Scratch


def unpivot(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys, series_id, value."""
    return df.unpivot(keys, values, "series_id", "value")


def record_index(long: DataFrame, record: str, element_bytes: int = 8) -> DataFrame:
    """One row per (series, record): its count of values, bytes, and distinct values."""
    return long.groupBy("series_id", F.col(record).alias("record")).agg(
        F.count("value").alias("value_count"),
        (F.count("value") * element_bytes).alias("sample_bytes"),
    )


def acceptance(index: DataFrame, keys: list[str], *, min_values: int, min_bytes: int, min_median: int, either: bool = True) -> DataFrame:
    """Totals, exact median and status of every dataset of a record index; ``either``: one of the two totals is enough."""
    enough = (F.col("total_values") >= min_values, F.col("total_bytes") >= min_bytes)
    total = enough[0] | enough[1] if either else enough[0] & enough[1]
    sums = index.groupBy(*keys).agg(
        F.count("*").alias("samples"),
        F.sum("value_count").alias("total_values"),
        F.sum("sample_bytes").alias("total_bytes"),
        F.median("value_count").alias("median_values"),
        F.min("value_count").alias("min_values"),
        F.max("value_count").alias("max_values"),
    )
    reasons = F.filter(
        F.array(F.when(~total, F.lit("total_below_floor")), F.when(F.col("median_values") < min_median, F.lit("median_below_floor"))),
        lambda r: r.isNotNull(),
    )
    return sums.withColumn("reasons", F.array_join(reasons, ",")).withColumn("status", F.when(F.col("samples") == 0, "broken").when(F.col("reasons") == "", "ok").otherwise("below_floor"))


def distribution(index: DataFrame, keys: list[str], value: str = "value_count") -> DataFrame:
    """Percentiles by linear interpolation, mode share and extremes, with a bounded state for each group."""
    shares = [0.1, 0.25, 0.5, 0.75, 0.9]
    index = Scratch(index.sparkSession, "distribution").keep(index.select(*keys, value), "index")  # read once a round
    spread = quantiles(index, keys, [value], shares)
    counts = index.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    sums = counts.groupBy(*keys).agg(
        F.sum("_n").alias("samples"),
        F.sum(F.col(value) * F.col("_n")).alias("total"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        (F.max("_n") / F.sum("_n")).alias("mode_share"),
    )
    met = sums.join(spread, keys)
    return met.select(*keys, "samples", "total", "low", "high", *(F.col(value)[i].alias(f"p{int(q * 100)}") for i, q in enumerate(shares)), "mode_share")


def degenerate(long: DataFrame, keys: list[str], value: str = "value", sparse: float = 0.001) -> DataFrame:
    """empty, constant, binary_sparse or ok, per series; counted by value first, so that hot values combine early."""
    counts = long.groupBy(*keys, value).agg(F.count(value).alias("n"))
    facts = counts.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value_count"), F.count(F.when(F.col("n") > 0, 1)).alias("distinct_values"), F.min(F.when(F.col("n") > 0, F.col("n"))).alias("least"))
    status = (
        F.when(F.col("value_count") == 0, "empty")
        .when(F.col("distinct_values") == 1, "constant")
        .when((F.col("distinct_values") == 2) & (F.col("least") / F.col("value_count") < sparse), "binary_sparse")
        .otherwise("ok")
    )
    return facts.select(*keys, "value_count", "distinct_values", status.alias("status"))


def rejected(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """The rows with ``reason``: the first reason in order that holds, or accepted."""
    reason = F.lit("accepted")
    for name, test in reversed(reasons.items()):
        reason = F.when(F.coalesce(test, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("reason", reason)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return keep_first(df, keys, [F.desc(c) for c in order])


def dictionary(df: DataFrame, value: str, first_seen: str | None = None, capacity: int | None = 65_535) -> DataFrame:
    """value, code (from 1; 0 is for missing): in the order of first appearance, or sorted.

    More distinct values than ``capacity`` are an error; None sets no bound, and codes are then longs. Values are
    sorted and numbered over the cluster, so any number of them may be coded.
    """
    rows = df.where(F.col(value).isNotNull())
    seen = rows.groupBy(value).agg(F.min(first_seen).alias("_o")) if first_seen else rows.select(value).distinct()
    coded = placed(seen, ["_o", value] if first_seen else [value], "_c")
    if capacity is None:
        return coded.select(value, F.col("_c").alias("code"))
    checked = F.when(F.col("_c") <= capacity, F.col("_c").cast("int")).otherwise(F.raise_error(F.lit(f"more than {capacity} values in {value}")).cast("int"))
    return coded.select(value, checked.alias("code"))


def shards(df: DataFrame, keys: list[str], order: list[str], size: int) -> DataFrame:
    """shard and offset within it of every row in its group's order."""
    at = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("_at", at).withColumn("shard", F.floor(F.col("_at") / size)).withColumn("offset", F.col("_at") % size).drop("_at")


def accepted(manifest: DataFrame, index: DataFrame, *, min_values: int, min_bytes: int, min_median: float) -> DataFrame:
    """The acceptance report: one row a dataset of the manifest, by status, sizes and id.

    index: dataset_id, series_id, value_count, sample_bytes, role, inferred. A dataset without
    primary samples is broken, whether its index is missing or holds auxiliary ones alone.
    """
    primary = F.col("role") == "primary"
    of = lambda c, mine: F.when(mine, F.col(c))
    sums = index.groupBy("dataset_id").agg(
        *(F.sum(of(c, m)).alias(f"{r}_{n}") for r, m in (("primary", primary), ("auxiliary", ~primary)) for c, n in (("value_count", "values"), ("sample_bytes", "sample_bytes"))),
        F.count_if(primary).alias("primary_sample_rows"),
        F.count_if(~primary).alias("auxiliary_sample_rows"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("inferred"), F.col("series_id")))), ",").alias("inferred"),
        F.lit(True).alias("has_index"),
    )
    middle = quantiles(index.where(primary), ["dataset_id"], ["value_count", "sample_bytes"], [0.5])
    middle = middle.select("dataset_id", F.col("value_count")[0].alias("median_primary_sample_value_count"), F.col("sample_bytes")[0].alias("median_primary_sample_size_bytes"))
    sums = sums.join(middle, "dataset_id", "left")
    numbers = ["primary_values", "primary_sample_bytes", "primary_sample_rows", "median_primary_sample_value_count", "median_primary_sample_size_bytes", "auxiliary_values", "auxiliary_sample_bytes", "auxiliary_sample_rows"]
    rows = manifest.join(sums, "dataset_id", "left").fillna(0, numbers).fillna(False, ["has_index"])
    low = F.when((F.col("primary_values") < min_values) & (F.col("primary_sample_bytes") < min_bytes), "aggregate_floor")
    reasons = F.when(F.col("primary_sample_rows") == 0, "missing_primary_payload").otherwise(F.concat_ws(",", low, F.when(F.col("median_primary_sample_value_count") < min_median, "median_sample_floor")))
    status = F.when(F.col("primary_sample_rows") == 0, "broken").when(F.col("reasons") == "", "ok").otherwise("below_floor")
    none = lambda c: F.when(F.coalesce(c, F.lit("")) == "", "none").otherwise(c)
    rows = rows.withColumn("reasons", reasons)
    out = rows.select("dataset_id", status.alias("status"), *numbers, "has_index", none(F.col("inferred")).alias("inferred_auxiliary_series"), none(F.col("reasons")).alias("failure_reasons"))
    return out.orderBy("status", "primary_values", "primary_sample_bytes", "median_primary_sample_value_count", "median_primary_sample_size_bytes", "dataset_id")


def state(manifest: DataFrame, index: DataFrame, *, min_values: int, min_bytes: int, min_median: float, max_bytes: int) -> DataFrame:
    """The state report: a row for every series of a dataset, with the dataset's status and reasons.

    index: dataset_id, series_id, sample, value_count, sample_bytes, role, path, missing,
    numeric_kind, bit_width. A dataset of the manifest without any row is not_built.
    """
    shares, names = [0.1, 0.25, 0.5, 0.75, 0.9], ["p10", "p25", "median", "p75", "p90"]
    keys = ["dataset_id", "series_id"]

    def spread(c: str, n: str) -> list[Column]:
        return [F.min(c).alias(f"min_{n}"), F.max(c).alias(f"max_{n}")]

    series = index.groupBy(*keys).agg(
        F.first("role").alias("role"),
        F.array_join(F.array_sort(F.collect_set("numeric_kind")), ",").alias("numeric_kind"),
        F.array_join(F.array_sort(F.collect_set("bit_width")).cast("array<string>"), ",").alias("bit_width"),
        F.count("*").alias("samples"),
        F.sum("value_count").alias("values_total"),
        F.sum("sample_bytes").alias("bytes_total"),
        *spread("value_count", "values"),
        *spread("sample_bytes", "bytes"),
        F.min_by("path", "sample").alias("first_sample_path"),
        F.count_if("missing").alias("missing_files"),
    )
    inner = quantiles(index, keys, ["value_count", "sample_bytes"], shares).select(*keys, F.col("value_count").alias("_values"), F.col("sample_bytes").alias("_bytes"))
    modes = index.groupBy(*keys, "sample_bytes").agg(F.count("*").alias("n")).groupBy(*keys).agg((F.max("n") / F.sum("n")).alias("same_size_fraction"))
    mine = lambda c: F.when(F.col("role") == "primary", F.col(c))
    whole = index.groupBy("dataset_id").agg(F.sum(mine("value_count")).alias("v"), F.sum(mine("sample_bytes")).alias("b"), F.count(mine("sample_bytes")).alias("n"), F.bool_or("missing").alias("gone"))
    middle = quantiles(index.where("role = 'primary'"), ["dataset_id"], ["value_count"], [0.5]).select("dataset_id", F.col("value_count")[0].alias("m"))
    whole = whole.join(middle, "dataset_id", "left")
    at = lambda c: F.coalesce(F.col(c), F.lit(0))
    tests = {"missing_primary_payload": F.col("n") == 0, "value_floor": at("v") < min_values, "byte_floor": at("b") < min_bytes, "median_sample_floor": at("m") < min_median, "primary_size_cap": F.col("b") > max_bytes, "missing_sample_files": F.col("gone")}
    reasons = F.concat_ws(",", *(F.when(c, k) for k, c in tests.items()))
    built = whole.select("dataset_id", reasons.alias("reasons"))
    status = F.when(F.col("reasons").isNull(), "not_built").when(F.col("reasons") == "", "ok").otherwise("needs_attention")
    rows = manifest.join(built, "dataset_id", "left").join(series.join(modes, keys).join(inner, keys), "dataset_id", "left")
    flat = [F.col(f"_{n}")[i].alias(f"{p}_{n}") for n in ("values", "bytes") for i, p in enumerate(names)]
    kept = [c for c in series.columns if not c.startswith("_") and c != "dataset_id"]
    return rows.select("dataset_id", status.alias("status"), F.coalesce("reasons", F.lit("missing_sample_index")).alias("reasons"), *kept, *flat, "same_size_fraction")


def against_paths(registry: DataFrame, paths: DataFrame, key: str, status: str, active: str) -> DataFrame:
    """(key, finding) where a registry's status disagrees with the paths that exist; both sides have one row a key."""
    marked = registry.select(key, F.col(status).alias("_status")).join(paths.select(key, F.lit(True).alias("_path")), key, "full")
    there = F.col("_path").isNotNull()
    finding = F.when(F.col("_status").isNull(), "path_without_row").when((F.col("_status") == active) & ~there, f"{active}_without_path").when((F.col("_status") != active) & there, F.concat("_status", F.lit("_with_path")))
    return marked.select(key, finding.alias("finding")).where("finding is not null")


def benchmark(index: DataFrame, key: str, *, min_values: int, min_bytes: int, min_median: float, max_bytes: int) -> DataFrame:
    """A row a ``key`` with its samples' sizes, how alike they are, and reasons against them; samples without a file only count as missing.

    index: key, dataset_id, value_count, sample_bytes, missing. A key none of whose samples has a file is left out.
    """
    there = index.where(~F.col("missing"))
    sums = there.groupBy(key, "sample_bytes", "dataset_id").agg(F.count("*").alias("n"), F.sum("value_count").alias("v"))
    sizes = sums.groupBy(key, "sample_bytes").agg(F.sum("n").alias("n")).groupBy(key).agg(F.count("*").alias("unique_sample_sizes"), (F.max("n") / F.sum("n")).alias("same_size_fraction"))
    facts = sums.groupBy(key).agg(
        F.count_distinct("dataset_id").alias("datasets"),
        F.sum("n").alias("samples"),
        F.sum("v").alias("total_values"),
        F.sum(F.col("sample_bytes") * F.col("n")).alias("total_bytes"),
        F.min("sample_bytes").alias("low"),
        F.max("sample_bytes").alias("high"),
    )
    shares = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
    spread = quantiles(there, [key], ["sample_bytes", "value_count"], list(shares.values()))
    gone = index.groupBy(key).agg(F.count_if("missing").alias("missing_files"))
    rows = facts.join(sizes, key).join(spread, key).join(gone, key)
    against = {
        "missing_sample_files": F.col("missing_files") > 0,
        "value_floor": F.col("total_values") < min_values,
        "byte_floor": F.col("total_bytes") < min_bytes,
        "median_sample_floor": F.col("value_count")[2] < min_median,
        "primary_size_cap": F.col("total_bytes") > max_bytes,
        "identical_sample_sizes": F.col("unique_sample_sizes") < 2,
    }
    reasons = F.concat_ws(",", *(F.when(test, name) for name, test in against.items()))
    kept = [key, "datasets", "samples", "total_values", "total_bytes", "low", *(F.col("sample_bytes")[i].alias(n) for i, n in enumerate(shares)), "high", "unique_sample_sizes", "same_size_fraction", "missing_files"]
    return rows.select(*kept, reasons.alias("reasons")).withColumn("status", F.when(F.col("reasons") == "", "ok").otherwise("needs_attention"))


def eligibility(rows: DataFrame, keys: list[str], order: str, time: str, value: str, *, least: int) -> DataFrame:
    """A profile of each series as one of unsigned bytes, and whether it is ``selected``.

    A series is selected with ``least`` rows or more, all of whose values are whole and within 0 to 255, whose times never fall
    in the given order (a null time is no fall, and is passed over) and which has more than one value. An empty table has no series.
    """
    v = F.col(value)
    whole = F.coalesce(v == F.floor(v), F.lit(False))
    byte = whole & v.between(0, 255)
    before = F.last(time, ignorenulls=True).over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    facts = rows.withColumn("_falls", F.coalesce(F.col(time) < before, F.lit(False))).groupBy(*keys)
    sums = facts.agg(
        F.count("*").alias("observations"),
        F.count(v).alias("numeric_values"),
        F.count_if(whole).alias("integer_values"),
        F.min(v).alias("minimum"),
        F.max(v).alias("maximum"),
        F.count_distinct(F.when(byte, v.cast("int"))).alias("distinct_bytes"),
        (~F.bool_or("_falls")).alias("monotonic"),
        F.bool_and(byte).alias("complete"),
    )
    return sums.withColumn("selected", (F.col("observations") >= least) & F.col("complete") & F.col("monotonic") & (F.col("distinct_bytes") > 1))
