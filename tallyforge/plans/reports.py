"""The audits in full: acceptance, state of every series, registry, payload rules and verification.

There are no manifests among the tables, so an index of samples is made of line items: a
supplier is a dataset, a return flag a series, a part a sample. Some suppliers have no index,
some only auxiliary samples, and some samples have no file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators import records as R
from tallyforge.operators.quantiles import quantiles
from tallyforge.registry import Tables, query
from tallyforge.session import Scratch

SAMPLES_SQL = """
m AS (SELECT s_suppkey AS dataset_id FROM supplier),
i AS (SELECT l_suppkey AS dataset_id, l_returnflag AS series_id, l_partkey AS sample, count(*) AS value_count, (count(*) * 8 + count(*) FILTER (l_linestatus = 'O') * 2)::BIGINT AS sample_bytes,
      l_returnflag || '/' || l_partkey AS path, l_partkey % 50 = 7 AS missing
      FROM lineitem WHERE l_suppkey % 7 <> 0 AND (l_suppkey % 5 <> 0 OR l_returnflag = 'N') GROUP BY l_suppkey, l_returnflag, l_partkey),
r AS (SELECT 'A' AS series_id, 'primary' AS role),
x AS (SELECT i.*, coalesce(role, CASE WHEN series_id = 'N' THEN 'auxiliary' ELSE 'primary' END) AS role, role IS NULL AND series_id = 'N' AS inferred FROM i LEFT JOIN r USING (series_id))
"""


def manifest(t: Tables) -> DataFrame:
    return t("supplier").select(F.col("s_suppkey").alias("dataset_id"))


def samples(t: Tables) -> DataFrame:
    rows = t("lineitem").where("l_suppkey % 7 != 0 and (l_suppkey % 5 != 0 or l_returnflag = 'N')")
    counted = rows.groupBy(F.col("l_suppkey").alias("dataset_id"), F.col("l_returnflag").alias("series_id"), F.col("l_partkey").alias("sample")).agg(
        F.count("*").alias("value_count"), (F.count("*") * 8 + F.count_if(F.col("l_linestatus") == "O") * 2).alias("sample_bytes")
    )
    return counted.withColumns({"path": F.concat("series_id", F.lit("/"), "sample"), "missing": F.col("sample") % 50 == 7})


def with_roles(t: Tables) -> DataFrame:
    """Samples with the role that the manifest names for their series, else the one its name suggests; written, as reports read them several times."""
    named = t("lineitem").sparkSession.createDataFrame([("A", "primary")], "series_id string, named string")
    guess = F.when(F.col("series_id") == "N", "auxiliary").otherwise("primary")
    rows = samples(t).join(F.broadcast(named), "series_id", "left").select("*", F.coalesce("named", guess).alias("role"), (F.col("named").isNull() & (guess == "auxiliary")).alias("inferred"))
    return Scratch(rows.sparkSession, "samples").keep(rows, "index")


@query(
    f"""WITH {SAMPLES_SQL}, s AS (SELECT dataset_id, sum(value_count) FILTER (role = 'primary')::BIGINT AS v, sum(sample_bytes) FILTER (role = 'primary')::BIGINT AS b, count(*) FILTER (role = 'primary') AS n,
      median(value_count) FILTER (role = 'primary') AS mv, median(sample_bytes) FILTER (role = 'primary') AS mb, sum(value_count) FILTER (role <> 'primary')::BIGINT AS av, sum(sample_bytes) FILTER (role <> 'primary')::BIGINT AS ab, count(*) FILTER (role <> 'primary') AS an,
      string_agg(DISTINCT series_id, ',') FILTER (inferred) AS inferred FROM x GROUP BY 1),
    z AS (SELECT m.dataset_id, coalesce(v, 0) AS v, coalesce(b, 0) AS b, coalesce(n, 0) AS n, coalesce(mv, 0)::DOUBLE AS mv, coalesce(mb, 0)::DOUBLE AS mb, coalesce(av, 0) AS av, coalesce(ab, 0) AS ab, coalesce(an, 0) AS an, s.dataset_id IS NOT NULL AS has_index, coalesce(inferred, 'none') AS inferred FROM m LEFT JOIN s USING (dataset_id)),
    w AS (SELECT *, CASE WHEN n = 0 THEN 'missing_primary_payload' ELSE concat_ws(',', CASE WHEN v < 300 AND b < 3000 THEN 'aggregate_floor' END, CASE WHEN mv < 1 THEN 'median_sample_floor' END) END AS reasons FROM z)
    SELECT dataset_id, CASE WHEN n = 0 THEN 'broken' WHEN reasons = '' THEN 'ok' ELSE 'below_floor' END AS status, v AS primary_values, b AS primary_sample_bytes, n AS primary_sample_rows, mv AS median_primary_sample_value_count, mb AS median_primary_sample_size_bytes,
      av AS auxiliary_values, ab AS auxiliary_sample_bytes, an AS auxiliary_sample_rows, has_index, inferred AS inferred_auxiliary_series, CASE WHEN reasons = '' THEN 'none' ELSE reasons END AS failure_reasons FROM w"""
)
def accepted_recipes(t: Tables) -> DataFrame:
    """Thirteen columns a dataset of the manifest, its index joined from the left, in the order of the report."""
    return R.accepted(manifest(t), with_roles(t), min_values=300, min_bytes=3000, min_median=1)


STATE = ["p10", "p25", "median", "p75", "p90"]
STATE_SQL = ", ".join(f"min({c}) AS min_{n}, " + ", ".join(f"quantile_cont({c}, {q}) AS {p}_{n}" for p, q in zip(STATE, (0.1, 0.25, 0.5, 0.75, 0.9), strict=True)) + f", max({c}) AS max_{n}" for c, n in (("value_count", "values"), ("sample_bytes", "bytes")))


@query(
    f"""WITH {SAMPLES_SQL}, d AS (SELECT dataset_id, sum(value_count) FILTER (role = 'primary') AS v, sum(sample_bytes) FILTER (role = 'primary') AS b, count(*) FILTER (role = 'primary') AS n, median(value_count) FILTER (role = 'primary') AS mv, bool_or(missing) AS gone FROM x GROUP BY 1),
    e AS (SELECT dataset_id, concat_ws(',', CASE WHEN n = 0 THEN 'missing_primary_payload' END, CASE WHEN coalesce(v, 0) < 300 THEN 'value_floor' END, CASE WHEN coalesce(b, 0) < 3000 THEN 'byte_floor' END, CASE WHEN coalesce(mv, 0) < 1 THEN 'median_sample_floor' END, CASE WHEN b > 100000 THEN 'primary_size_cap' END, CASE WHEN gone THEN 'missing_sample_files' END) AS reasons FROM d),
    c AS (SELECT dataset_id, series_id, max(n) / sum(n) AS same FROM (SELECT dataset_id, series_id, sample_bytes, count(*) AS n FROM x GROUP BY ALL) GROUP BY 1, 2),
    g AS (SELECT dataset_id, series_id, any_value(role) AS role, count(*) AS samples, sum(value_count)::BIGINT AS values_total, sum(sample_bytes)::BIGINT AS bytes_total, {STATE_SQL}, arg_min(path, sample) AS first_sample_path, count(*) FILTER (missing) AS missing_files FROM x GROUP BY 1, 2)
    SELECT m.dataset_id, CASE WHEN e.dataset_id IS NULL THEN 'not_built' WHEN reasons = '' THEN 'ok' ELSE 'needs_attention' END AS status, CASE WHEN e.dataset_id IS NULL THEN 'missing_sample_index' ELSE reasons END AS reasons, g.* EXCLUDE (dataset_id), same AS same_size_fraction,
      CASE WHEN series_id IS NOT NULL THEN 'count' END AS numeric_kind, CASE WHEN series_id IS NOT NULL THEN '64' END AS bit_width
    FROM m LEFT JOIN e USING (dataset_id) LEFT JOIN g USING (dataset_id) LEFT JOIN c USING (dataset_id, series_id)"""
)
def dataset_state(t: Tables) -> DataFrame:
    """Every series with its sizes' distribution, its files, and its dataset's state; a dataset without an index is not built."""
    index = with_roles(t).withColumns({"numeric_kind": F.lit("count"), "bit_width": F.lit(64)})
    return R.state(manifest(t), index, min_values=300, min_bytes=3000, min_median=1, max_bytes=100_000)


@query(
    """WITH l AS (SELECT l_suppkey AS series_id, CASE WHEN l_suppkey % 4 = 1 THEN 'nan'::DOUBLE WHEN l_suppkey % 4 = 2 THEN 3.0 WHEN l_suppkey % 4 = 3 AND l_orderkey % 97 <> 0 THEN 'nan'::DOUBLE ELSE l_quantity END AS value FROM lineitem WHERE l_suppkey % 6 <> 5),
    f AS (SELECT series_id, count(*) AS n, count(*) FILTER (isnan(value)) AS nans, count(DISTINCT value) FILTER (NOT isnan(value)) AS kinds FROM l GROUP BY 1)
    SELECT s_suppkey AS series_id, coalesce(n, 0) AS value_count, coalesce(nans, 0) AS nan_count, CASE WHEN n IS NULL THEN 'broken' WHEN nans = n THEN 'nan_only' WHEN kinds = 1 AND nans = 0 THEN 'constant' WHEN kinds = 1 THEN 'constant_or_nan' ELSE 'ok' END AS status FROM supplier LEFT JOIN f ON s_suppkey = series_id"""
)
def degenerate_or_broken(t: Tables) -> DataFrame:
    """Registered series without values, with nothing but NaN, or with one value."""
    k = F.col("l_suppkey") % 4
    value = F.when((k == 1) | ((k == 3) & (F.col("l_orderkey") % 97 != 0)), float("nan")).when(k == 2, 3.0).otherwise(F.col("l_quantity"))
    rows = t("lineitem").where("l_suppkey % 6 != 5").select(F.col("l_suppkey").alias("series_id"), value.alias("value"))
    counts = rows.groupBy("series_id", "value").agg(F.count("*").alias("k"))
    real = ~F.isnan("value")
    facts = counts.groupBy("series_id").agg(F.sum("k").alias("n"), F.sum(F.when(~real, F.col("k")).otherwise(0)).alias("nans"), F.count_if(real).alias("kinds"))
    status = F.when(F.col("n").isNull(), "broken").when(F.col("nans") == F.col("n"), "nan_only").when((F.col("kinds") == 1) & (F.col("nans") == 0), "constant").when(F.col("kinds") == 1, "constant_or_nan").otherwise("ok")
    known = t("supplier").select(F.col("s_suppkey").alias("series_id")).join(facts, "series_id", "left")
    return known.select("series_id", F.coalesce("n", F.lit(0)).alias("value_count"), F.coalesce("nans", F.lit(0)).alias("nan_count"), status.alias("status"))


@query(
    f"""WITH {SAMPLES_SQL}, w AS (SELECT *, CASE dataset_id % 3 WHEN 0 THEN 16 WHEN 1 THEN 32 ELSE 64 END AS width FROM x WHERE role = 'primary'),
    c AS (SELECT width, count(*) AS unique_sample_sizes, max(n) / sum(n) AS same_size_fraction FROM (SELECT width, sample_bytes, count(*) AS n FROM w WHERE NOT missing GROUP BY ALL) GROUP BY 1),
    g AS (SELECT width, width = 16 AS sixteen_bit, count(DISTINCT dataset_id) FILTER (NOT missing) AS datasets, count(*) FILTER (NOT missing) AS samples, sum(value_count) FILTER (NOT missing)::BIGINT AS total_values, sum(sample_bytes) FILTER (NOT missing)::BIGINT AS total_bytes,
      min(sample_bytes) FILTER (NOT missing) AS low, quantile_cont(sample_bytes, 0.1) FILTER (NOT missing) AS p10, quantile_cont(sample_bytes, 0.25) FILTER (NOT missing) AS p25, quantile_cont(sample_bytes, 0.5) FILTER (NOT missing) AS p50, quantile_cont(sample_bytes, 0.75) FILTER (NOT missing) AS p75,
      quantile_cont(sample_bytes, 0.9) FILTER (NOT missing) AS p90, max(sample_bytes) FILTER (NOT missing) AS high, median(value_count) FILTER (NOT missing) AS mv, count(*) FILTER (missing) AS missing_files FROM w GROUP BY 1),
    a AS (SELECT *, concat_ws(',', CASE WHEN missing_files > 0 THEN 'missing_sample_files' END, CASE WHEN total_values < 3000 THEN 'value_floor' END, CASE WHEN total_bytes < 30000 THEN 'byte_floor' END, CASE WHEN mv < 1 THEN 'median_sample_floor' END,
      CASE WHEN total_bytes > 200000 THEN 'primary_size_cap' END, CASE WHEN unique_sample_sizes < 2 THEN 'identical_sample_sizes' END) AS reasons FROM g JOIN c USING (width))
    SELECT * EXCLUDE (mv), CASE WHEN reasons = '' THEN 'ok' ELSE 'needs_attention' END AS status FROM a"""
)
def width_benchmark(t: Tables) -> DataFrame:
    """Sizes of the 16-bit samples whose files exist, and of the other widths beside them, with what is to be said against them."""
    k = F.col("dataset_id") % 3
    return R.benchmark(with_roles(t).where("role = 'primary'").withColumn("width", F.when(k == 0, 16).when(k == 1, 32).otherwise(64)), "width", min_values=3000, min_bytes=30_000, min_median=1, max_bytes=200_000).withColumn(
        "sixteen_bit", F.col("width") == 16
    )


@query(
    """WITH r AS (SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'retired' ELSE 'planned' END AS status FROM customer), f AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_custkey % 10 <> 0 UNION SELECT 9000000 + n_nationkey FROM nation)
    SELECT coalesce(r.id, f.id) AS id, CASE WHEN r.id IS NULL THEN 'path_without_row' WHEN status = 'active' AND f.id IS NULL THEN 'active_without_path' WHEN status <> 'active' AND f.id IS NOT NULL THEN status || '_with_path' END AS finding
    FROM r FULL JOIN f ON r.id = f.id WHERE r.id IS NULL OR (status = 'active') = (f.id IS NULL)"""
)
def registry_paths(t: Tables) -> DataFrame:
    """Rows of a registry whose status disagrees with what lies on disk, and paths that no row knows."""
    k = F.col("c_custkey") % 3
    registry = t("customer").select(F.col("c_custkey").alias("id"), F.when(k == 0, "active").when(k == 1, "retired").otherwise("planned").alias("status"))
    paths = t("orders").where("o_custkey % 10 != 0").select(F.col("o_custkey").alias("id")).union(t("nation").select(F.col("n_nationkey").cast("bigint") + 9_000_000)).distinct()
    return R.against_paths(registry, paths, "id", "status", "active")


# The names of source fields and classes that mean an opaque payload, and the words that say so together.
OPAQUE_FIELDS = ["", "archive_member", "bytes", "complete_file", "complete_file_bytes", "complete_product", "complete_product_bytes", "container_bytes", "container_payload", "file_bytes", "raw_bytes", "raw_payload", "serialized_payload", "serialized_record"]
OPAQUE_CLASSES = ["container_bytes", "container_payload_bytes", "file_bytes", "opaque_bytes", "serialized_bytes"]
OPAQUE_WORDS = {
    "complete_file_bytes": ["complete", "file bytes"],
    "complete_container_bytes": ["complete", "container", "bytes"],
    "complete_product_bytes": ["complete", "product", "bytes"],
    "container_bytes": ["container bytes"],
    "file_container_bytes": ["file-container bytes"],
    "hdf5_product_bytes": ["hdf5", "product", "bytes"],
    "netcdf_product_bytes": ["netcdf", "product", "bytes"],
    "opaque_bytes": ["opaque", "bytes"],
    "serialized_payload": ["serialized", "payload"],
    "serialized_record_payload": ["serialized", "record", "payload"],
    "tfrecord_payload_bytes": ["tfrecord", "payload", "bytes"],
    "protobuf_payload_bytes": ["protobuf", "payload", "bytes"],
    "copy_complete_source": ["copy", "complete", "source", "unchanged"],
    "preserve_complete_product": ["preserve", "complete", "product", "bytes"],
}
# end of the fixed values
SAYINGS = ["", "the complete File bytes", "complete container with bytes", "HDF5 product bytes", "a serialized record payload", "opaque", "copy the complete source unchanged", "one value a row"]
SERIES_SQL = f"""s AS (SELECT doc_id, {OPAQUE_FIELDS + ["value", "flux"]}[doc_id % 16 + 1] AS field, {OPAQUE_CLASSES + ["numeric"] * 4}[doc_id % 9 + 1] AS class, lower(coalesce(text, '') || ' ' || {SAYINGS}[doc_id % 8 + 1]) AS said FROM documents),
o AS (SELECT doc_id, concat_ws(',', CASE WHEN field IN ({", ".join(f"'{x}'" for x in OPAQUE_FIELDS)}) THEN 'field' END, CASE WHEN class IN ({", ".join(f"'{x}'" for x in OPAQUE_CLASSES)}) THEN 'class' END,
  {", ".join("CASE WHEN " + " AND ".join(f"contains(said, '{w}')" for w in words) + f" THEN '{name}' END" for name, words in OPAQUE_WORDS.items())}) AS rules FROM s)"""


def opaque(field: Column, kind: Column, said: Column) -> Column:
    """The rules by which a series' payload is opaque, comma-joined."""
    said = F.lower(said)
    by_words = [F.when(F.expr("true") & _all([F.contains(said, F.lit(w)) for w in words]), F.lit(name)) for name, words in OPAQUE_WORDS.items()]
    return F.concat_ws(",", F.when(field.isin(OPAQUE_FIELDS), "field"), F.when(kind.isin(OPAQUE_CLASSES), "class"), *by_words)


def _all(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def described_series(t: Tables) -> DataFrame:
    k = F.col("doc_id")
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (k % n + 1).cast("int"))
    said = F.concat_ws(" ", F.coalesce("text", F.lit("")), pick(SAYINGS, 8))
    return t("documents").select("doc_id", opaque(pick(OPAQUE_FIELDS + ["value", "flux"], 16), pick(OPAQUE_CLASSES + ["numeric"] * 4, 9), said).alias("rules"))


@query(f"WITH {SERIES_SQL} SELECT doc_id, rules, rules <> '' AS is_opaque FROM o")
def payload_rules(t: Tables) -> DataFrame:
    """Series whose field, class or words (all of a pattern's) say that a file was copied and not read."""
    return described_series(t).select("doc_id", "rules", (F.col("rules") != "").alias("is_opaque"))


@query(
    f"""WITH {SERIES_SQL}, g AS (SELECT doc_id FROM labels WHERE toxic = 1 OR quality = 0)
    SELECT CASE WHEN rules = '' THEN 'ok' WHEN o.doc_id IN (SELECT doc_id FROM g WHERE doc_id IS NOT NULL) THEN 'error' ELSE 'warning' END AS level, count(*) AS series FROM o GROUP BY 1"""
)
def changed_strictness(t: Tables) -> DataFrame:
    """The same findings are errors in what was changed and warnings elsewhere."""
    changed = t("labels").where("toxic = 1 or quality = 0").select("doc_id").distinct().withColumn("changed", F.lit(True))
    level = F.when(F.col("rules") == "", "ok").when(F.col("changed"), "error").otherwise("warning")
    return described_series(t).join(changed, "doc_id", "left").groupBy(level.alias("level")).agg(F.count("*").alias("series"))


VERIFY_SQL = {
    "identity": "n_id > 1",
    "typing": "value_count IS NULL OR sample_bytes < 0",
    "existence": "missing",
    "size": "sample_bytes <> value_count * 8",
    "geometry": "value_count < 1 OR value_count > 3",
    "constancy": "sample_bytes = low AND sample_bytes = high",
}


@query(
    f"""WITH {SAMPLES_SQL}, v AS (SELECT x.*, count(*) OVER (PARTITION BY dataset_id, sample) AS n_id, min(sample_bytes) OVER (PARTITION BY dataset_id) AS low, max(sample_bytes) OVER (PARTITION BY dataset_id) AS high FROM x)
    """
    + " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) AS rows, count(*) FILTER ({c}) AS broken FROM v" for k, c in VERIFY_SQL.items())
)
def verify_suite(t: Tables) -> DataFrame:
    """Constraints over the whole index, which is made once and written: how many rows break each."""
    index = with_roles(t)
    ids = index.groupBy("dataset_id", "sample").agg(F.count("*").alias("n_id"))
    extents = index.groupBy("dataset_id").agg(F.min("sample_bytes").alias("low"), F.max("sample_bytes").alias("high"))
    rows = index.join(ids, ["dataset_id", "sample"]).join(extents, "dataset_id")
    facts = rows.agg(F.count("*").alias("rows"), *(F.count_if(F.expr(c)).alias(k) for k, c in VERIFY_SQL.items()))
    return facts.unpivot(["rows"], list(VERIFY_SQL), "rule", "broken").select("rule", "rows", "broken")


@query("SELECT p_brand, count(*) AS rows, count(*) FILTER (l_quantity > p_size) AS above_capacity, count(*) FILTER (l_quantity - 10 < 0) AS negative FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def capacity_counts(t: Tables) -> DataFrame:
    """Readings above their capacity, and readings below zero once the offset is taken off."""
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_brand").agg(F.count("*").alias("rows"), F.count_if(F.col("l_quantity") > F.col("p_size")).alias("above_capacity"), F.count_if(F.col("l_quantity") - 10 < 0).alias("negative"))
