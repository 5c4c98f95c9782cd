"""The queries of this subpackage and their SQL; ``__spark_entry__`` adds them if it can import this module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.common import table
from tallyforge.llm.decontamination import find_leaks
from tallyforge.llm.filter_audit import ORACLE as FILTERS_SQL
from tallyforge.llm.filter_audit import audit_filters
from tallyforge.llm.fingerprints import fingerprint_edits
from tallyforge.llm.near_duplicates import near_duplicates
from tallyforge.llm.quality import judge
from tallyforge.llm.sentencepiece_codec import Pieces, code_texts
from tallyforge.llm.sharding import ORACLE as SHARDING_SQL
from tallyforge.llm.sharding import assign_shards
from tallyforge.llm.substring_dedup import drop_repeats
from tallyforge.llm.suffix_dedup import mark_repeats
from tallyforge.llm.token_counts import count_tokens
from tallyforge.llm.toxicity import toxicity
from tallyforge.llm.vector_codes import ORACLE as CODES_SQL
from tallyforge.llm.vector_codes import code_vectors
from tallyforge.llm.warc_revisits import ORACLE as REVISITS_SQL
from tallyforge.llm.warc_revisits import captures_of_pages, resolve_revisits


REPEAT_COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "group_id", "n_links", "group_size")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_texts(table(spark, sf_dir, "documents"), Pieces.read(tokenizer_file("piece_bpe_32k.model")))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_revisits(captures_of_pages(table(spark, sf_dir, "pages")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents")).select(*REPEAT_COLUMNS)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_repeats(table(spark, sf_dir, "documents")).select(*REPEAT_COLUMNS)


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_vectors(spark, table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_sharding": op3_sharding,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_quality_rules": op5_quality_rules,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_warc_revisits": op7_warc_revisits,
    "op8_toxicity": op8_toxicity,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_suffix_array_dedup": op10_suffix_array_dedup,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_filter_audit": op12_filter_audit,
    "op13_vector_codes": op13_vector_codes,
}

#: SQL of what the operators compute, on whole tables; fit for small scales.
WINDOWS_SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - {length} + 2)) AS i FROM d),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {length} - 1], ' ')) AS h FROM p),
r AS (SELECT doc_id, i FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(*) > 1)),
c AS (SELECT doc_id, list(DISTINCT x) AS hit FROM (SELECT doc_id, unnest(range(i, i + {length})) AS x FROM r) GROUP BY doc_id)
"""
REPEATS_SQL = """
SELECT d.doc_id, len(d.w) AS n_words, coalesce(len(hit), 0) AS n_removed,
       sha256(array_to_string(CASE WHEN hit IS NULL THEN d.w ELSE list_filter(d.w, lambda x, i: NOT list_contains(hit, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""

LEAKS_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(10, len(w)) AS n, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
bp AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p FROM bw),
sizes AS (SELECT DISTINCT n FROM bp),
dw AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes),
m AS (SELECT doc_id, item_id, i, dp.n FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p FROM dw) dp JOIN bp ON bp.p = dp.p AND bp.n = dp.n),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
s AS (SELECT *, array_to_string(w, '') AS solid FROM w),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM p) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS x FROM r) GROUP BY doc_id),
m AS (SELECT doc_id, len(w) AS n_words, length(solid) AS word_chars, length(solid) - length(translate(solid, '#*$%&|<>', '')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
      coalesce(c.n, 0) AS n_repeat_words, len(l) AS n_lines, length(regexp_replace(solid, '[^\p{Lu}]+', '', 'g')) AS n_upper FROM s LEFT JOIN c USING (doc_id)),
f AS (SELECT *, ((n_words < 50)::BIGINT + (100 * n_repeat_words > 50 * n_words)::BIGINT * 2 + (100 * n_symbols > 10 * n_words)::BIGINT * 4 + (word_chars < 3 * n_words OR word_chars > 10 * n_words)::BIGINT * 8
      + (100 * n_dup_lines > 30 * n_lines)::BIGINT * 16 + (100 * n_upper > 35 * word_chars)::BIGINT * 32 + (word_chars > 15 * n_words)::BIGINT * 64) AS failed FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f
"""

#: All pairs that share a shingle, and what is reached over links; for tables of some thousand documents.
LINKS_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g, least(5, len(w)) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g, k) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c / (x.n + y.n - c) >= 0.8),
r AS (SELECT doc_id AS root, doc_id AS node FROM documents UNION SELECT root, b FROM r JOIN e ON a = node),
g AS (SELECT root AS doc_id, min(node) AS group_id, count(*) AS group_size FROM r GROUP BY 1)
SELECT doc_id, group_id, coalesce(n_links, 0) AS n_links, group_size FROM g LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM e GROUP BY 1) USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op4_ngram_jaccard_join": LINKS_SQL,
    "op2_benchmark_decontamination": LEAKS_SQL,
    "op3_sharding": SHARDING_SQL,
    "op5_quality_rules": QUALITY_SQL,
    "op7_warc_revisits": REVISITS_SQL,
    "op9_substring_dedup": WINDOWS_SQL.format(length=35) + REPEATS_SQL,
    "op10_suffix_array_dedup": WINDOWS_SQL.format(length=50) + REPEATS_SQL,
    "op12_filter_audit": FILTERS_SQL,
    "op13_vector_codes": CODES_SQL,
}
