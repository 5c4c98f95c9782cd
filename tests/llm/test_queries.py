"""The subpackage's queries against their SQL, and the pipeline's stages against their own rules."""

import os

import duckdb
import pytest

import corpus_pipeline
from tallyforge.llm.queries import ORACLES, QUERIES
from tests.test_queries import SF, TABLES, rows_of


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert sum(got[1].values()) > 0
    if name in ORACLES:
        found = sql.sql(ORACLES[name])
        assert got == rows_of(found.columns, found.fetchall())


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(os.fspath(tmp_path / name))
        docs = spark.read.parquet(os.fspath(tmp_path / name))
        assert name == "sentencepiece" or docs.columns == columns
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0
    assert docs.where("not round_trip").count() == 0
