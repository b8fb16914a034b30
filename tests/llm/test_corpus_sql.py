"""Queries whose result SQL can say, and the registration of all."""

import duckdb
import pytest

import corpus_pipeline
from fieldwatch.llm.queries import ORACLE_SQL, QUERIES


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near copies", "repeated passages", "personal data", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, want))
