"""Every registered telemetry query against its SQL."""

import duckdb
import pytest

from fieldwatch.plans.oracle import SQL
from fieldwatch.plans.queries import QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for table in ("events", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_each_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, sf_dir, db, name):
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    want = db.sql(SQL[name])
    assert columns == sorted(want.columns)
    assert {c: TYPES[t] for c, t in got.dtypes} == {c: str(t) for c, t in zip(want.columns, want.types, strict=True)}
    names = ", ".join(f'"{c}"' for c in columns)
    assert sorted(map(repr, map(tuple, got.select(columns).collect()))) == sorted(map(repr, db.sql(f"SELECT {names} FROM ({SQL[name]})").fetchall()))
