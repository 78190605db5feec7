"""Every query with SQL against DuckDB over the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from vellum.registry import ORACLE_SQL, QUERIES


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(ORACLE_SQL[name])
    at = {d[0]: k for k, d in enumerate(cursor.description)}
    assert sorted(at) == columns
    theirs = sorted((tuple(plain(r[at[c]]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
