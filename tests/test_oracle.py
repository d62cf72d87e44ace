"""Every key with a DuckDB twin: same columns, same rows, same values (sf0.001, whole tables)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = ["documents", "labels", "embeddings", "events", "conversations"]
KEYS = sorted(entry_module.oracle_sql())


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con(small_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return c


def test_every_oracle_key_is_registered():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, con, small_dir, key):
    df = entry_module.queries()[key](spark, small_dir)
    spark_rows, spark_cols = df.collect(), df.columns
    rel = con.sql(entry_module.oracle_sql()[key])
    assert sorted(spark_cols) == sorted(rel.columns)
    assert rows_of(spark_cols, spark_rows) == rows_of(rel.columns, rel.fetchall())
