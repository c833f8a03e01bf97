"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import functools

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import TABLES, rows_of
from quillvault.queries import corpus, retrieval


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def one_store():
    """Queries over a stored corpus, and those over the size comparison, share one run each here."""
    patch = pytest.MonkeyPatch()
    patch.setattr(corpus, "_stored", functools.cache(corpus._stored))
    patch.setattr(retrieval, "_hit_report", functools.cache(retrieval._hit_report))
    yield
    patch.undo()


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 5


# Whole chains that other tests cover.
CHAINS = {"stream_ingest", "pipeline"}


@pytest.mark.parametrize("name", sorted(set(queries()) - CHAINS))
def test_query(spark, sf_dir, db, name):
    df = queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    text = oracle_sql().get(name)
    if text is None:
        assert got or name.startswith("op")  # a small table may hold no licence, for example
        return
    want = db.sql(text)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, got) == rows_of(want.columns, want.fetchall())
