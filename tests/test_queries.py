"""Every registered query against its SQL, on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_module.own_queries()))
def test_query_matches_sql(spark, duck, name):
    result = entry_module.own_queries()[name](spark, SF_DIR)
    expected = duck.sql(entry_module.own_oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    rows = [tuple(row) for row in result.collect()]
    assert rows
    assert sorted_rows(result.columns, rows) == sorted_rows(expected.columns, expected.fetchall())


def test_every_query_has_sql():
    assert set(entry_module.own_queries()) == set(entry_module.own_oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_writers_of_the_log_grow_with_the_documents(spark, monkeypatch):
    import __spark_entry__ as entry
    from dwelltide.streaming import sinks

    used, write = [], entry.write_log_batch
    monkeypatch.setattr(entry, "write_log_batch", lambda *a, writers: (used.append(writers), write(*a, writers=writers)))
    whole = [tuple(r) for r in entry.log_puts(spark, "/root/testdata/sf0.001").collect()]
    monkeypatch.setattr(sinks, "WRITER_BYTES", 50_000)
    assert [tuple(r) for r in entry.log_puts(spark, "/root/testdata/sf0.001").collect()] == whole
    assert used[0] == 4 < used[1] and whole[0][1:] == (0, 0)
