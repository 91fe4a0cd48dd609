import pytest

import __spark_entry__ as entry_module


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm():
    return entry_module.queries()


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "conversations"):
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection
