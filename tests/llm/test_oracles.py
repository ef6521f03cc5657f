"""Queries of the package against their DuckDB SQL on sf0.01."""

import duckdb
import pytest

from flightlake.llm import queries
from tests.llm.util import SF01
from tests.test_entry_oracle import _rows

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_oracle(spark, tables, name):
    got, columns = _rows(queries.QUERIES[name](spark, SF01).toPandas())
    want, names = _rows(tables.execute(queries.ORACLE[name]).fetchdf())
    assert columns == names and got == want
