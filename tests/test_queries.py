"""Every registered driver query against its DuckDB oracle (sf0.001)."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb
    from oracle_check import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    from tableload.queries import ORACLE, QUERIES

    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0 and df.columns[0] == "o_orderkey"


@pytest.mark.parametrize("name", sorted(__import__("tableload.queries", fromlist=["QUERIES"]).QUERIES))
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import rows_of_duck, rows_of_spark

    from __spark_entry__ import oracle_sql, queries

    scols, srows = rows_of_spark(queries()[name](spark, SF))
    dcols, drows = rows_of_duck(duck, oracle_sql()[name])
    assert scols == dcols
    assert srows == drows
