"""Every registered query against its DuckDB oracle on the sf0.001 tables
(column names, row count, multiset of rows)."""

import duckdb
import pytest

import __spark_entry__ as entry
from parcelle.queries import REGISTRY
from parcelle.sources.adapter import TABLES
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"
KEYS = sorted(k for k in entry.oracle_sql() if k in REGISTRY)  # the training-data queries have their own tests


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    srows, scols = df.collect(), df.columns
    res = duck.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, res.fetchall())


def test_every_query_runs(spark):
    for key, fn in entry.queries().items():
        if key in REGISTRY and key not in entry.oracle_sql():
            assert fn(spark, SF).count() >= 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
