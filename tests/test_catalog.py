"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from verdigris import catalog
from scripts.oracle_check import TABLES, rows_key, type_diff
from tests.conftest import SF_SMALL

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_oracle_or_reason():
    no_oracle = set(QUERIES) - set(ORACLES)
    assert no_oracle == {"random_split", "balance_bernoulli", "partition_sweep"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert type_diff(df, con, ORACLES[name]) == {}
    assert rows_key(srows, cols) == rows_key(orows, ocols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["label", "n_true", "n_pred", "hits", "precision", "recall", "f1"]
