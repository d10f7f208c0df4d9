"""Driver contract: entry smoke run and every SQL-checked query at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import TABLES, compare
from clickroll.plans import catalog

SF = "/root/testdata/sf0.001"
SLOW = {"gbt_fulltrain", "gbt_fulltrain_session_key", "gbt_group_cv", "gbt_group_cv_test", "gbt_seed_ensemble"}


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "session_event_count" in df.columns


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.QUERIES) - set(E.oracle_sql()) == SLOW   # the corpus operators have tests of their own


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    rec = compare(spark, con, name, SF)
    assert rec["cols_match"] and rec["hash_match"], rec
