"""Every registered query against its SQL in another engine, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, compare
from levyline.plans.oracles import ORACLES
from levyline.plans.registry import QUERIES

SLOW = {name for name in QUERIES if name.startswith(("train_", "tune_"))}


@pytest.fixture(scope="module")
def con(sf):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return connection


def test_only_model_training_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == SLOW
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_matches_sql(spark, con, sf, name):
    result, _ = compare(spark, con, name, sf, contract.oracle_sql()[name])
    assert result.startswith("ok") and result != "ok 0", result


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "window_start" and df.count() == 765
