"""Every query against DuckDB on the smallest tables, and rows only where no SQL exists."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, duck

SF = "/root/testdata/sf0.001"
SLOW = {"model_comparison", "gbt_booking", "gbt_dayof", "gbt_median_minutes", "scored_days", "score_requests", "logistic_scores"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in contract.queries() if n not in SLOW])
def test_query(spark, con, name):
    verdict, note, _ = compare(spark, con, name, SF)
    assert verdict in ("ok", "rows"), note


def test_entry(spark):
    assert contract.entry(spark).count() > 0
