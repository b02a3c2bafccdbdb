"""Every registered query against its oracle, and the contract of the entry module."""

import pytest

import __spark_entry__ as entry
from tools.compare import compare, oracle_connection
from workload.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

# At the smallest scale these windows or thresholds select nothing.
MAY_BE_EMPTY = {"drift_alerts", "cohort_for_date", "scored_cohort", "expiring_cohort"}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, FOLDER, name)
    assert problem is None or (problem == "EMPTY" and name in MAY_BE_EMPTY), problem


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["total", "churned", "retained", "churn_rate_pct"] and df.count() == 1
