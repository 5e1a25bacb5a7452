"""Registered batch queries against their oracle SQL on the smallest data set."""

import os

import pytest

from checks.compare import compare, connect
from checks.oracles import oracle_sql
from checks.queries import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
# Streams and table-writing jobs have tests of their own.
BATCH = [name for name in queries() if not name.startswith(("stream_", "job_"))]
# The smallest data has no rows for these.
MAY_BE_EMPTY = {"high_risk_users_last_hour", "kpi_high_risk_hours", "kpi_lag_alarm", "lateral_movement_windows"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", BATCH)
def test_query(spark, duck, name):
    problem = compare(spark, duck, name, queries()[name], oracle_sql()[name], SF_DIR)
    if problem == "no rows on either side" and name in MAY_BE_EMPTY:
        return
    assert problem is None, problem
