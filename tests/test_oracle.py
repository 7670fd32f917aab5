"""Every query with SQL against a second engine, over whole tables."""

import pytest

from oracle_check import connect, difference, rows_of_spark, rows_of_sql
from stationflow.plans.oracle import ORACLES
from stationflow.plans.queries import QUERIES

# These fit six full-size models; test_job and test_models cover them with small ones.
SLOW = ("j05_", "h14_model_statements")
FAST = sorted(n for n in ORACLES if not n.startswith(SLOW))


@pytest.fixture(scope="module")
def sql(request):
    return connect("/root/testdata/sf0.001")


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, sql, small, name):
    assert difference(rows_of_spark(QUERIES[name](spark, small)), rows_of_sql(sql, ORACLES[name])) is None
