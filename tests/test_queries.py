"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__
from workload.compare import connect, differences
from workload.registry import CASES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n, c in CASES.items() if c.sql])
def test_equals_sql(spark, con, name):
    assert differences(spark, con, name, SF_DIR) == ""


def test_entry_points(spark):
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries)
    flagship = __spark_entry__.entry(spark)
    assert flagship.columns == ["id", "step", "ds", "yhat", "p", "q"]
    assert flagship.count() > 0
