"""Every registered query against its SQL, at the smallest scale, and a look at its plan."""

import pytest
from compare import compare, connect

from askloom.workload import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.fixture
def no_broadcast(spark):
    """Joins are planned as for large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, no_broadcast, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert compare(df, duck, ORACLE[name]) is None
    else:
        assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
