"""Every query of the lake against its DuckDB SQL, and the shape of the driver contract."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect, duck_pandas, spark_pandas
from checks.oracle import ORACLE
from checks.registry import QUERIES
from conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    mine = spark_pandas(QUERIES[name](spark, SMALL))
    assert compare(mine, duck_pandas(con, ORACLE[name])) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    found = contract.entry(spark)
    assert found.columns == ["preset", "start_ts", "end_ts", "actor_login", "push_count"]
    assert found.count() > 0
