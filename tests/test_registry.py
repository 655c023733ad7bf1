"""Every registered query against its check SQL on the smallest tables."""

import pytest

import __spark_entry__
from tools_check import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQLS = __spark_entry__.queries(), __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, message = compare(spark, con, QUERIES[name], SQLS.get(name), SF)
    assert ok, message
    assert "TYPES" not in message, message


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_check_belongs_to_a_query():
    assert set(SQLS) <= set(QUERIES)
