"""Every named query runs, and equals its SQL twin if it has one."""

import pytest
from compare import connect, difference

from weftline.plans import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, con, name):
    df = all_queries()[name](spark, FOLDER)
    sql = all_sql().get(name)
    if sql is None:
        assert df.count() >= 1
    else:
        assert difference(df, con, sql) is None


def test_every_sql_has_a_query():
    assert set(all_sql()) <= set(all_queries())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["l_returnflag", "l_linestatus", "total"]
    assert e.entry(spark).count() == 6
