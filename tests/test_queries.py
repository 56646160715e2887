"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
import oracle

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_sql(spark, con, name):
    frame = entry.queries()[name](spark, SF)
    got = oracle.spark_rows(frame)
    if name in SQL:
        assert got == oracle.sql_rows(con, SQL[name])
        assert oracle.type_differences(frame, con, SQL[name]) == {}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(entry.queries())
