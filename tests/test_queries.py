"""Every query with SQL against it, on the smallest tables; the others run and keep their columns."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
# queries of small cost without SQL are run as they are; the costly numerical ones have tests of their own
SKIP = {"interp_spline", "interp_poly", "long_fc", "panel_fc", "p3_neighbours", "p10_scores", "p10_rates"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SKIP])
def test_query(spark, con, name):
    got, sql = entry.queries()[name](spark, SF), entry.oracle_sql().get(name)
    if sql:
        assert compare(got.toPandas(), con.execute(sql).df()) == ""
    else:
        assert got.columns and got.count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert not set(entry.oracle_sql()) - set(entry.queries())
