import oracle
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert oracle.compare(queries()[name](spark, SF), con, oracle_sql()[name]) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.where("HAS_MAPPED_INCIDENT = 1").count() > 0
    assert set(oracle_sql()) <= set(queries())
