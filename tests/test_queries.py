import pytest

import __spark_entry__ as entry
from cardrail.plans import catalog
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_its_check_query(spark, duck, name):
    assert compare(spark, duck, name, SF) == ""


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_check_query_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
