"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def engine():
    return connect(SF)


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    assert rows and abs(sum(r.pct_of_country for r in rows if r.country == "Kenya") - 100) < 0.5


def test_keys_agree():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    good, note = compare(spark, engine, SF, name)
    assert good, note
