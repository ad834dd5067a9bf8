"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_contract_is_complete():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["doc_id", "text", "n_par", "n_dup"] and df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    same, note = compare(spark, con, SF, name)
    assert same, note
