"""Every registered query gives the rows of its SQL twin."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare
from checks.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert compare(spark, duck, QUERIES[name], ORACLES.get(name), sf_dir) == ""


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
    rows = contract.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"source", "files", "missing", "words"}
