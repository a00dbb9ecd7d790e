"""Every query of the operators gives the rows of its SQL twin, or rows where SQL has no twin."""

import pytest

from checks.compare import compare
from gleaner.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    assert compare(spark, duck, QUERIES[name], ORACLES.get(name), sf_dir) == ""


def test_registered():
    import __spark_entry__ as contract

    assert QUERIES.keys() | {"pipeline"} <= contract.queries().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
