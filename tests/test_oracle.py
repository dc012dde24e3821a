"""Every registered query against its SQL, and the shape of the registry."""

import pytest
from oracle import compare, connect

from ledgerlake.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER).toArrow()
    theirs = duck.execute(ORACLES[name]).to_arrow_table()
    assert ours.num_rows > 0
    assert compare(ours, theirs) is None
