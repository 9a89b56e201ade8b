"""Every query of this engine's own operators equals its SQL on the smallest driver tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    compare = pytest.importorskip("checks.compare")
    return compare.connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= queries().keys()
    assert ORACLES.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    from checks.compare import compare

    assert compare(spark, con, SF, name) is None


def test_entry(spark):
    assert entry(spark).count() > 0
