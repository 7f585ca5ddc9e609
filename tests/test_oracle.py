"""Every registered query against its DuckDB oracle SQL on the smallest data set."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from check_oracle import compare, duck_connect  # noqa: E402
from dockwise.plans import catalog  # noqa: E402
from support import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", list(catalog.REGISTRY))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, SF_SMALL, name)
    assert ok, msg


def test_every_query_has_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["name", "n"] and df.count() > 0
    assert set(catalog.REGISTRY) <= set(E.queries()) and set(catalog.REGISTRY) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
