import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dockwise.llm.common import ship_package  # noqa: E402
import helpers  # noqa: E402


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def rows():
    return helpers.corpus()


@pytest.fixture(scope="session")
def docs(llm, rows):
    return llm.createDataFrame(rows, helpers.SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(llm):
    return llm.createDataFrame([], helpers.SCHEMA)
