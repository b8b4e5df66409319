import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import ROWS, SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like those of the operators."""
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
