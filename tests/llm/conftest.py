import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(brute.awkward(), brute.COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def rows():
    return [(r[0], r[1]) for r in brute.awkward()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], brute.COLUMNS)


@pytest.fixture(scope="session")
def no_ids(spark):
    """Nulls in every column."""
    return spark.createDataFrame([(None,) * 15, (None, "some text " * 30) + (None,) * 13, (None, "some text " * 30) + (None,) * 13], brute.COLUMNS)
