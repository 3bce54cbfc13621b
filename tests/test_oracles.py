"""Every query against its SQL on the smallest sample."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


def test_catalogue():
    assert set(ORACLES) == set(QUERIES) - {"train_fit", "train_importance"}
    assert set(entry_points.queries()) >= set(QUERIES) and set(entry_points.oracle_sql()) >= set(ORACLES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["Symbol", "PriceTimestamp"]


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, con, data, name):
    assert differences(QUERIES[name](spark, data).toPandas(), con.execute(ORACLES[name]).fetch_df()) == ""


@pytest.mark.parametrize("name", ["train_fit", "train_importance"])
def test_training_queries_run(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0
