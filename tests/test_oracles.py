"""Every query with SQL against DuckDB on the same tables, every value."""

import pytest

import __spark_entry__ as entry_point
from tests.compare import connect, differences
from tests.conftest import SF_DIR
from workload.oracles import ORACLES
from workload.queries import QUERIES

#: Learners and an estimate: no SQL says the same.
NO_SQL = {"kmeans_classes", "predict_rf", "train_forest_rf", "distinct_classes_approx"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == NO_SQL  # their properties have, as *_properties
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_same_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_entry(spark):
    out = entry_point.entry(spark)
    assert out.columns == ["scene_id", "r", "c", "cls"]
    assert out.count() == 32_000
    assert set(entry_point.queries()) >= set(entry_point.oracle_sql())
