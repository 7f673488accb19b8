"""Every query of the subpackage that has SQL against DuckDB on the same tables, every value."""

import pytest

from silvagrid.llm.oracles import ORACLES
from silvagrid.llm.queries import QUERIES
from tests.compare import connect, differences
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_as_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []
