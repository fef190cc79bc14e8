import pytest

import __spark_entry__ as entry_points
from tests.oracle import SF_DIR, connect, difference


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_its_sql(spark, con, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert difference(con, entry_points.oracle_sql()[name], df) is None


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
