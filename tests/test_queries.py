import pytest

from nimbria.queries import ALL
from tests.compare import connect, same


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, sf, con, name):
    query, sql = ALL[name]
    df = query(spark, sf)
    if sql:
        same(df, con, sql)
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
