import compare as c
import pytest

import __spark_entry__ as entry

NAMES = sorted(entry.queries())


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) <= set(NAMES) and len(NAMES) >= 96


@pytest.fixture(scope="module")
def con(sf):
    return c.connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf, name):
    for _, _, _, _, problem in c.compare(spark, con, sf, [name]):
        assert problem is None, problem
