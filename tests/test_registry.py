import compare
import pytest

import __spark_entry__ as entry

from wardline.plans import catalog

NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def connection(sf):
    return compare.connect(sf)


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.queries())
    assert sorted(catalog.ORACLES) == NAMES


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, connection, sf, name):
    assert compare.difference(spark, connection, name, sf) is None


def test_flagship(spark):
    flagship = entry.entry(spark)
    assert "stay_id" in flagship.columns and flagship.count() > 0
