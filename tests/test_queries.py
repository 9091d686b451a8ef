"""Every registered query against its SQL in DuckDB."""

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_points
from shedlake.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry_is_the_flagship(spark):
    rows = entry_points.entry(spark)
    assert rows.columns[:3] == ["FARM_NO", "SHED_NO", "DAY"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []
