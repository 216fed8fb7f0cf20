"""Every registered query agrees with its SQL in another engine."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import connect, difference
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_agrees(spark, duck, name):
    df = entry_points.queries()[name](spark, SMALL)
    assert difference(df, duck, entry_points.oracle_sql()[name]) is None


def test_every_query_has_sql():
    named = set(entry_points.queries()) - set(entry_points.LLM_QUERIES)
    assert named == set(entry_points.oracle_sql()) - set(entry_points.LLM_ORACLES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
