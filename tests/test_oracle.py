"""Every registered query against the same query in DuckDB, over whole tables."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows
from conftest import SMALL

from textlake import plans


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", plans.oracle_sql())
def test_same_as_sql(spark, duck, name):
    columns, got = spark_rows(plans.queries()[name](spark, SMALL))
    wanted_columns, wanted = duck_rows(duck, plans.oracle_sql()[name])
    assert columns == wanted_columns
    assert got == wanted
    assert got


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_gives_rows(spark, name):
    assert not plans.queries()[name](spark, SMALL).isEmpty()


def test_every_sql_has_its_query():
    assert set(plans.oracle_sql()) <= set(plans.queries())
