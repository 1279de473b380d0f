"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import connect, difference

from martloom.bindings import oracles, queries

FOLDER = "/root/testdata/sf0.001"

#: Checks that find nothing to report in the smallest tables.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(oracles()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_equals_sql(spark, con, name):
    problem = difference(queries()[name](spark, FOLDER), con, oracles()[name])
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY)


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracles())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
