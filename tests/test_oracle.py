"""Every registered query against its SQL; those without one must give rows."""

import __spark_entry__ as entry
import pytest
from oracle import differences, duck

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, con, folder, name):
    assert differences(spark, con, QUERIES[name], ORACLE[name], folder) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark, folder):
    assert entry.entry(spark).count() > 0
