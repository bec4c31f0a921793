"""Every query with SQL gives the rows that SQL gives, over the whole of the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from murmur.plans import catalog, oracle
from murmur.session import settle

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.fixture(scope="module", autouse=True)
def scored_once(spark):
    """Most queries start from the scored mentions: they are made once, by the library, and read by all."""
    make, made = catalog.mentions, {}

    def mentions(session, sf):
        if sf not in made:
            made[sf] = settle(make(session, sf))
        return made[sf]
    catalog.mentions = mentions
    yield
    catalog.mentions = make


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(catalog.QUERIES) == set(oracle.SQL)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_same_rows(spark, db, name):
    problem, _ = differences(QUERIES[name](spark, SF), db, SQL[name])
    assert problem == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["brand", "total", "polarity", "negative"]
