import decimal

import duckdb
import pytest

import __spark_entry__ as driver
from gleaner.plans import oracle, queries

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()
TABLES = "customer documents events lineitem orders part".split()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return int(value) if isinstance(value, decimal.Decimal) else value


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf, duck, name):
    found = QUERIES[name](spark, sf)
    columns = sorted(found.columns)
    relation = duck.execute(ORACLE[name])
    given = [c[0] for c in relation.description]
    assert sorted(given) == columns
    expected = [tuple(plain(row[given.index(c)]) for c in columns) for row in relation.fetchall()]
    actual = [tuple(plain(row[c]) for c in columns) for row in found.collect()]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)
    assert actual


def test_only_default_partitions_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"q_partition_default"}


def test_flagship(spark):
    assert driver.entry(spark).count() == 10
