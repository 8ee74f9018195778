"""Every registered query against the same question in SQL."""

import pathlib
import re

import duckdb
import pytest

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def canonical(rows, order):
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_its_sql():
    # Queries of the text package are tested beside it where SQL can't express them.
    numbered = {name for name in QUERIES if re.match(r"op\d+_|pipeline$", name)}
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - numbered <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    got = canonical(df.select(*columns).collect(), range(len(columns)))
    order = [expected.columns.index(c) for c in columns]
    assert got == canonical(expected.fetchall(), order)
    assert got, "nothing was compared"


def test_entry_is_the_flagship(spark):
    df = entry_module.entry(spark)
    assert df.columns[:3] == ["tag1", "tag2", "pair_count"]
    assert df.count() > 0
