"""Every query against its SQL on another engine, over the whole given tables."""

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLE = entry.catalog.QUERIES, entry.oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def plain(value):
    return float(value) if isinstance(value, Decimal) else value


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = Counter(
        tuple(plain(dict(zip(names, row))[c]) for c in columns) for row in result.fetchall()
    )
    assert ours == theirs


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
