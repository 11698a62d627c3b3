"""Every registered query against its SQL, run by DuckDB on the same files."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from strata.plans.oracles import ORACLES
from strata.plans.queries import QUERIES

from tests.helpers import SF


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return Counter(tuple(repr(row[n]) for n in order) for row in rows)


def test_every_query_has_an_oracle_and_is_registered():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLES.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(columns)
    wanted = multiset(columns, expected.fetchall())
    assert wanted
    assert multiset(result.columns, result.collect()) == wanted


def test_entry(spark):
    assert driver.entry(spark).count() == 21
