"""Queries that SQL can express, against DuckDB on the same files."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from strata.llm.queries import ORACLES, QUERIES

from tests.llm.helpers import SF


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def test_all_are_registered():
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLES.keys() <= driver.oracle_sql().keys()
    assert "pipeline" in driver.queries()
    numbers = {name.split("_")[0] for name in QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    columns = [column[0] for column in expected.description]
    order = sorted(columns)
    assert sorted(result.columns) == order
    wanted = Counter(
        tuple(dict(zip(columns, row, strict=True))[c] for c in order)
        for row in expected.fetchall()
    )
    assert wanted
    assert Counter(tuple(row[c] for c in order) for row in result.collect()) == wanted
