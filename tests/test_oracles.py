"""Every registered query against its SQL, run by DuckDB on the same files."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from retail_strata.queries import QUERIES as OWN

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def canonical(columns, rows):
    """Rows as text in name order of the columns, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value)
        return repr(value)

    return [columns[i] for i in order], sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_same_names():
    assert set(OWN) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    ours = canonical(result.columns, [tuple(row) for row in result.collect()])
    expected = duck.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    theirs = canonical(names, expected.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1]) > 0
    assert ours[1] == theirs[1]


def test_entry(spark):
    assert entry(spark).count() == 237
