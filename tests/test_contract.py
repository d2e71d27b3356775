"""Every registered query against its SQL, over whole tables."""

import os

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as registered

SF = os.environ.get("CONTRACT_SF", "0.001")
FOLDER = f"{TESTDATA}/sf{SF}"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{FOLDER}/{file}')")
    return con


def ordered(rows, columns):
    places = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in places) for row in rows), key=repr)


def test_every_query_of_the_library_has_sql():
    assert registered._QUERIES.keys() <= registered.oracle_sql().keys() <= registered.queries().keys()


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registered.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = registered.queries()[name](spark, FOLDER)
    found = ordered([tuple(r) for r in result.collect()], result.columns)
    cursor = duck.execute(registered.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(result.columns)
    assert found == ordered(cursor.fetchall(), names)
