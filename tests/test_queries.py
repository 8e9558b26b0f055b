"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from wearspan.queries.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, tables, name):
    good, note = compare(spark, tables, name, FOLDER)
    assert good, note


def test_flagship_values(spark):
    rows = {r["split"]: r for r in entry.entry(spark).collect()}
    test, train = rows["test"], rows["train"]
    assert (test["n"], test["rmse"], test["mae"], test["r2"], test["nasa_score"]) == (1100, 15.091227, 4.800682, 0.600651, 26076.93)
    assert (train["n"], train["rmse"], train["mae"], train["r2"], train["nasa_score"]) == (4855, 6.506769, 2.333059, 0.953845, 2659.04)
