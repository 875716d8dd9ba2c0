"""Every query against its SQL, on the smallest sample."""

import pytest

import __spark_entry__ as entry
from tests.compare import duck, rows_of_frame, rows_of_sql

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    names, expected = rows_of_sql(con, entry.oracle_sql()[name])
    got_names, got = rows_of_frame(entry.queries()[name](spark, FOLDER))
    assert got_names == names
    assert sum(got.values()) > 0
    assert got == expected


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
