"""Every registered query against its SQL, over whole tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import connect, expected, rows_of
from propgraph.plans.oracles import ORACLES
from propgraph.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    frame = entry.queries()[name](spark, SF_DIR)
    names, wanted, _ = expected(sql, entry.oracle_sql()[name])
    assert sorted(frame.columns) == names
    got = rows_of(frame.columns, frame.collect())
    assert len(got) == len(wanted)
    assert got == wanted
    assert got, "a query that finds nothing checks nothing"


def test_entry(spark):
    assert entry.entry(spark).count() == 139
