"""Every named query against its SQL on the smallest test tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as spec
from pulselake.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for f in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{f}'")
    return connection


def as_counter(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(str(r[i]) for i in order) for r in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(spec.queries())
    assert set(QUERIES) <= set(spec.oracle_sql())


def test_entry(spark):
    assert spec.entry(spark).count() == 1000


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    answer = db.execute(spec.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(names)
    got, want = as_counter(df.columns, df.collect()), as_counter(names, answer.fetchall())
    assert got == want
    assert got
