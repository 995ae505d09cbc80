"""Every registered document query against its SQL, on the smallest fixture."""

import os

import duckdb
import pytest

from folioflow.plans import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{DATA}/{name}'")
    return con


def rows(frame, columns):
    frame = frame[columns].astype(object)
    return sorted(map(repr, frame.where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_sql(spark, tables, name):
    got = registry.queries()[name](spark, DATA).toPandas()
    want = tables.sql(registry.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert rows(got, columns) == rows(want, columns)
    assert len(got)
