"""Every core query against its SQL over the tables that the driver compares."""

import glob
import math
import os

import pytest

from graphloom.plans import registry

DIR = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables here")


def norm(v):
    import datetime as dt

    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    return str(v) if isinstance(v, dt.datetime) else v


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    df = registry.queries()[name](spark, DIR)
    want = con.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    columns = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=repr)
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(norm(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_names_do_not_clash():
    assert registry.FLAGSHIP in registry.queries()
    assert set(registry.oracle_sql()) <= set(registry.queries())
