import pytest
from pyspark.sql import functions as F

from graphloom.operators import records, retrieval
from graphloom.sources import stores


def test_context_fits(spark, rows):
    make = lambda *sizes: spark.createDataFrame(list(enumerate(sizes)), "pos int, tokens int")
    got = rows(retrieval.fit_context(make(10, 10), make(10, 50), make(5, 5), 40))
    assert got == [("entity", 0, 10), ("entity", 1, 10), ("relation", 0, 10)]
    assert rows(retrieval.fit_context(make(10), make(10), make(5, 50), 30)) == [("chunk", 0, 5), ("entity", 0, 10), ("relation", 0, 10)]
    assert rows(retrieval.fit_context(make(10).limit(0), make(10).limit(0), make(5), 3)) == []


def test_names_that_are_slips(spark):
    n = spark.createDataFrame([("max_graph_nodes",), ("maxNodes",), ("ReefGlacier",), ("Reef",), (None,)], "n string")
    assert [r[0] for r in n.select(records.suspicious_name(F.col("n"))).collect()] == ["variable", "variable", "glued", None, None]


def test_vector_space_gate():
    space = stores.check_space(None, "hash", 64)
    assert stores.check_space(space, "hash", 64) == space
    with pytest.raises(ValueError):
        stores.check_space(space, "hash", 32)


def test_counters(spark):
    df, seen = stores.counted(spark.range(5), "ids", most=F.max("id"))
    df.collect()
    assert seen.get == {"rows": 5, "most": 4}


def test_scratch_tables_go(spark):
    import os

    from graphloom import session

    with session.scratch(spark):
        df = session.cut(spark.range(3))
        where = session._TABLES[-1]
        assert df.count() == 3 and os.path.isdir(where.removeprefix("file:"))
    assert where not in session._TABLES and not os.path.isdir(where.removeprefix("file:"))
