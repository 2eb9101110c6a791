import datetime as dt

from pyspark.sql import functions as F

from graphloom.operators import references as r

T = dt.datetime


def test_reasons(spark, rows):
    refs = spark.createDataFrame([("e", "1", "f", "a", T(2024, 5, 2)), ("e", "1", "f", "b", T(2024, 5, 2)), ("e", "2", "f", "c", T(2024, 5, 2)), ("e", "3", "f", "c", None), ("e", "4", "f", "gone", T(2024, 1, 1)), ("e", "5", "f", "d", T(2024, 5, 20))], "tbl string, row_key string, field string, ref_key string, updated_at timestamp_ntz")
    parents = spark.createDataFrame([("a", T(2024, 1, 1)), ("c", T(2024, 6, 1)), ("d", T(2024, 5, 21))], "key string, created_at timestamp_ntz")
    deletions = spark.createDataFrame([("n", "gone")], "tbl string, record_key string")
    found = r.explain_missing(r.dangling(refs, parents, "x", 4), deletions, "n", F.col("ref_key"))
    assert rows(found, "row_key", "ref_key", "reason") == [("1", "b", "missing"), ("2", "c", "late"), ("4", "gone", "deleted"), ("5", "d", "late")]


def test_empty(spark):
    refs = spark.createDataFrame([], "tbl string, row_key string, field string, ref_key string, updated_at timestamp_ntz")
    parents = spark.createDataFrame([], "key string, created_at timestamp_ntz")
    assert r.dangling(refs, parents, "x", 4).count() == 0


def test_hot_key(spark):
    refs = spark.range(3000).select(F.lit("e").alias("tbl"), F.col("id").cast("string").alias("row_key"), F.lit("f").alias("field"), F.lit("hot").alias("ref_key"), F.lit("2024-05-02").cast("timestamp_ntz").alias("updated_at"))
    parents = spark.createDataFrame([("cold", T(2024, 1, 1))], "key string, created_at timestamp_ntz")
    assert r.dangling(refs, parents, "x", 4).count() == 3000


def test_bitmaps_round_trip():
    import numpy as np

    bits = np.array([0, 3, 99])
    assert list(np.flatnonzero(r.unpack(r.pack(bits, 100), 100))) == [0, 3, 99]
