"""As-of, interval and range joins, sliding and session windows, histograms and grouping sets.

A key that holds a third of all rows is cut by time: rows meet within a bucket of time, and what the buckets before hand on is one row
a key and bucket. Cases: null keys and times meet nothing; of several rows at one time the one with the greatest tie wins; rows of
the left side without a partner stay with nulls; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, value: str, tie: str, bucket: str = "hour") -> DataFrame:
    """Every left row with the value of the last right row of its key at or before its time. Within a bucket of time both sides are
    sorted together; the last value of each bucket is handed on by a window over the buckets, which are few."""
    every = left.select(F.lit(1).alias("_side"), key, time, F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.schema[value].dataType).alias("_v"), F.lit(None).cast(right.schema[tie].dataType).alias("_t"))
    every = every.unionByName(right.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.lit(0).alias("_side"), key, time, F.lit(None).cast(every.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"), F.col(tie).alias("_t")))
    every = every.withColumn("_b", F.date_trunc(bucket, time)).withColumn("_x", F.when(F.col("_side") == 0, F.struct(F.col("_v").alias("v"))))
    last = every.where("_side = 0").groupBy(key, "_b").agg(F.max_by("_x", F.struct(time, "_t")).alias("_last"))
    buckets = every.select(key, "_b").distinct().join(last, [key, "_b"], "left")
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    handed = buckets.select(key, "_b", F.last("_last", True).over(before).alias("_before"))
    w = Window.partitionBy(key, "_b").orderBy(time, "_side", "_t").rowsBetween(Window.unboundedPreceding, 0)
    x = every.withColumn("_in", F.last("_x", True).over(w)).where("_side = 1").join(handed, [key, "_b"], "left")
    found = F.when(F.col(time).isNotNull(), F.coalesce("_in", "_before"))
    return x.select("_row.*", found["v"].alias(value))


def interval(left: DataFrame, right: DataFrame, key: str, time: str, seconds: int, ident: str) -> DataFrame:
    """(ident, other) of rows of one key whose right time lies within so many seconds after the left one. Both sides meet in bins of that
    length: a left row stands in its own bin and the next, so the join is an equi-join, and a hot key is many bins."""
    bin_ = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / (seconds * 1_000_000))
    a = left.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, F.col(time).alias("_l"), F.col(ident), F.explode(F.array(bin_(time), bin_(time) + 1)).alias("_b"))
    b = right.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, F.col(time).alias("_r"), F.col(ident).alias("other"), bin_(time).alias("_b"))
    apart = F.unix_micros(F.col("_r").cast("timestamp")) - F.unix_micros(F.col("_l").cast("timestamp"))
    return a.join(b, [key, "_b"]).where((apart >= 0) & (apart <= seconds * 1_000_000)).select(ident, "other")


def in_range(points: DataFrame, ranges: DataFrame, value: str, low: str, high: str, width: float, ident: str, name: str) -> DataFrame:
    """(ident, name) of points and the ranges [low, high) that hold them. Ranges stand in all bins of the width that they touch."""
    p = points.where(F.col(value).isNotNull()).select(ident, F.col(value).alias("_v"), F.floor(F.col(value) / width).alias("_b"))
    r = ranges.where(F.col(low) < F.col(high)).select(name, F.col(low).alias("_lo"), F.col(high).alias("_hi"), F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))).alias("_b"))
    return p.join(r, "_b").where("_v >= _lo and _v < _hi").select(ident, name)


def sliding(events: DataFrame, time: str, length: str, every: str, *keys: str, **measures: Column) -> DataFrame:
    """Aggregates in windows of a length that begin every so often; counted before the shuffle."""
    return events.groupBy(F.window(time, length, every).alias("_w"), *keys).agg(*(c.alias(k) for k, c in measures.items())).select(F.col("_w.start").alias("start"), *keys, *measures)


def sessions(events: DataFrame, time: str, gap: str, *keys: str, **measures: Column) -> DataFrame:
    """Aggregates in sessions that end after a gap without a row."""
    return events.groupBy(F.session_window(time, gap).alias("_w"), *keys).agg(*(c.alias(k) for k, c in measures.items())).select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *keys, *measures)


def histogram(df: DataFrame, value: str, edges: list[float], *keys: str) -> DataFrame:
    """(keys, bucket, n): counts by the number of edges that a value reaches (0 is below the first); null values count in none."""
    bucket = sum((F.when(F.col(value) >= e, 1).otherwise(0) for e in edges), F.lit(0))
    return df.where(F.col(value).isNotNull()).groupBy(*keys, bucket.alias("bucket")).agg(F.count("*").alias("n"))


def rolled_up(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, level, n): counts by the keys, by each prefix of them, and in all; level is the number of keys that were left out."""
    level = sum((F.grouping(k) for k in keys), F.lit(0))
    return df.rollup(*keys).agg(level.cast("int").alias("level"), F.count("*").alias("n"))
