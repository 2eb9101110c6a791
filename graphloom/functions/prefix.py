"""Running sums over groups of any size, without ever sorting one group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, keys: list[str], order: list[Column], size: Column, bucket: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``size`` over the rows of the same keys that come before, in the order (bucket, *order).

    ``bucket`` cuts each group into pieces that fit a task. Pieces are summed first (a small table, one row a piece), the
    pieces' own running totals are a window over that table, and rows are only sorted within a piece."""
    df = df.withColumn("_b", bucket).withColumn("_s", size)
    sums = df.groupBy(*keys, "_b").agg(F.sum("_s").alias("_t"))
    before = F.coalesce(F.sum("_t").over(Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_b").alias("_c"), before.alias("_start"))
    within = F.coalesce(F.sum("_s").over(Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_b") == F.col("_c")]
    joined = df.withColumn("_w", within).join(starts, on)
    return joined.withColumn(out, F.col("_start") + F.col("_w")).drop("_b", "_s", "_w", "_c", "_start", *(f"_k{i}" for i in range(len(keys))))
