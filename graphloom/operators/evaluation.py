"""Retrieval evaluation: a TF-IDF ranker and its measures.

Cases: null and empty texts hold no terms; a query without known terms has no hits; ties go to the smaller name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from graphloom.operators import topdocs
from graphloom.session import cut

# Words the ranker skips.
STOP = "a an and are as at be by for from in is it its of on or that the this to was were with which".split()


def terms(text: Column) -> Column:
    """ASCII words of two characters or more, in small letters, without stop words; pairs of wide characters."""
    words = F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"([a-z0-9]{2,})"), 1), lambda w: ~w.isin(*STOP))
    wide = F.regexp_extract_all(text, F.lit(r"(?=([\x{4E00}-\x{9FFF}]{2}))"), 1)
    return F.concat(words, wide)


def tfidf(docs: DataFrame, queries: DataFrame, k: int, block: int = 3_000_000) -> DataFrame:
    """(query, name, score, rank): documents (name, text) for queries (query, text). Texts are read once: only the terms that a query asks for
    are counted, by (name, term) before the shuffle, and kept as a table. Queries of the same terms are ranked once, in blocks of about so many
    counts, whose lists of k meet in the end."""
    spark = docs.sparkSession
    asked = cut(queries.select("query", F.explode(terms(F.col("text"))).alias("t")).distinct())
    words = cut(asked.select("t").distinct().withColumn("tid", F.monotonically_increasing_id()))
    tf = cut(docs.select("name", F.explode(terms(F.col("text"))).alias("t")).join(words, "t").groupBy("name", "tid").agg(F.count("*").alias("tf")))
    n, rows = docs.count(), tf.count()
    weights = tf.groupBy("tid").agg((F.log((F.lit(float(n)) + 1) / (F.count("*") + 1)) + 1).alias("w"))
    per = cut(asked.join(words, "t").join(weights, "tid").groupBy("query").agg(F.sort_array(F.collect_list(F.struct("tid", "w"))).alias("terms")))
    sets = cut(per.select("terms").distinct().withColumn("sid", F.monotonically_increasing_id()))
    cores = spark.sparkContext.defaultParallelism
    blocks = min(cores, 1 + rows // 20_000) if rows <= cores * block else cores * math.ceil(rows / (cores * block))
    kind = tf.schema["name"].dataType
    counts = tf.select(F.pmod(F.xxhash64("name"), F.lit(blocks)).cast("int").alias("block"), "name", "tid", F.col("tf").cast("double").alias("x"), F.lit(None).cast("long").alias("sid"))
    every = sets.select("sid", F.explode("terms").alias("m")).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast(kind).alias("name"), "m.tid", F.col("m.w").alias("x"), "sid")
    out = StructType([StructField("sid", LongType()), StructField("name", kind), StructField("score", DoubleType())])
    best = counts.unionByName(every).repartitionById(blocks, "block").mapInArrow(topdocs.ranker(k, to_arrow_schema(out)), out)
    w = Window.partitionBy("sid").orderBy(F.floor(F.col("score") * 1e9 + 0.5).desc(), F.col("name").asc_nulls_last())
    top = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return per.join(sets, "terms").select("query", "sid").join(top, "sid").select("query", "name", "score", "rank")


def measures(ranked: DataFrame, expected: DataFrame, k: int) -> DataFrame:
    """One row: queries, recall at k, mean reciprocal rank, full recall and queries without a hit. expected: query, name."""
    e = expected.join(ranked.where(F.col("rank") <= k).select("query", "name", "rank"), ["query", "name"], "left")
    per = e.groupBy("query").agg((F.count("rank") / F.count("*")).alias("recall"), F.coalesce(F.max(1 / F.col("rank")), F.lit(0.0)).alias("rr"))
    return per.agg(F.count("*").alias("queries"), F.avg("recall").alias("recall"), F.avg("rr").alias("mrr"), F.sum((F.col("recall") == 1).cast("long")).alias("full"), F.sum((F.col("recall") == 0).cast("long")).alias("none"))
