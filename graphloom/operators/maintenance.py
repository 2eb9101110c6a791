"""Maintenance: vector rows rebuilt from the graph, caches cleaned and copied, tracking and provenance audited and repaired.

Cases: null lists hold no references; an object whose every reference is gone keeps an empty list; unknown files leave paths alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import SEP, parts

MODES = ("mix", "hybrid", "local", "global", "naive")


def entity_vectors(nodes: DataFrame) -> DataFrame:
    """(id, content) of the vector rows of nodes (id, description)."""
    return nodes.select(F.concat(F.lit("ent-"), F.md5("id")).alias("vid"), F.concat("id", F.lit("\n"), F.coalesce("description", F.lit(""))).alias("content"))


def relation_vectors(pairs: DataFrame) -> DataFrame:
    """(vid, content) of the vector rows of pairs (a, b, keywords, description)."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    return pairs.select(F.concat(F.lit("rel-"), F.md5(F.concat("a", "b"))).alias("vid"), F.concat(blank(F.col("keywords")), F.lit("\t"), "a", F.lit("\n"), "b", F.lit("\n"), blank(F.col("description"))).alias("content"))


def is_query_answer(key: Column) -> Column:
    """Whether a cache key belongs to a query mode."""
    return key.rlike("^(" + "|".join(MODES) + "):")


def anchor_gaps(provenance: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, name, gap): names that a document's chunks mention but its anchors do not list, and the other way round. Both: doc_id,
    name."""
    p, a = provenance.select("doc_id", "name").distinct(), anchors.select("doc_id", "name").distinct()
    lost = p.join(a, ["doc_id", "name"], "left_anti").withColumn("gap", F.lit("not anchored"))
    return lost.unionByName(a.join(p, ["doc_id", "name"], "left_anti").withColumn("gap", F.lit("no provenance")))


def live_references(tracking: DataFrame, live: DataFrame, form: str) -> DataFrame:
    """(id, kept, dropped): tracked chunk ids of the form that are still there, and how many are not. Others are kept as they are."""
    x = tracking.select("id", F.posexplode("chunk_ids").alias("i", "s")).where("s is not null")
    y = x.join(live.select(F.col("id").alias("s"), F.lit(True).alias("there")).distinct(), "s", "left")
    kept = F.col("there").isNotNull() | ~F.col("s").rlike(form)
    return y.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.when(kept, F.struct("i", "s")))), lambda v: v["s"]).alias("kept"), F.sum((~kept).cast("long")).alias("dropped"))


def wrong_counts(tracking: DataFrame) -> DataFrame:
    """(id, chunk_count, real) of rows whose count is not the size of their list."""
    real = F.when(F.col("chunk_ids").isNull(), 0).otherwise(F.size("chunk_ids"))
    return tracking.select("id", "chunk_count", real.alias("real")).where(F.col("chunk_count").isNull() | (F.col("chunk_count") != F.col("real")))


def orphan_tracking(tracking: DataFrame, nodes: DataFrame) -> DataFrame:
    return tracking.select("id").join(nodes.select("id"), "id", "left_anti")


def provenance(nodes: DataFrame) -> DataFrame:
    """(doc_id, name) by the chunks of nodes (id, source_id)."""
    x = nodes.select(F.col("id").alias("name"), F.explode(parts(F.col("source_id"))).alias("s"))
    return x.select(F.regexp_extract("s", "^(doc-[0-9a-f]{32})-chunk-", 1).alias("doc_id"), "name").where("doc_id <> ''").distinct()


def repaired_tracking(tracking: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, chunk_ids, chunk_count): tracking rows of names that exist, with null lists empty and the count that of the list; names
    without a row get one from their own sources. nodes: id, source_id."""
    empty = F.array().cast("array<string>")
    own = nodes.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list(F.filter(parts(F.col("source_id")), lambda x: x.startswith("doc-"))))).alias("_own"))
    x = own.join(tracking.select("id", F.coalesce("chunk_ids", empty).alias("chunk_ids")), "id", "left")
    return x.select("id", F.coalesce("chunk_ids", F.array_sort("_own")).alias("chunk_ids")).withColumn("chunk_count", F.size("chunk_ids"))


def live_paths(rows: DataFrame, live: DataFrame, files: DataFrame, form: str, key: str) -> DataFrame:
    """(key, source_id, file_path, dropped) of rows (key, source_id, file_path): chunk ids of the form that are not live are dropped, others
    stay in order; where any was, the files are rebuilt from the documents of the kept ones in order, unless one of them is unknown.
    live: id; files: doc, file (one row a document)."""
    x = rows.select(key, F.posexplode(parts(F.col("source_id"))).alias("i", "s"))
    x = x.join(live.select(F.col("id").alias("s"), F.lit(True).alias("there")).distinct(), "s", "left")
    x = x.withColumn("keep", F.col("there").isNotNull() | ~F.col("s").rlike(form)).withColumn("doc", F.when(F.col("s").rlike(form), F.regexp_extract("s", "^(doc-[0-9a-f]{32})-", 1)))
    x = x.join(files.select("doc", "file"), "doc", "left")
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("keep") & F.col(c).isNotNull(), F.struct("i", c)))), lambda v: v[c])
    y = x.groupBy(key).agg(
        F.array_join(in_order("s"), SEP).alias("_ids"), F.array_join(F.array_distinct(in_order("file")), SEP).alias("_files"), F.sum((~F.col("keep")).cast("long")).alias("dropped"),
        F.max(F.coalesce(F.col("keep") & F.col("doc").isNotNull() & F.col("file").isNull(), F.lit(False))).alias("_unknown"),
    )
    z = rows.select(key, "source_id", "file_path").join(y, key, "left").na.fill(0, ["dropped"])
    hit = F.col("dropped") > 0
    return z.select(key, F.when(hit, F.col("_ids")).otherwise(F.col("source_id")).alias("source_id"), F.when(hit & ~F.col("_unknown"), F.col("_files")).otherwise(F.col("file_path")).alias("file_path"), "dropped")


def chunk_vectors(chunks: DataFrame) -> DataFrame:
    """(vid, content) of the vector rows of chunks (id, content)."""
    return chunks.where("content is not null").select(F.concat(F.lit("chunk-"), F.md5("id")).alias("vid"), "content")


def without_workspace(tables: dict[str, DataFrame], workspace: str) -> dict[str, DataFrame]:
    """All tables (with a column workspace) without the rows of one workspace; rows of none stay."""
    return {name: df.where(F.col("workspace").isNull() | (F.col("workspace") != workspace)) for name, df in tables.items()}
