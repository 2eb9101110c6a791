"""Undirected graphs as node and pair tables: degrees, neighbourhoods, views, deletion, renaming and merging.

A pair table has a < b (code-point order) and one row per pair. Lookups by either end are unions of two equi-joins, never an
OR join. Cases: null ends, and edges of a node with itself, are no edges; isolated nodes have degree 0; ties end with the
label; empty tables give empty results.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import SEP, evidence, parts, strip


def canonical(edges: DataFrame, newest: str = "updated_at", tie: str = "gid") -> DataFrame:
    """One row per undirected pair (a, b): the newest of its rows in both directions. The winner comes from an aggregation with
    map-side combine, so that a pair that is sent often costs one row per task."""
    e = edges.where("src_id is not null and tgt_id is not null and src_id <> tgt_id")
    e = e.select(F.least("src_id", "tgt_id").alias("a"), F.greatest("src_id", "tgt_id").alias("b"), F.struct(*(c for c in edges.columns if c not in ("src_id", "tgt_id"))).alias("row"))
    won = e.groupBy("a", "b").agg(F.max_by("row", F.struct(F.coalesce(F.col(f"row.{newest}").cast("timestamp_ntz"), F.lit("0001-01-01").cast("timestamp_ntz")), F.col(f"row.{tie}"))).alias("row"))
    return won.select("a", "b", "row.*")


def adjacency(pairs: DataFrame, *carry: str) -> DataFrame:
    """Each pair from both ends: node, nbr."""
    one = pairs.select(F.col("a").alias("node"), F.col("b").alias("nbr"), *carry)
    return one.unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("nbr"), *carry))


def degrees(pairs: DataFrame) -> DataFrame:
    """(id, degree) of every node with a pair; counted before the shuffle, so a hub is one row per task."""
    return adjacency(pairs).groupBy(F.col("node").alias("id")).agg(F.count("*").alias("degree"))


def with_degree(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    return nodes.join(degrees(pairs), "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0).cast("long")))


def edge_degrees(pairs: DataFrame) -> DataFrame:
    """Adds rank = degree(a) + degree(b)."""
    d = degrees(pairs)
    da, db = d.select(F.col("id").alias("a"), F.col("degree").alias("_da")), d.select(F.col("id").alias("b"), F.col("degree").alias("_db"))
    return pairs.join(da, "a").join(db, "b").withColumn("rank", F.col("_da") + F.col("_db")).drop("_da", "_db")


def popular(nodes: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    return with_degree(nodes.select("id"), pairs).orderBy(F.desc("degree"), "id").limit(n)


def label_score(label: Column, query: str) -> Column:
    """1000 for the label itself, 500 for a beginning, 100 less the length for a part, with 50 more at a word's beginning."""
    q, low = query.lower(), F.lower(label)
    at_word = low.contains(f" {q}") | low.contains(f"_{q}")
    part = F.lit(100) - F.length(label) + F.when(at_word, 50).otherwise(0)
    return F.when(low == q, 1000).when(low.startswith(q), 500).when(low.contains(q), part)


def search_labels(nodes: DataFrame, query: str, n: int) -> DataFrame:
    return nodes.select("id", label_score(F.col("id"), query).alias("score")).where("score is not null").orderBy(F.desc("score"), "id").limit(n)


#: Up to so many names are a filter that reaches the scan; a longer list, which only costs time to plan, is a local table.
FILTER_NAMES = 20


def beside(edges: DataFrame, names: list[str]) -> DataFrame:
    """(node, nbr) of stored edges (src_id, tgt_id) at a bounded list of names, from either end, with their copies. Edges are filtered
    where they lie, and nothing is shuffled."""
    e = edges.where("src_id is not null and tgt_id is not null and src_id <> tgt_id")
    if len(names) <= FILTER_NAMES:
        hit = lambda a: e.where(F.col(a).isin(names))
    else:
        asked = _named(edges.sparkSession, names)
        hit = lambda a: e.join(F.broadcast(asked.withColumnRenamed("id", a)), a, "left_semi")
    one = lambda a, b: hit(a).select(F.col(a).alias("node"), F.col(b).alias("nbr"))
    return one("src_id", "tgt_id").unionByName(one("tgt_id", "src_id"))


def _named(spark, names: list[str]) -> DataFrame:
    return spark.createDataFrame(pa.table({"id": pa.array(names, pa.string())}))


def subgraph(nodes: DataFrame, edges: DataFrame, start: str, depth: int, cap: int) -> DataFrame:
    """(id, level, truncated) of the nodes around a label: breadth first, each level in the order degree, label; at most ``cap`` nodes;
    truncated tells whether that left any out. edges: src_id, tgt_id as stored.

    Edges are filtered by the frontier where they lie, and degrees are counted for the candidates alone, so the work follows the
    neighbourhood and not the graph. What the driver holds never exceeds ``cap`` names."""
    spark = nodes.sparkSession
    e = edges.where("src_id is not null and tgt_id is not null and src_id <> tgt_id")
    both = e.select(F.col("src_id").alias("id"), F.col("tgt_id").alias("nbr")).unionByName(e.select(F.col("tgt_id").alias("id"), F.col("src_id").alias("nbr")))
    frontier = [start] if nodes.where(F.col("id") == start).limit(1).count() else []
    found, cut_off = [(x, 0) for x in frontier], False
    for level in range(1, depth + 1):
        if not frontier or len(found) >= cap:
            break
        near = beside(edges, frontier).select(F.col("nbr").alias("id")).distinct()
        near = near.join(F.broadcast(_named(spark, [x for x, _ in found])), "id", "left_anti").join(nodes.select("id"), "id", "left_semi")
        degree = both.join(near, "id", "left_semi").groupBy("id").agg(F.count_distinct("nbr").alias("degree"))
        # one row more than there is room for tells that some are left out
        got = [r["id"] for r in degree.orderBy(F.desc("degree"), "id").limit(cap - len(found) + 1).collect()]
        cut_off = cut_off or len(got) > cap - len(found)
        frontier = got[: cap - len(found)]
        found += [(x, level) for x in frontier]
    return spark.createDataFrame([(x, n, cut_off) for x, n in found], "id string, level int, truncated boolean")


def induced(pairs: DataFrame, ids: DataFrame) -> DataFrame:
    """The pairs with both ends among ``ids``."""
    return pairs.join(ids.select(F.col("id").alias("a")), "a", "left_semi").join(ids.select(F.col("id").alias("b")), "b", "left_semi")


def without_nodes(pairs: DataFrame, gone: DataFrame) -> DataFrame:
    """The pairs with neither end among ``gone`` (id)."""
    return pairs.join(gone.select(F.col("id").alias("a")), "a", "left_anti").join(gone.select(F.col("id").alias("b")), "b", "left_anti")


def redirect(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs (a, b, weight, source_id, file_path, keywords, description, gid) after names (old, new) are replaced: self-loops go, and
    equal pairs become one. Weight is the greatest of the inputs and the number of distinct real sources; sources and files are
    united in the order of gid, keywords united and sorted, distinct descriptions joined in that order. Pairs without a replaced end
    pass through the same rules."""
    m = names.select("old", "new").where("old <> new")
    p = pairs.join(m.select(F.col("old").alias("a"), F.col("new").alias("_na")), "a", "left").join(m.select(F.col("old").alias("b"), F.col("new").alias("_nb")), "b", "left")
    p = p.withColumn("_a", F.coalesce("_na", "a")).withColumn("_b", F.coalesce("_nb", "b")).where("_a <> _b").withColumn("a", F.least("_a", "_b")).withColumn("b", F.greatest("_a", "_b"))
    joined = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("gid", parts(F.col(c)).alias("v")))), lambda x: x["v"])
    united = lambda c: F.array_join(F.array_distinct(F.flatten(joined(c))), SEP)
    every = p.groupBy("a", "b").agg(
        F.max("weight").alias("_w"), united("source_id").alias("source_id"), united("file_path").alias("file_path"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(parts(F.translate(F.col("keywords"), "，", ","), ","))))), ",").alias("keywords"),
        F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(strip(F.col("description")) != "", F.struct("gid", "description")))), lambda x: x["description"])), SEP).alias("description"),
    )
    floor = F.size(evidence(parts(F.col("source_id")))).cast("double")
    return every.select("a", "b", F.greatest(F.coalesce("_w", F.lit(0.0)), floor).alias("weight"), "source_id", "file_path", "keywords", "description")


def redirect_nodes(nodes: DataFrame, names: DataFrame) -> DataFrame:
    """Nodes (id, entity_type, description, source_id, file_path, gid) after names (old, new) are replaced: one row a name. The type is
    the first, distinct descriptions are joined, sources and files united, the merged ones before the target's own."""
    m = names.select(F.col("old").alias("id"), F.col("new").alias("_n")).where("id <> _n")
    n = nodes.join(m, "id", "left").withColumn("_o", F.struct(F.col("_n").isNull().cast("int").alias("k"), "gid")).withColumn("id", F.coalesce("_n", "id"))
    in_order = lambda v: F.transform(F.array_sort(F.collect_list(F.struct("_o", v.alias("v")))), lambda x: x["v"])
    united = lambda c: F.array_join(F.array_distinct(F.flatten(in_order(parts(F.col(c))))), SEP)
    text = F.when(strip(F.coalesce("description", F.lit(""))) != "", F.col("description"))
    return n.groupBy("id").agg(
        F.min_by("entity_type", F.when(strip(F.col("entity_type")) != "", F.col("_o"))).alias("entity_type"),
        F.array_join(F.array_distinct(F.filter(in_order(text), lambda x: x.isNotNull())), SEP).alias("description"), united("source_id").alias("source_id"), united("file_path").alias("file_path"),
    )


def redirect_tracking(tracking: DataFrame, names: DataFrame) -> DataFrame:
    """Tracking rows (id, chunk_ids) after names are replaced: lists united in the order of the old ids, with their count."""
    m = names.select(F.col("old").alias("id"), F.col("new").alias("_n")).where("id <> _n")
    t = tracking.join(m, "id", "left").select(F.coalesce("_n", "id").alias("id"), F.struct(F.col("_n").isNull().alias("k"), "id").alias("_o"), F.coalesce("chunk_ids", F.array().cast("array<string>")).alias("v"))
    lists = F.transform(F.array_sort(F.collect_list(F.struct("_o", "v"))), lambda x: x["v"])
    united = t.groupBy("id").agg(F.array_distinct(F.filter(F.flatten(lists), lambda x: x.isNotNull())).alias("chunk_ids"))
    return united.withColumn("chunk_count", F.size("chunk_ids"))


def edited(pairs: DataFrame, edits: DataFrame) -> DataFrame:
    """Pairs after edits (a, b, weight; one row a pair) of their weights, with the outcome: kept, edited, or refused where the new weight
    is below the number of distinct real sources or not above 0."""
    e = evidence_counts(pairs).join(edits.select("a", "b", F.col("weight").alias("_new"), F.lit(True).alias("_asked")), ["a", "b"], "left")
    fine = (F.col("_new") > 0) & (F.col("_new") >= F.col("evidence"))
    outcome = F.when(F.col("_asked").isNull() | F.col("_new").isNull(), "kept").when(fine, "edited").otherwise("refused")
    return e.select("a", "b", F.when(outcome == "edited", F.col("_new")).otherwise(F.col("weight")).alias("weight"), outcome.alias("outcome"))


def created(nodes: DataFrame, pairs: DataFrame, asked: DataFrame) -> DataFrame:
    """(src_id, tgt_id, state) of asked relations: created where both ends exist and no relation of them is stored, else why not."""
    a = asked.where("src_id is not null and tgt_id is not null").select("src_id", "tgt_id").distinct()
    hit = lambda c, x: nodes.select(F.col("id").alias(c), F.lit(True).alias(x)).distinct()
    x = a.withColumn("a", F.least("src_id", "tgt_id")).withColumn("b", F.greatest("src_id", "tgt_id"))
    x = x.join(hit("src_id", "_s"), "src_id", "left").join(hit("tgt_id", "_t"), "tgt_id", "left").join(pairs.select("a", "b", F.lit(True).alias("_e")), ["a", "b"], "left")
    state = F.when(F.col("src_id") == F.col("tgt_id"), "self-loop").when(F.col("_s").isNull() | F.col("_t").isNull(), "endpoint missing").when(F.col("_e"), "exists").otherwise("created")
    return x.select("src_id", "tgt_id", state.alias("state"))


def evidence_counts(df: DataFrame) -> DataFrame:
    """Adds evidence: the number of distinct real sources."""
    return df.withColumn("evidence", F.size(evidence(parts(F.col("source_id")))).cast("long"))


def keyset(df: DataFrame, key: str, after: str, n: int) -> DataFrame:
    """The page of ``n`` rows after a key."""
    return df.where(F.col(key) > after).orderBy(key).limit(n)


def first_seen(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
