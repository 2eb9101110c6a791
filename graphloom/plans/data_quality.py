"""Queries of the general data-quality problems: packed fields (5) and references that lead nowhere (7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators import packed, references
from graphloom.sources.tables import table, unique


def _packed(spark: SparkSession, d: str, only: tuple[str, ...] = ("source_id", "file_path", "properties")) -> DataFrame:
    parts = [packed.fields_of(unique(spark, d, t, "gid", *only), t, only) for t in ("graph_nodes", "graph_edges")]
    return packed.parse_packed(parts[0].unionByName(parts[1]))


def p5_values(spark: SparkSession, d: str) -> DataFrame:
    """Every value of every packed field with its position and the number of values in its field."""
    return packed.values_of(_packed(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """The values of fields that hold two or more."""
    return p5_values(spark, d).where("n_items > 1").select("tbl", "gid", "field", "pos", "item")


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    deletions = table(spark, d, "deletions")
    own = {t: unique(spark, d, t, "gid", "updated_at").select(F.lit(t).alias("tbl"), "gid", "updated_at") for t in ("graph_nodes", "graph_edges")}
    values = packed.values_of(_packed(spark, d, ("source_id",))).select("tbl", "gid", F.col("item").alias("ref_key"))
    from_sources = values.join(own["graph_nodes"].unionByName(own["graph_edges"]), ["tbl", "gid"]).select(
        "tbl", F.col("gid").cast("string").alias("row_key"), F.lit("source_id").alias("field"), "ref_key", "updated_at"
    )
    from_lists = table(spark, d, "entity_chunks").select(
        F.lit("entity_chunks").alias("tbl"), F.col("id").alias("row_key"), F.lit("chunk_ids").alias("field"), F.explode("chunk_ids").alias("ref_key"), "updated_at"
    )
    chunk_refs = from_sources.unionByName(from_lists).where(F.col("ref_key").rlike(references.CHUNK_FORM)).distinct()
    chunks = unique(spark, d, "text_chunks", "id", "created_at").select(F.col("id").alias("key"), "created_at")
    edges = unique(spark, d, "graph_edges", "gid", "src_id", "tgt_id", "updated_at")
    ends = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("ref_key")) for c in ("src_id", "tgt_id"))))
    node_refs = edges.select(F.lit("graph_edges").alias("tbl"), F.col("gid").cast("string").alias("row_key"), ends.alias("e"), "updated_at").select(
        "tbl", "row_key", "e.field", "e.ref_key", "updated_at"
    ).where("ref_key is not null")
    nodes = unique(spark, d, "graph_nodes", "gid", "id", "created_at").select(F.col("id").alias("key"), "created_at")
    # keys of each kind, missing ones among them, from the columns alone
    chunk_keys = references.count_keys(values.select("ref_key"), from_lists.select("ref_key"), table(spark, d, "text_chunks").select("id"))
    edge = table(spark, d, "graph_edges")
    node_keys = references.count_keys(edge.select(F.explode(F.array("src_id", "tgt_id"))), table(spark, d, "graph_nodes").select("id"))
    a = references.dangling(chunk_refs, chunks.groupBy("key").agg(F.min("created_at").alias("created_at")), "chunk", chunk_keys)
    b = references.dangling(node_refs, nodes.groupBy("key").agg(F.min("created_at").alias("created_at")), "node", node_keys)
    a = references.explain_missing(a, deletions, "doc_status", F.regexp_extract("ref_key", r"^(doc-[0-9a-f]{32})-chunk-", 1))
    b = references.explain_missing(b, deletions, "graph_nodes", F.col("ref_key"))
    return a.unionByName(b)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Each reference without a parent, or whose parent came later."""
    return _orphans(spark, d).select("tbl", "row_key", "field", "ref_key", "reason")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Orphan references per table, field, month of the referring row and reason (month null where the row has no time)."""
    return _orphans(spark, d).groupBy("tbl", "field", F.date_format("updated_at", "yyyy-MM").alias("month"), "reason").agg(F.count("*").alias("n"))


_P7_SQL = r"""
WITH n AS (SELECT DISTINCT gid, id, source_id, created_at, updated_at FROM graph_nodes),
e AS (SELECT DISTINCT gid, src_id, tgt_id, source_id, updated_at FROM graph_edges),
c AS (SELECT DISTINCT id, created_at FROM text_chunks),
cr AS (
  SELECT DISTINCT tbl, row_key, field, ref_key, updated_at FROM (
    SELECT 'graph_nodes' AS tbl, CAST(gid AS VARCHAR) AS row_key, 'source_id' AS field, unnest(regexp_extract_all(source_id, 'doc-[0-9a-f]{32}-chunk-[0-9]+')) AS ref_key, updated_at FROM n
    UNION ALL SELECT 'graph_edges', CAST(gid AS VARCHAR), 'source_id', unnest(regexp_extract_all(source_id, 'doc-[0-9a-f]{32}-chunk-[0-9]+')), updated_at FROM e
    UNION ALL SELECT 'entity_chunks', id, 'chunk_ids', unnest(chunk_ids), updated_at FROM entity_chunks)
  WHERE regexp_full_match(ref_key, 'doc-[0-9a-f]{32}-chunk-[0-9]+')),
nr AS (
  SELECT 'graph_edges' AS tbl, CAST(gid AS VARCHAR) AS row_key, 'src_id' AS field, src_id AS ref_key, updated_at FROM e WHERE src_id IS NOT NULL
  UNION ALL SELECT 'graph_edges', CAST(gid AS VARCHAR), 'tgt_id', tgt_id, updated_at FROM e WHERE tgt_id IS NOT NULL),
o AS (
  SELECT cr.*, CASE WHEN c.id IS NOT NULL THEN 'late' WHEN d.record_key IS NOT NULL THEN 'deleted' ELSE 'missing' END AS reason
  FROM cr LEFT JOIN c ON c.id = cr.ref_key LEFT JOIN (SELECT DISTINCT record_key FROM deletions WHERE tbl = 'doc_status') d ON d.record_key = left(cr.ref_key, 36)
  WHERE c.id IS NULL OR c.created_at > cr.updated_at
  UNION ALL
  SELECT nr.*, CASE WHEN n.id IS NOT NULL THEN 'late' WHEN d.record_key IS NOT NULL THEN 'deleted' ELSE 'missing' END
  FROM nr LEFT JOIN n ON n.id = nr.ref_key LEFT JOIN (SELECT DISTINCT record_key FROM deletions WHERE tbl = 'graph_nodes') d ON d.record_key = nr.ref_key
  WHERE n.id IS NULL OR n.created_at > nr.updated_at)
"""

QUERIES = {"p5_found": p5_found, "p5_values": p5_values, "p7_found": p7_found, "p7_report": p7_report}
SQL = {
    "p7_found": _P7_SQL + "SELECT tbl, row_key, field, ref_key, reason FROM o",
    "p7_report": _P7_SQL + "SELECT tbl, field, strftime(updated_at, '%Y-%m') AS month, reason, count(*) AS n FROM o GROUP BY 1, 2, 3, 4",
}
