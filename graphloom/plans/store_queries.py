"""Sources, sinks and injected functions over the library's tables, and windows over events."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from graphloom.functions import external
from graphloom.operators import merge, records
from graphloom.plans.graph_queries import ALL_SQL, names, pairs
from graphloom.sources import files, stores
from graphloom.sources.tables import table, unique


def s01_engines(spark, d):
    s = unique(spark, d, "doc_status", "file_path").where("file_path is not null")
    return s.select("id", files.engine(F.lower(F.trim("file_path"))).alias("engine"), files.hint(F.col("file_path")).alias("hint"))


def s02_markdown_blocks(spark, d):
    c = unique(spark, d, "text_chunks", "content").where("content is not null")
    return files.blocks_of(c, "id", "content").select("id", "pos", "level", "heading", F.size("parents").alias("depth"), F.length("content").alias("n"))


def _edge_batches(spark, d):
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "weight", "updated_at").select(F.col("src_id").alias("a"), F.col("tgt_id").alias("b"), "weight", F.col("gid").alias("seq"), "updated_at")
    late = F.coalesce(F.col("updated_at") >= F.lit("2024-07-01").cast("timestamp_ntz"), F.lit(False))
    return e.where(~late).drop("updated_at"), e.where(late).drop("updated_at")


def s10_node_properties(spark, d):
    """Properties of nodes merged key by key with a new type and a mark."""
    n = unique(spark, d, "graph_nodes", "id", "entity_type", "properties").where("id is not null")
    old = n.select("id", F.from_json("properties", "map<string,string>").alias("properties"), F.lit(1).cast("long").alias("seq"))
    new = n.select("id", F.create_map(F.lit("entity_type"), F.coalesce(F.upper("entity_type"), F.lit("")), F.lit("checked"), F.lit("yes")).alias("properties"), F.lit(2).cast("long").alias("seq"))
    m = stores.upsert_nodes(old, new)
    pairs_ = F.array_sort(F.transform(F.map_entries("properties"), lambda x: F.concat_ws("=", x["key"], F.coalesce(x["value"], F.lit("")))))
    return m.select("id", F.array_join(pairs_, "|").alias("properties"), "seq")


def s10_graph_sink(spark, d):
    """Edges of the last months written over those before: the last row of each pair stays."""
    old, new = _edge_batches(spark, d)
    return stores.upsert_edges(names(spark, d), old, new)[1]


def s10_sink_nodes(spark, d):
    """Nodes after the upsert of all edges: the ends without a node among them."""
    old, new = _edge_batches(spark, d)
    return stores.upsert_edges(names(spark, d), old, new)[0]


def s12_export_rows(spark, d):
    """The relationship dump as its rows."""
    return pairs(spark, d).select(F.col("a").alias("source"), F.col("b").alias("target"), F.coalesce("weight", F.lit(1.0)).alias("weight"), F.coalesce("source_id", F.lit("")).alias("source_id"))


def s12_export_lines(spark, d):
    """The relationship dump as the lines of its Markdown file."""
    return files.export_lines(pairs(spark, d).select("a", "b", "source_id"), "md")


def s13_custom_graph(spark, d):
    """Stored edges given as a user's relations: which are taken, and why others are refused."""
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "weight").select("gid", F.col("src_id").alias("src"), F.col("tgt_id").alias("tgt"), (F.col("weight") - 1).alias("weight"))
    return stores.checked_relations(e)


def s07_sidecar(spark, d):
    """Blocks, tables, drawings and equations of all chunks."""
    c = unique(spark, d, "text_chunks", "content").where("content is not null").select("id", "content")
    whole = None
    for name, df in files.sidecar(c, "id", "content").items():
        x = df.groupBy("doc").agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "doc", "n")
        whole = x if whole is None else whole.unionByName(x)
    return whole


def r25_keywords(spark, d):
    """The five rarest words of each paper's title."""
    return external.rare_keywords(unique(spark, d, "papers", "title"), table(spark, d, "documents"), "paper_id", "title", "text")


def s17_tables(spark, d):
    """Rows and headers of chunks that hold an HTML table."""
    c = unique(spark, d, "text_chunks", "content").where("lower(content) like '%<table%'")

    @F.pandas_udf("struct<rows int, header boolean>")
    def look(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"rows": [len(files.table_rows(t)) for t in texts], "header": [files.has_header(t) for t in texts]})

    return c.select("id", look("content").alias("t")).select("id", "t.rows", "t.header")


def r24_rerank(spark, d):
    c = unique(spark, d, "text_chunks", "content").where("content is not null")
    return external.rerank(c, "tidal archive survey", "content").select("id", F.round("rerank_score", 6).alias("score"))


def r25_embedding(spark, d):
    """Each distinct paragraph-sized text is embedded once; the length of the vector and its norm."""
    t = table(spark, d, "documents").select("doc_id", "text").where("text is not null")
    e = external.embed(t, "text")
    return e.select("doc_id", F.size("vector").alias("dim"))


def d10_extraction(spark, d):
    """Entity records that the rule extractor finds in chunks, through the delimited form."""
    c = unique(spark, d, "text_chunks", "content").select("id", "content").where("content is not null")
    replies = external.extract(c, passes=2)
    parsed = records.parse_reply(replies.withColumn("key", F.struct("id", "pass")), "key", "reply")
    # of the passes over a chunk the longer description of a name stays
    e = records.entity_records(parsed, "key").select("key.id", "key.pass", "name", "type", "description")
    return merge.gleaned(e, ["id", "name"]).groupBy("id").agg(F.count("*").alias("entities"))


def d14_event_windows(spark, d):
    """Events by type in windows of five minutes."""
    e = table(spark, d, "events")
    return e.groupBy(F.window("ts", "5 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")


QUERIES = {f.__name__: f for f in (s01_engines, s02_markdown_blocks, s07_sidecar, s10_graph_sink, s10_sink_nodes, s10_node_properties, s12_export_rows, s12_export_lines, s13_custom_graph, r25_keywords, s17_tables, r24_rerank, r25_embedding, d10_extraction, d14_event_windows)}
_ENDING = "regexp_extract(lower(trim(file_path)), '\\.([A-Za-z0-9]+)$', 1)"
_LEGACY = "'" + "', '".join(files.ENGINES["legacy"]) + "'"
SQL = {
    "s01_engines": f"SELECT id, CASE WHEN {_ENDING} IN ('docx', 'md', 'markdown', 'textpack') THEN 'native' WHEN {_ENDING} IN ({_LEGACY}) THEN 'legacy' END AS engine, nullif(regexp_extract(file_path, '\\[([a-z]+)[^\\]]*\\]\\.[A-Za-z0-9]+$', 1), '') AS hint FROM (SELECT DISTINCT id, file_path FROM doc_status WHERE file_path IS NOT NULL)",
    "s10_sink_nodes": "SELECT DISTINCT id FROM (SELECT id FROM graph_nodes WHERE id IS NOT NULL UNION ALL SELECT src_id FROM graph_edges WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL AND src_id <> tgt_id UNION ALL SELECT tgt_id FROM graph_edges WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL AND src_id <> tgt_id)",
    "s12_export_rows": f"{ALL_SQL} SELECT a AS source, b AS target, coalesce(weight, 1.0) AS weight, coalesce(source_id, '') AS source_id FROM p",
    "s13_custom_graph": "SELECT gid, src_id AS src, tgt_id AS tgt, coalesce(weight - 1, 1.0) AS weight, CASE WHEN src_id IS NULL OR tgt_id IS NULL THEN 'end missing' WHEN src_id = tgt_id THEN 'self-loop' WHEN coalesce(weight - 1, 1.0) <= 0 THEN 'weight' END AS refused FROM (SELECT DISTINCT gid, src_id, tgt_id, weight FROM graph_edges)",
    "s12_export_lines": f"{ALL_SQL} SELECT '| ' || a || ' | ' || b || ' | ' || coalesce(source_id, '') || ' |' AS value FROM p",
    "s10_node_properties": "WITH n AS (SELECT DISTINCT gid, id, entity_type, properties FROM graph_nodes WHERE id IS NOT NULL), k AS (SELECT id, unnest(json_keys(properties)) AS k, properties FROM n WHERE properties IS NOT NULL), kv AS (SELECT id, k, coalesce(json_extract_string(properties, '$.' || k), '') AS v FROM k WHERE k NOT IN ('entity_type', 'checked') UNION ALL SELECT id, 'entity_type', coalesce(upper(entity_type), '') FROM n UNION ALL SELECT id, 'checked', 'yes' FROM n) SELECT id, string_agg(k || '=' || v, '|' ORDER BY k || '=' || v) AS properties, CAST(2 AS BIGINT) AS seq FROM kv GROUP BY id",
    "r25_keywords": "WITH q AS (SELECT DISTINCT paper_id, unnest(regexp_extract_all(lower(title), '[a-z]{3,}')) AS word FROM papers), df AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS word FROM documents) GROUP BY 1) SELECT paper_id, word, row_number() OVER (PARTITION BY paper_id ORDER BY coalesce(df, 0), word) AS rank FROM q LEFT JOIN df USING (word) QUALIFY rank <= 5",
    "r24_rerank": "SELECT id, round(len(list_filter(['tidal', 'archive', 'survey'], lambda w: list_contains(regexp_extract_all(lower(content), '[\\p{L}\\p{M}\\p{N}_]+'), w))) / 3.0, 6) AS score FROM (SELECT DISTINCT id, content FROM text_chunks WHERE content IS NOT NULL)",
    "d10_extraction": "SELECT id, count(DISTINCT n) AS entities FROM (SELECT id, unnest(regexp_extract_all(content, '(?:^|[^\\p{L}\\p{M}\\p{N}_])([A-Z][a-z]{5,})', 1)) AS n, content FROM (SELECT DISTINCT id, content FROM text_chunks)) WHERE regexp_matches(content, '(?:^|[^\\p{L}\\p{M}\\p{N}_])' || n || '(?:$|[^\\p{L}\\p{M}\\p{N}_])') GROUP BY 1",
    "s17_tables": "SELECT id, CAST(len(regexp_extract_all(lower(content), '<tr')) AS INTEGER) AS rows, regexp_matches(lower(content), '<th[ >]') AS header FROM (SELECT DISTINCT id, content FROM text_chunks) WHERE lower(content) LIKE '%<table%'",
    "s10_graph_sink": "SELECT a, b, weight, seq FROM (SELECT a, b, weight, seq, row_number() OVER (PARTITION BY a, b ORDER BY seq DESC) AS r FROM (SELECT DISTINCT least(src_id, tgt_id) AS a, greatest(src_id, tgt_id) AS b, weight, gid AS seq FROM graph_edges WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL AND src_id <> tgt_id)) WHERE r = 1",
    "r25_embedding": "SELECT doc_id, 64 AS dim FROM documents WHERE text IS NOT NULL",
    "d14_event_windows": "SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS value FROM events GROUP BY 1, 2",
}
