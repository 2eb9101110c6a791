"""Chunking, record and text-quality operators over the library's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import tokens4
from graphloom.operators import chunking, graph, quality, records
from graphloom.plans.graph_queries import names, pairs
from graphloom.plans.retrieval_queries import bibliography_sql
from graphloom.sources.tables import table, unique

SIZE, OVERLAP = 400, 50


def documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


def c01_windows(spark, d):
    return chunking.windows(documents(spark, d), "text", SIZE, OVERLAP)


def c02_by_separator(spark, d):
    return chunking.by_separator(documents(spark, d), "doc_id", "text", "\n\n", SIZE, OVERLAP)


def c03_separator_only(spark, d):
    return chunking.by_separator(documents(spark, d), "doc_id", "text", "\n\n", 1_000_000, 0, only=True)


def c04_recursive(spark, d):
    return chunking.apply(documents(spark, d), "doc_id", "text", chunking.registry()["recursive"])


def c05_semantic(spark, d):
    return chunking.apply(documents(spark, d), "doc_id", "text", chunking.registry()["semantic"])


def c06_structured(spark, d):
    c = unique(spark, d, "text_chunks", "content").select("id", "content")
    return chunking.apply(c, "id", "content", chunking.registry()["structured"], "piece")


def c07_without_references(spark, d):
    """Paragraphs as blocks under their first line, without sections of references."""
    b = documents(spark, d).select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", "\n\n")).alias("pos", "content")).withColumn("heading", F.split("content", "\n")[0])
    return chunking.without_references(b).groupBy("doc").agg(F.count("*").alias("blocks"))


def c09_chunk_ids(spark, d):
    w = chunking.windows(documents(spark, d), "text", SIZE, OVERLAP)
    return chunking.chunk_ids(w).select("id", "doc_id", "tokens")


def c10_spans(spark, d):
    """Source span of each window and whether it starts at the end of the text's head."""
    w = chunking.windows(documents(spark, d), "text", SIZE, OVERLAP)
    return w.select("doc_id", "chunk_order_index", "start", (F.col("start") + F.col("tokens")).alias("end"))


def c11_rerank_windows(spark, d):
    """Windows of 480 tokens of four characters, 32 of overlap."""
    return chunking.windows(documents(spark, d), "text", 480 * 4, 32 * 4).select("doc_id", "chunk_order_index", tokens4(F.col("content")).alias("tokens"))


def c12_surroundings(spark, d):
    """Text around the first mention of a table."""
    at = F.instr("text", "Table ")
    x = documents(spark, d).where(at > 0).select("doc_id", chunking.surroundings(F.col("text"), at - 1, 200).alias("s"))
    return x.select("doc_id", "s.leading", "s.trailing")


def c12_all_surroundings(spark, d):
    """Text around every mention of a table, numbered in its document."""
    return chunking.mentions_around(documents(spark, d), "doc_id", "text", "Table ", 200)


def c12_table_context(spark, d):
    """Tables of chunks with their surroundings and first rows."""
    c = unique(spark, d, "text_chunks", "content").select("id", "content")
    return chunking.table_context(c, "id", "content", 400)


def d09_options(spark, d):
    """Documents cut by the chunker that their options ask for (a sign by source)."""
    t = table(spark, d, "documents").select("doc_id", "text", F.translate(F.substring(F.upper("source"), 1, 1), "AEKMNI", "FRVP!F").alias("options"))
    return chunking.by_option(t, "doc_id", "text", "options", SIZE, OVERLAP).select("doc_id", "chunker", "chunk_order_index", F.length("content").alias("n"), "skip_graph")


def replies(spark, d) -> DataFrame:
    """Extraction replies made of the stored nodes and edges, one a node or edge."""
    n = unique(spark, d, "graph_nodes", "id", "entity_type", "properties")
    a = n.select(F.col("gid").alias("key"), F.concat(F.lit("(entity<|#|>"), "id", F.lit("<|#|>"), F.coalesce("entity_type", F.lit("")), F.lit("<|#|>"), F.coalesce(F.get_json_object("properties", "$.description"), F.lit("")), F.lit(")<|COMPLETE|>")).alias("reply"))
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "properties")
    kw, desc = (F.coalesce(F.regexp_replace(F.get_json_object("properties", f"$.{k}"), "\n", " "), F.lit("")) for k in ("keywords", "description"))
    b = e.select((F.col("gid") + 10_000_000).alias("key"), F.concat(F.lit("relation<|#|>"), F.coalesce("src_id", F.lit("")), F.lit("<|#|>"), F.coalesce("tgt_id", F.lit("")), F.lit("<|#|>"), kw, F.lit("<|#|>"), desc).alias("reply"))
    return a.unionByName(b)


T = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
NODE_SQL = "nn AS (SELECT DISTINCT gid AS key, id, entity_type, properties ->> '$.description' AS description FROM graph_nodes)"
EDGE_SQL = "ee AS (SELECT DISTINCT gid + 10000000 AS key, src_id, tgt_id, replace(properties ->> '$.keywords', chr(10), ' ') AS keywords, replace(properties ->> '$.description', chr(10), ' ') AS description FROM graph_edges)"


def f01_parse(spark, d):
    p = records.parse_reply(replies(spark, d), "key", "reply")
    return p.select("key", F.size("fields").alias("n"), F.lower(F.get("fields", F.lit(0))).alias("what"))


def f02_entities(spark, d):
    return records.entity_records(records.parse_reply(replies(spark, d), "key", "reply"), "key").select("key", "name", "type", "description")


def f03_relations(spark, d):
    return records.relation_records(records.parse_reply(replies(spark, d), "key", "reply"), "key").select("key", "src", "tgt", "keywords", "description", "weight")


def f04_json(spark, d):
    """Entities of JSON replies in code fences."""
    n = unique(spark, d, "graph_nodes", "id", "entity_type", "properties")
    reply = F.concat(F.lit("```json\n"), F.to_json(F.struct(F.array(F.struct(F.col("id").alias("name"), F.col("entity_type").alias("type"), F.get_json_object("properties", "$.description").alias("description"))).alias("entities"))), F.lit("\n```"))
    e, _ = records.json_records(n.select(F.col("gid").alias("key"), reply.alias("reply")), "key", "reply")
    return e.select("key", "name", "type", "description")


def f04_broken(spark, d):
    """Relations of JSON replies that break off in the record after them, with talk before."""
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "properties")
    one = F.struct(F.col("src_id").alias("source"), F.col("tgt_id").alias("target"), F.lit("k").alias("keywords"), F.get_json_object("properties", "$.description").alias("description"))
    whole = F.to_json(F.struct(F.array(one).alias("relationships")))
    reply = F.concat(F.lit("Here it is: "), F.regexp_replace(whole, r"\]\}$", ', {"source": "broken", "tar'))
    _, r = records.json_records(e.select(F.col("gid").alias("key"), reply.alias("reply")), "key", "reply")
    return r.select("key", "src", "tgt", "description")


def f05_name_cap(spark, d):
    """Titles joined to names that go beyond the cap."""
    p = table(spark, d, "papers").select("paper_id", F.repeat(F.coalesce("title", F.lit("")), 8).alias("name"))
    return p.select("paper_id", F.length(records.capped_name(F.col("name"))).alias("chars"), F.octet_length(records.capped_name(F.col("name"))).alias("bytes"))


def f06_symbolic(spark, d):
    w = documents(spark, d).select(F.explode(F.split("text", r"\s+")).alias("w")).where("w <> ''").distinct()
    return w.where(records.symbolic(F.col("w"))).select("w")


def f07_junk_names(spark, d):
    """Names, titles and chunk lines that are junk as entity names, with their kind."""
    n = names(spark, d).select(F.col("id").alias("name"))
    t = documents(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit(r"((?:Table|Figure|Section) [0-9]+|[A-Z]\. [A-Z][a-z]+)"), 1)).alias("name"))
    return n.unionByName(t).distinct().select("name", records.junk_kind(F.col("name")).alias("kind")).where("kind is not null")


def f08_without_junk(spark, d):
    p = records.parse_reply(replies(spark, d), "key", "reply")
    chunk = F.col("key") % 1000  # so that entities and relations share chunks
    e, r = (x.withColumn("key", chunk) for x in (records.entity_records(p, "key"), records.relation_records(p, "key")))
    _, r = records.without_junk(e, r, "key")
    return r.select("src", "tgt").distinct()


def f09_types(spark, d):
    allowed = records.listed_types("- Person: people\n- Method: ways\n- Dataset: data\n")
    return records.allowed_types(records.entity_records(records.parse_reply(replies(spark, d), "key", "reply"), "key"), allowed).groupBy("type").agg(F.count("*").alias("n"))


def f10_fold_keys(spark, d):
    return names(spark, d).select("id", records.fold_keys(F.col("id")).alias("key"))


def f11_fold_map(spark, d):
    return records.fold_map(graph.with_degree(names(spark, d), pairs(spark, d)).withColumnRenamed("id", "name"))


def f12_apply_fold(spark, d):
    m = records.fold_map(graph.with_degree(names(spark, d), pairs(spark, d)).withColumnRenamed("id", "name"))
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id").select("gid", "src_id", "tgt_id")
    return records.apply_map(records.apply_map(e, "src_id", m), "tgt_id", m)


def f12_apply_alias(spark, d):
    """Ends replaced by the first of the names that differ in case, spacing and signs only."""
    n = names(spark, d).withColumn("key", F.lower(F.regexp_replace("id", r"[\s.,'’-]+", "")))
    m = n.join(n.groupBy("key").agg(F.min("id").alias("canonical")), "key").select(F.col("id").alias("name"), "canonical")
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id").select("gid", "src_id", "tgt_id")
    return records.apply_map(records.apply_map(e, "src_id", m), "tgt_id", m)


def f13_typed_relations(spark, d):
    """Edges with declared relation types made of their keywords' first word."""
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "properties").where("src_id is not null and tgt_id is not null")
    word = F.element_at(F.array(*(F.lit(x) for x in ("cites", "cited by", "used_by", "has-part", "unknown"))), (F.length("src_id") % 5 + 1).cast("int"))
    return records.typed_relations(e.select("gid", F.col("src_id").alias("src"), F.col("tgt_id").alias("tgt"), word.alias("keywords")))


def f14_oriented(spark, d):
    r = f13_typed_relations(spark, d)
    flip = F.col("src") > F.col("tgt")
    return r.select("gid", F.least("src", "tgt").alias("a"), F.greatest("src", "tgt").alias("b"), F.when(flip & (F.col("types") != "related_to"), F.concat(F.lit("inverse:"), "types")).otherwise(F.col("types")).alias("types"))


def f15_slips(spark, d):
    """Words of documents that look like slips of an extractor as names."""
    w = documents(spark, d).select(F.explode(F.regexp_extract_all("text", F.lit(r"([A-Za-z_;|]{4,})"), 1)).alias("name")).distinct()
    return w.select("name", records.suspicious_name(F.col("name")).alias("slip")).where("slip is not null")


def f16_keywords(spark, d):
    e = unique(spark, d, "graph_edges", "properties").select("gid", F.get_json_object("properties", "$.keywords").alias("k")).where("k is not null")
    return e.select("gid", F.array_join(records.keyword_list(F.col("k")), "|").alias("keywords"))


def f17_valid_queries(spark, d):
    t = table(spark, d, "papers").select("paper_id", F.coalesce("title", F.lit("")).alias("t"))
    return t.select("paper_id", records.query_weight(F.col("t")).alias("weight"), records.valid_query(F.col("t")).alias("valid"))


def f18_headings(spark, d):
    p = table(spark, d, "papers").select("paper_id", F.array("venue", F.col("pub_year").cast("string"), "doi", "title").alias("h"))
    return p.select("paper_id", records.heading_path(F.col("h"), 90).alias("path"))


def f19_media_marks(spark, d):
    t = documents(spark, d).select("doc_id", F.concat(F.lit('<drawing id="1"/>'), "text", F.lit("[[table:7]]")).alias("t"))
    return t.select("doc_id", F.length(records.without_media_marks(F.col("t"))).alias("n"))


def f20_bibliography(spark, d):
    """Chunks and, as entries on one line each, the papers of each venue."""
    entry = F.concat(F.element_at(F.split(F.coalesce(F.col("authors")[0]["display_name"], F.lit("Anon")), " "), -1), F.lit(", A. ("), F.coalesce(F.col("pub_year").cast("string"), F.lit("")), F.lit("). "), F.coalesce("title", F.lit("")), F.lit(". Journal, vol. 1"))
    p = unique(spark, d, "papers", "venue", "authors", "pub_year", "title").groupBy("venue").agg(F.array_join(F.sort_array(F.collect_list(entry)), "\n").alias("t"))
    return p.select("venue", quality.is_bibliography(F.col("t")).alias("drop"))


def f21_garble(spark, d):
    return documents(spark, d).where("text is not null").select("doc_id", quality.garble(F.col("text")).alias("kind"))


def f22_junk_ratio(spark, d):
    c = unique(spark, d, "text_chunks", "content").where("content is not null").select("id", quality.junk_ratio(F.col("content")).alias("r"))
    return c.select("id", F.round("r", 6).alias("ratio"), (F.col("r") >= 0.9).alias("quarantine"))


def f23_clean(spark, d):
    c = unique(spark, d, "text_chunks", "content").where("content is not null")
    return c.select("id", F.md5(quality.clean(F.col("content"))).alias("digest"))


def f24_repeated_lines(spark, d):
    """Chunks of a file as one text with a running line before each: the line comes back, but for the number in it."""
    running = F.concat(F.lit("Proceedings of the library of reef surveys, page "), "chunk_order_index")
    c = unique(spark, d, "text_chunks", "full_doc_id", "chunk_order_index", "content").select("full_doc_id", F.struct("chunk_order_index", "id", F.concat_ws("\n", running, "content").alias("t")).alias("x"))
    t = c.groupBy("full_doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["t"]), "\n").alias("text"))
    return quality.repeated_lines(t, "text").select("full_doc_id", F.md5("text").alias("digest"))


def f25_tail_references(spark, d):
    t = documents(spark, d).where("text is not null").select("doc_id", F.concat("text", F.lit("\n\nReferences\n\nSmith, A. (1999). One.\nJones, B. (2001). Two.")).alias("text"))
    return quality.without_tail_references(t, "text").select("doc_id", F.length("text").alias("n"))


def f26_empty(spark, d):
    return documents(spark, d).where(quality.is_empty(F.col("text"))).select("doc_id")


def f27_thin(spark, d):
    """Files of which the first chunk alone is taken for what is stored."""
    s = unique(spark, d, "doc_status", "content_length", "created_at").select("id", F.col("content_length").alias("chars"), F.col("created_at").alias("arrived"))
    c = unique(spark, d, "text_chunks", "full_doc_id", "content").where(F.col("id").endswith("-chunk-000")).groupBy(F.col("full_doc_id").alias("id")).agg(F.sum(F.coalesce(F.length("content"), F.lit(0))).alias("chars"))
    return quality.thin_documents(s, c)


def f28_base_names(spark, d):
    s = unique(spark, d, "doc_status", "file_path").where("file_path is not null")
    return s.select("id", quality.base_name(F.concat(F.lit("inbox\\2024/"), "file_path")).alias("name"))


def s05_html_text(spark, d):
    """Plain text of chunks by the cleaning chain, lower bound of their size."""
    c = unique(spark, d, "text_chunks", "content").where("content is not null")
    return c.select("id", F.length(quality.clean(F.col("content"))).alias("n"))


def _clean_sql(x: str) -> str:
    for pattern, to in (("\\x0C", "\n"), ("[\\x00-\\x08\\x0B\\x0E-\\x1F\\x7F]", ""), ("data:[a-z]+/[a-z0-9.+-]+;base64,[A-Za-z0-9+/=]+", ""), ("[A-Za-z0-9+/]{200,}={0,2}", ""), ("(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", ""), ("(?i)<br[ ]*/?>", "\n"), ("<[A-Za-z/!][^>]*>", ""), ("[ \\t]+\\n", "\n"), ("\\n{3,}", "\n\n")):
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return T.format(x)


def _window_sql(size: int, overlap: int, rows: str = "SELECT doc_id, text FROM documents", key: str = "doc_id") -> str:
    return f"SELECT {key}, CAST(s // {size - overlap} AS INTEGER) AS chunk_order_index, CAST(s AS INTEGER) AS start, CAST(least({size}, length(text) - s) AS INTEGER) AS tokens, {T.format(f'substr(text, CAST(s AS BIGINT) + 1, {size})')} AS content FROM (SELECT *, unnest(generate_series(0, length(text) - 1, {size - overlap})) AS s FROM ({rows}) WHERE length(text) > 0)"


def _junk(column: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p.replace(chr(39), chr(39) * 2)}') THEN '{k}'" for k, p in records.JUNK) + " END"



_INV = "CASE w WHEN 'cited_by' THEN 'cites' WHEN 'used_by' THEN 'uses' WHEN 'has_part' THEN 'part_of' WHEN 'cites' THEN 'cites' END"
_TYPED = f"ty AS (SELECT gid, CASE WHEN sw THEN tgt_id ELSE src_id END AS src, CASE WHEN sw THEN src_id ELSE tgt_id END AS tgt, coalesce({_INV}, 'related_to') AS types FROM (SELECT *, w IN ('cited_by', 'used_by', 'has_part') AS sw FROM (SELECT DISTINCT gid, src_id, tgt_id, ['cites', 'cited_by', 'used_by', 'has_part', 'unknown'][CAST(length(src_id) % 5 + 1 AS BIGINT)] AS w FROM graph_edges WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL)))"

QUERIES = {f.__name__: f for f in (c01_windows, c02_by_separator, c03_separator_only, c04_recursive, c05_semantic, c06_structured, c07_without_references, c09_chunk_ids, c10_spans, c11_rerank_windows, c12_surroundings, c12_all_surroundings, c12_table_context, d09_options, f01_parse, f02_entities, f03_relations, f04_json, f04_broken, f05_name_cap, f06_symbolic, f07_junk_names, f08_without_junk, f09_types, f10_fold_keys, f11_fold_map, f12_apply_fold, f12_apply_alias, f13_typed_relations, f14_oriented, f15_slips, f16_keywords, f17_valid_queries, f18_headings, f19_media_marks, f20_bibliography, f21_garble, f22_junk_ratio, f23_clean, f24_repeated_lines, f25_tail_references, f26_empty, f27_thin, f28_base_names, s05_html_text)}
_ONE_LINE = "regexp_replace(x, '\\s+', ' ', 'g')"
_ENT = f"SELECT key, {T.format('id')} AS name, lower(replace(list_filter(list_transform(string_split({T.format('entity_type')}, ','), lambda x: {T.format('x')}), lambda x: x <> '')[1], ' ', '')) AS type, {T.format('description')} AS description FROM nn WHERE {T.format('id')} <> '' AND {T.format('entity_type')} <> '' AND {T.format('description')} <> '' AND NOT regexp_matches(entity_type, '[''()<>|/\\\\]')"
_RELN = f"SELECT key, {T.format('src_id')} AS src, {T.format('tgt_id')} AS tgt, {T.format(chr(34) + 'kw' + chr(34))} AS keywords, {T.format('description')} AS description, 1.0::DOUBLE AS weight FROM (SELECT *, replace(coalesce(keywords, ''), '，', ',') AS kw FROM ee) WHERE {T.format('src_id')} <> '' AND {T.format('tgt_id')} <> '' AND {T.format('description')} <> '' AND {T.format('src_id')} <> {T.format('tgt_id')}"
SQL = {
    "c01_windows": _window_sql(SIZE, OVERLAP),
    "c02_by_separator": "SELECT doc_id, piece, start, tokens, content FROM (" + _window_sql(SIZE, OVERLAP, f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS piece, p AS text FROM (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS p, unnest(generate_series(1, len(string_split(text, chr(10) || chr(10))))) AS i FROM documents) WHERE {T.format('p')} <> ''", "doc_id, piece") + ")",
    "c03_separator_only": f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS piece, {T.format('p')} AS content FROM (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS p, unnest(generate_series(1, len(string_split(text, chr(10) || chr(10))))) AS i FROM documents) WHERE {T.format('p')} <> ''",
    "c07_without_references": "SELECT doc_id AS doc, count(*) AS blocks FROM (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS c FROM documents) WHERE NOT regexp_matches(lower(string_split(c, chr(10))[1]), '^\\s*(?:\\d+[.)]?\\s*)?(references|bibliography|works cited|literatur|literaturverzeichnis|références|referencias)') GROUP BY 1",
    "c09_chunk_ids": f"SELECT printf('%d-chunk-%03d', doc_id, chunk_order_index) AS id, doc_id, tokens FROM ({_window_sql(SIZE, OVERLAP)})",
    "c10_spans": f'SELECT doc_id, chunk_order_index, start, start + tokens AS "end" FROM ({_window_sql(SIZE, OVERLAP)})',
    "c11_rerank_windows": f"SELECT doc_id, chunk_order_index, CAST(ceil(length(content) / 4.0) AS INTEGER) AS tokens FROM ({_window_sql(1920, 128)})",
    "c12_all_surroundings": "SELECT doc_id, i AS item, substr(text, greatest(1, p - 99), least(100, p)) AS leading, substr(text, p + 1, 100) AS trailing FROM (SELECT doc_id, text, i, length(array_to_string(ps[1:i], 'Table ')) AS p FROM (SELECT doc_id, text, ps, unnest(range(1, len(ps))) AS i FROM (SELECT doc_id, text, string_split(text, 'Table ') AS ps FROM documents WHERE text IS NOT NULL)))",
    "c12_surroundings": "SELECT doc_id, substr(text, greatest(1, p - 99), least(100, p)) AS leading, substr(text, p + 1, 100) AS trailing FROM (SELECT doc_id, text, strpos(text, 'Table ') - 1 AS p FROM documents WHERE strpos(text, 'Table ') > 0)",
    "f01_parse": f"WITH {NODE_SQL}, {EDGE_SQL} SELECT key, 4 AS n, 'entity' AS what FROM nn WHERE id IS NOT NULL UNION ALL SELECT key, 5, 'relation' FROM ee",
    "f02_entities": f"WITH {NODE_SQL} {_ENT}",
    "f03_relations": f"WITH {EDGE_SQL} {_RELN}",
    "f04_json": f"WITH {NODE_SQL} SELECT key, {T.format('id')} AS name, lower(replace(entity_type, ' ', '')) AS type, {T.format('description')} AS description FROM nn WHERE {T.format('id')} <> '' AND lower(replace(entity_type, ' ', '')) <> '' AND {T.format('description')} <> '' AND NOT regexp_matches(entity_type, '[''()<>|/\\\\]')",
    "f06_symbolic": "SELECT DISTINCT w FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS w FROM documents) WHERE length(w) = 1 OR (length(w) = 2 AND (NOT regexp_matches(w, '^[\\p{L}\\p{N}]+$') OR regexp_matches(w, '^[0-9]+$')))",
    "f07_junk_names": f"SELECT name, kind FROM (SELECT name, {_junk('name')} AS kind FROM (SELECT id AS name FROM graph_nodes UNION SELECT unnest(regexp_extract_all(text, '(?:Table|Figure|Section) [0-9]+|[A-Z]\\. [A-Z][a-z]+')) FROM documents)) WHERE kind IS NOT NULL AND name IS NOT NULL",
    "f08_without_junk": (
        f"WITH {NODE_SQL}, {EDGE_SQL}, en AS (SELECT key % 1000 AS k, name, bool_or({_junk('name')} IS NOT NULL AND NOT ({_junk('name')} = 'person' AND type = 'person')) AS d FROM ({_ENT}) GROUP BY 1, 2), rl AS (SELECT key % 1000 AS k, src, tgt FROM ({_RELN}))"
        f" SELECT DISTINCT src, tgt FROM rl LEFT JOIN en a ON a.k = rl.k AND a.name = src LEFT JOIN en b ON b.k = rl.k AND b.name = tgt WHERE NOT coalesce(a.d, {_junk('src')} IS NOT NULL) AND NOT coalesce(b.d, {_junk('tgt')} IS NOT NULL)"
    ),
    "f09_types": f"WITH {NODE_SQL} SELECT CASE WHEN type IN ('person', 'method', 'dataset') THEN type ELSE 'other' END AS type, count(*) AS n FROM ({_ENT}) GROUP BY 1",
    "f13_typed_relations": f"WITH {_TYPED} SELECT gid, src, tgt, types FROM ty",
    "f14_oriented": f"WITH {_TYPED} SELECT gid, least(src, tgt) AS a, greatest(src, tgt) AS b, CASE WHEN src > tgt AND types <> 'related_to' THEN 'inverse:' || types ELSE types END AS types FROM ty",
    "f15_slips": "SELECT name, slip FROM (SELECT name, CASE WHEN regexp_matches(name, '^[a-z]+(?:_[a-z0-9]+)+$') OR regexp_matches(name, '^[a-z]+(?:[A-Z][a-z0-9]+)+$') OR regexp_matches(name, '^[A-Z]+(?:_[A-Z0-9]+)+$') OR regexp_matches(name, '^[a-z_]\\w*(?:\\.[a-z_]\\w*)+$') THEN 'variable' WHEN regexp_matches(name, '[a-z]{3,}[A-Z][a-z]{3,}[A-Z]?') OR regexp_matches(name, '[A-Za-z]{3,}[;|][A-Za-z]{3,}') THEN 'glued' END AS slip FROM (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z_;|]{4,}')) AS name FROM documents)) WHERE slip IS NOT NULL",
    "f16_keywords": f"SELECT gid, array_to_string(list_filter(list_transform(regexp_split_to_array(k, '[\\n,;]+'), lambda x: {T.format('x')}), lambda x: x <> '' AND NOT regexp_matches(x, '^[<\\[{{].*[>\\]}}]$')), '|') AS keywords FROM (SELECT DISTINCT gid, properties ->> '$.keywords' AS k FROM graph_edges) WHERE k IS NOT NULL",
    "f17_valid_queries": "SELECT paper_id, w AS weight, w >= 3 AS valid FROM (SELECT paper_id, CAST(length(t) + length(regexp_replace(t, '[^\\x{2E80}-\\x{9FFF}\\x{AC00}-\\x{D7AF}\\x{F900}-\\x{FAFF}]', '', 'g')) AS INTEGER) AS w FROM (SELECT paper_id, regexp_replace(coalesce(title, ''), '\\s+', '', 'g') AS t FROM papers))",
    "f18_headings": f"SELECT paper_id, CASE WHEN length(j) <= 90 OR len(h) <= 2 THEN j ELSE coalesce(list_filter(fm, lambda x: length(x) <= 90)[1], fm[-1]) END AS path FROM (SELECT paper_id, h, array_to_string(h, ' → ') AS j, list_transform(generate_series(2, greatest(len(h) - 1, 2)), lambda k: h[1] || ' → … → ' || array_to_string(h[k + 1:], ' → ')) AS fm FROM (SELECT paper_id, list_transform(list_filter([venue, CAST(pub_year AS VARCHAR), doi, title], lambda x: x IS NOT NULL AND {T.format('x')} <> ''), lambda x: substr({T.format(_ONE_LINE)}, 1, 80)) AS h FROM papers))",
    "f19_media_marks": "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents",
    "f21_garble": (
        "SELECT doc_id, CASE WHEN n < 500 THEN NULL WHEN length(regexp_replace(s, '[^\\x{E000}-\\x{F8FF}]', '', 'g')) / n >= 0.30 THEN 'private' WHEN length(regexp_replace(s, '[^\\x{FFFD}]', '', 'g')) / n >= 0.05 THEN 'replacement' WHEN length(regexp_replace(s, '[^\\x00-\\x1F\\x7F]', '', 'g')) / n >= 0.05 AND wd < 0.25 THEN 'control'"
        " WHEN length(regexp_replace(s, '[^\\x{80}-\\x{FF}]', '', 'g')) / n >= 0.12 THEN 'latin1' WHEN si >= 0.35 AND wd < 0.15 AND length(regexp_replace(s, '[^0-9]', '', 'g')) / n < 0.30 THEN 'single' WHEN length(regexp_replace(s, '[^A-Za-z]', '', 'g')) / n >= 0.30 AND wd < 0.03 THEN 'letters' ELSE 'none' END AS kind"
        " FROM (SELECT doc_id, s, n, CASE WHEN n > 0 THEN length(array_to_string(regexp_extract_all(s, '[A-Za-z]{3,}'), '')) / n END AS wd, CASE WHEN len(t) > 0 THEN len(list_filter(t, lambda x: length(x) = 1)) / len(t) ELSE 0 END AS si FROM (SELECT doc_id, regexp_replace(text, '\\s+', '', 'g') AS s, length(regexp_replace(text, '\\s+', '', 'g')) AS n, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS t FROM documents WHERE text IS NOT NULL))"
    ),
    "f22_junk_ratio": "SELECT id, round(r, 6) AS ratio, r >= 0.9 AS quarantine FROM (SELECT id, CASE WHEN length(content) > 0 THEN 1 - length(regexp_replace(regexp_replace(content, '[A-Za-z0-9+/]{200,}={0,2}', '', 'g'), '<[^>]*>', '', 'g')) / length(content) ELSE 0 END AS r FROM (SELECT DISTINCT id, content FROM text_chunks WHERE content IS NOT NULL))",
    "f23_clean": f"SELECT id, md5({_clean_sql('content')}) AS digest FROM (SELECT DISTINCT id, content FROM text_chunks WHERE content IS NOT NULL)",
    "f04_broken": f"SELECT key, {T.format('src_id')} AS src, {T.format('tgt_id')} AS tgt, {T.format('d')} AS description FROM (SELECT DISTINCT gid AS key, src_id, tgt_id, properties ->> '$.description' AS d FROM graph_edges) WHERE {T.format('src_id')} <> '' AND {T.format('tgt_id')} <> '' AND {T.format('d')} <> '' AND {T.format('src_id')} <> {T.format('tgt_id')}",
    "f05_name_cap": "SELECT paper_id, CAST(length(c) AS INTEGER) AS chars, CAST(strlen(c) AS INTEGER) AS bytes FROM (SELECT paper_id, CASE WHEN length(x) <= 256 AND strlen(x) <= 512 THEN x ELSE rtrim(substr(x, 1, len(list_filter(generate_series(1, least(256, length(x))), lambda i: strlen(substr(x, 1, i)) <= 512)))) END AS c FROM (SELECT paper_id, repeat(coalesce(title, ''), 8) AS x FROM papers))",
    "f12_apply_alias": f"WITH lab AS (SELECT DISTINCT id FROM graph_nodes WHERE id IS NOT NULL), m AS (SELECT id AS name, min(id) OVER (PARTITION BY lower(regexp_replace(id, '[\\s.,''’-]+', '', 'g'))) AS canonical FROM lab) SELECT gid, coalesce(a.canonical, src_id) AS src_id, coalesce(b.canonical, tgt_id) AS tgt_id FROM (SELECT DISTINCT gid, src_id, tgt_id FROM graph_edges) e LEFT JOIN m a ON a.name = src_id LEFT JOIN m b ON b.name = tgt_id",
    "f20_bibliography": (
        "SELECT venue, " + bibliography_sql("t") + " AS \"drop\" FROM (SELECT venue, string_agg(e, chr(10) ORDER BY e) AS t FROM (SELECT venue, string_split(coalesce(authors[1].display_name, 'Anon'), ' ')[-1] || ', A. (' || coalesce(CAST(pub_year AS VARCHAR), '') || '). ' || coalesce(title, '') || '. Journal, vol. 1' AS e FROM (SELECT DISTINCT paper_id, venue, authors, pub_year, title FROM papers)) GROUP BY 1)"
    ),
    "f24_repeated_lines": (
        "WITH c AS (SELECT DISTINCT id, full_doc_id, chunk_order_index, content FROM text_chunks), t AS (SELECT full_doc_id, string_agg(concat_ws(chr(10), 'Proceedings of the library of reef surveys, page ' || chunk_order_index, content), chr(10) ORDER BY chunk_order_index NULLS FIRST, id) AS text FROM c GROUP BY 1),"
        " l AS (SELECT full_doc_id, text, unnest(string_split(text, chr(10))) AS l, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM t), f AS (SELECT *, trim(regexp_replace(l, '\\s+', ' ', 'g')) AS p FROM l),"
        " g AS (SELECT *, CASE WHEN NOT regexp_matches(p, '^(?:[#|-]|```)') AND length(regexp_replace(p, '[0-9]+', '#', 'g')) >= 40 THEN regexp_replace(p, '[0-9]+', '#', 'g') END AS form FROM f),"
        " h AS (SELECT *, form IS NOT NULL AND count(*) OVER (PARTITION BY full_doc_id, form) >= 5 AND i > min(i) OVER (PARTITION BY full_doc_id, form) AS gone FROM g),"
        " n AS (SELECT full_doc_id, any_value(text) AS text, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '') AS nw, bool_or(gone) AS cut FROM h GROUP BY 1)"
        " SELECT full_doc_id, md5(CASE WHEN cut AND length(nw) >= 0.75 * length(text) THEN nw ELSE text END) AS digest FROM n"
    ),
    "f26_empty": "SELECT doc_id FROM documents WHERE length(regexp_replace(coalesce(text, ''), '\\s+', '', 'g')) < 20",
    "f27_thin": "SELECT id, source_chars, stored_chars, day, CASE WHEN stored_chars < 200 THEN 'stub' ELSE 'thin' END AS why FROM (SELECT s.id, s.chars AS source_chars, coalesce(c.chars, 0) AS stored_chars, CAST(created_at AS DATE) AS day FROM (SELECT DISTINCT id, content_length AS chars, created_at FROM doc_status) s LEFT JOIN (SELECT full_doc_id AS id, CAST(sum(coalesce(length(content), 0)) AS BIGINT) AS chars FROM (SELECT DISTINCT id, full_doc_id, content FROM text_chunks) WHERE ends_with(id, '-chunk-000') GROUP BY 1) c USING (id)) WHERE source_chars > 1000 AND (stored_chars < 200 OR source_chars > 2.0 * stored_chars)",
    "f28_base_names": f"SELECT id, regexp_replace(regexp_extract(replace({T.format('f')}, '\\', '/'), '([^/]*)$', 1), '\\.?\\[[^\\]]*\\](\\.[A-Za-z0-9]+)$', '\\1', 'g') AS name FROM (SELECT DISTINCT id, 'inbox\\2024/' || file_path AS f FROM doc_status WHERE file_path IS NOT NULL)",
    "s05_html_text": f"SELECT id, CAST(length({_clean_sql('content')}) AS INTEGER) AS n FROM (SELECT DISTINCT id, content FROM text_chunks WHERE content IS NOT NULL)",
}
