"""Grouped merges and joins over the library's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import parts, strip
from graphloom.operators import merge
from graphloom.plans.graph_queries import LIST_SQL, SPLIT_SQL, names
from graphloom.session import cut
from graphloom.sources.tables import table, unique


def records(spark: SparkSession, d: str) -> DataFrame:
    """Extraction records: one per node and document chunk list, and one per edge end (whose type is not known)."""
    n = unique(spark, d, "graph_nodes", "id", "entity_type", "source_id", "file_path", "properties", "created_at")
    a = n.select(F.lower("id").alias("name"), strip(F.lower("entity_type")).alias("type"), F.get_json_object("properties", "$.description").alias("description"), "source_id", "file_path", F.col("gid").alias("pos"), F.unix_seconds(F.col("created_at").cast("timestamp")).alias("time"))
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "source_id", "file_path", "properties", "updated_at")
    b = e.select(F.explode(F.array(F.struct(F.lower("src_id").alias("name"), F.lit(1000000).alias("k")), F.struct(F.lower("tgt_id").alias("name"), F.lit(2000000).alias("k")))).alias("x"), "source_id", "file_path", "properties", "gid", "updated_at")
    b = b.select("x.name", F.lit("unknown").alias("type"), F.get_json_object("properties", "$.description").alias("description"), "source_id", "file_path", (F.col("gid") * 10_000_000 + F.col("x.k")).alias("pos"), F.unix_seconds(F.col("updated_at").cast("timestamp")).alias("time"))
    return a.unionByName(b)


RECORDS_SQL = (
    "rec AS (SELECT lower(id) AS name, regexp_replace(lower(entity_type), '^\\s+|\\s+$', '', 'g') AS type, properties ->> '$.description' AS description, source_id, file_path, gid AS pos, CAST(floor(epoch(created_at)) AS BIGINT) AS time FROM (SELECT DISTINCT * FROM graph_nodes)"
    " UNION ALL SELECT lower(src_id), 'unknown', properties ->> '$.description', source_id, file_path, gid * 10000000 + 1000000, CAST(floor(epoch(updated_at)) AS BIGINT) FROM (SELECT DISTINCT * FROM graph_edges)"
    " UNION ALL SELECT lower(tgt_id), 'unknown', properties ->> '$.description', source_id, file_path, gid * 10000000 + 2000000, CAST(floor(epoch(updated_at)) AS BIGINT) FROM (SELECT DISTINCT * FROM graph_edges))"
)


def relation_records(spark: SparkSession, d: str) -> DataFrame:
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "weight", "source_id", "properties", "updated_at")
    field = lambda k: F.get_json_object("properties", f"$.{k}").alias(k)
    return e.select("gid", F.col("src_id").alias("src"), F.col("tgt_id").alias("tgt"), "weight", "source_id", field("keywords"), field("description"), "updated_at")


def g01_gleaning(spark, d):
    """Two passes over each chunk of text (by day parity of its edges): the longer description wins for each pair and source."""
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "source_id", "properties").select("gid", "src_id", "tgt_id", "source_id", F.get_json_object("properties", "$.description").alias("description"), F.col("gid").alias("pass"))
    return merge.gleaned(e.where("src_id is not null and tgt_id is not null"), ["src_id", "tgt_id"]).select("src_id", "tgt_id", "gid", "description")


def g02_entity_merge(spark, d):
    return merge.type_vote(records(spark, d).where("name is not null"))


def g03_source_merge(spark, d):
    return merge.source_ids(records(spark, d).where("name is not null"), ["name"], "pos").select("name", F.array_join("source_ids", "|").alias("source_ids"))


def g04_source_cap(spark, d):
    r = records(spark, d).where("name is not null").select("name", "pos", F.posexplode(parts(F.col("source_id"))).alias("i", "s")).withColumn("o", F.struct("pos", "i"))
    keep = merge.first_n(r, ["name"], "s", "o", "keep", 3).select("name", F.array_join("keep", "|").alias("keep"))
    return keep.join(merge.first_n(r, ["name"], "s", "o", "fifo", 3, last=True).select("name", F.array_join("fifo", "|").alias("fifo")), "name")


def g05_descriptions(spark, d):
    return merge.descriptions(records(spark, d).where("name is not null"), ["name"], "pos", "time").select("name", F.array_join("texts", "|").alias("texts"))


def g06_summary(spark, d):
    t = merge.descriptions(records(spark, d).where("name is not null"), ["name"], "pos", "time")
    text, long_ = merge.summary(F.col("texts"), F.col("name"))
    return t.select("name", F.length(text).cast("long").alias("size"), long_.alias("needs_summary"))


def g07_file_cap(spark, d):
    r = records(spark, d).where("name is not null").select("name", "pos", F.posexplode(parts(F.col("file_path"))).alias("i", "f")).withColumn("o", F.struct("pos", "i"))
    f = merge.first_n(r, ["name"], "f", "o", "files", 5)
    return f.select("name", F.array_join(F.when(F.col("files_n") > 5, F.concat("files", F.array(F.lit("...truncated...(KEEP Old)")))).otherwise(F.col("files")), "|").alias("files"))


def g06_batches(spark, d):
    """Batches of the descriptions of each name for a summary, of 400 tokens and two texts at least."""
    b = merge.batches(merge.description_rows(records(spark, d).where("name is not null"), ["name"], "pos", "time"), ["name"], 400)
    return b.groupBy("name", "batch").agg(F.count("*").alias("texts"), F.sum(F.length("text")).cast("long").alias("size"))


def g02_entities(spark, d):
    """The whole entity merge: vote, descriptions, sources and files at once."""
    return merge.entities(records(spark, d))


def g08_edge_merge(spark, d):
    return merge.relations(relation_records(spark, d))


def g08_edge_merge_stored(spark, d):
    """A second batch (the rows of the last months) over the edges stored before."""
    r = relation_records(spark, d)
    stored = merge.relations(r.where("updated_at < '2024-07-01'"))
    ids = r.where("updated_at < '2024-07-01' and src is not null and tgt is not null").select(F.least("src", "tgt").alias("a"), F.greatest("src", "tgt").alias("b"), F.explode(parts(F.col("source_id"))).alias("s")).groupBy("a", "b").agg(F.array_join(F.collect_set("s"), "<SEP>").alias("source_id"))
    return merge.relations(r.where("updated_at >= '2024-07-01'"), stored.join(ids, ["a", "b"], "left").select("a", "b", "weight", "source_id"))


def g09_keywords(spark, d):
    r = relation_records(spark, d).where("src is not null and tgt is not null and src <> tgt").select(F.least("src", "tgt").alias("a"), F.greatest("src", "tgt").alias("b"), "keywords")
    return merge.keywords(r, ["a", "b"])


def g10_endpoints(spark, d):
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "source_id")
    return merge.endpoints(e, names(spark, d)).select("id", "type", F.array_join("source_ids", "|").alias("source_ids"))


def g10_refreshed(spark, d):
    """Sources of the nodes that edges refer to, with those of the edges."""
    n = unique(spark, d, "graph_nodes", "id", "source_id").select("id", "source_id").where("id is not null")
    x = merge.refreshed(unique(spark, d, "graph_edges", "src_id", "tgt_id", "source_id"), n, 20)
    return x.select("id", F.array_join("source_ids", "|").alias("source_ids"), "tracked")


def g13_two_phases(spark, d):
    """The merge of all records phase by phase into the shared folder: rows that each phase committed."""
    done = merge.two_phases(records(spark, d).where("time is not null"), relation_records(spark, d).where("src is not null and tgt is not null").withColumn("src", F.lower("src")).withColumn("tgt", F.lower("tgt")), lambda name, df: cut(df))
    whole = None
    for name, df in done.items():
        x = df.groupBy(F.lit(name).alias("phase")).agg(F.count("*").alias("rows"))
        whole = x if whole is None else whole.unionByName(x)
    return whole


def g14_entities(spark, d):
    """Entities rebuilt from what chunks are left."""
    r = records(spark, d)
    nodes = r.where("type is null or type <> 'unknown'")
    e = relation_records(spark, d).select(F.explode(F.array(F.lower("src"), F.lower("tgt"))).alias("name"), "description", F.col("gid").alias("pos"))
    return merge.rebuilt_entities(nodes, table(spark, d, "text_chunks").select("id").distinct(), e, 3, 2)


def g11_keep_filter(spark, d):
    r = records(spark, d).where("name is not null").select("name", "source_id", "pos")
    ids = merge.source_ids(r, ["name"], "pos").select("name", merge.capped(F.col("source_ids"), 3).alias("source_ids"))
    return merge.kept_in_cap(r, ids, ["name"]).select("name", "pos")


def g12_document_candidates(spark, d):
    return merge.document_candidates(unique(spark, d, "graph_nodes", "id", "source_id"), unique(spark, d, "graph_edges", "src_id", "tgt_id", "source_id"))


def g14_rebuild(spark, d):
    return merge.rebuilt(relation_records(spark, d), table(spark, d, "text_chunks").select("id").distinct())


def g15_field_merge(spark, d):
    r = records(spark, d).where("name is not null").select("name", F.col("type").alias("value"), "pos")
    return merge.merge_fields(r, ["name"], "pos")


def g16_status_counts(spark, d):
    s = unique(spark, d, "doc_status", "status").select("id", strip(F.lower("status")).alias("status"))
    return s.groupBy("status").agg(F.count("*").alias("n"))


def g17_document_scores(spark, d):
    c = unique(spark, d, "text_chunks", "full_doc_id", "content", "tokens")
    c = c.select(F.col("full_doc_id").alias("doc"), F.col("id").alias("pos"), (F.coalesce("tokens", F.lit(0)) / 480.0).alias("score"))
    return merge.score_documents(c).select("doc", F.round("best", 9).alias("best"), F.round("mean", 9).alias("mean"), F.round("first", 9).alias("first"))


S = SPLIT_SQL.format("source_id")
IN_ORDER, FILES = LIST_SQL.format("source_id"), LIST_SQL.format("file_path")
_ORD = "SELECT name, {v} AS v, min(o) AS o FROM (SELECT name, unnest({s}) AS {v}, unnest(generate_series(1, len({s}))) AS i, pos FROM rec WHERE name IS NOT NULL) t, LATERAL (SELECT pos * 1000 + i AS o) GROUP BY name, {v}"
SRCS_SQL = f"WITH {RECORDS_SQL}, f AS ({_ORD.format(v='s', s=IN_ORDER)})"
FILES_SQL = f"WITH {RECORDS_SQL}, f AS ({_ORD.format(v='fp', s=FILES)})"
DESC_SQL = (
    f"WITH {RECORDS_SQL}, ds AS (SELECT name, description, min(struct_pack(t := coalesce(time, -9223372036854775807), p := pos)) AS k FROM rec WHERE name IS NOT NULL AND description IS NOT NULL AND regexp_replace(description, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY name, description),"
    " tx AS (SELECT name, list(description ORDER BY k.t, -length(description), k.p) AS texts FROM ds GROUP BY name)"
)
REL_SQL = "rr AS (SELECT DISTINCT gid, src_id AS src, tgt_id AS tgt, least(src_id, tgt_id) AS a, greatest(src_id, tgt_id) AS b, weight, source_id, properties ->> '$.keywords' AS keywords, properties ->> '$.description' AS description, updated_at FROM graph_edges WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL AND src_id <> tgt_id)"
EV = "x NOT IN ('manual_creation', 'UNKNOWN')"
_KEYS = "list_filter(list_transform(string_split(replace(keywords, '，', ','), ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"


def _merged(rows: str) -> str:
    return (
        f"SELECT w.a, w.b, greatest(w.w, CAST(coalesce(n, 0) AS DOUBLE)) AS weight, coalesce(n, 0) AS evidence FROM (SELECT a, b, sum(coalesce(weight, 1.0)) AS w FROM {rows} GROUP BY a, b) w"
        f" LEFT JOIN (SELECT a, b, count(DISTINCT x) AS n FROM (SELECT a, b, unnest({S}) AS x FROM {rows}) WHERE {EV} GROUP BY a, b) v ON v.a = w.a AND v.b = w.b"
    )


QUERIES = {f.__name__: f for f in (g01_gleaning, g02_entity_merge, g02_entities, g03_source_merge, g04_source_cap, g05_descriptions, g06_summary, g06_batches, g07_file_cap, g08_edge_merge, g08_edge_merge_stored, g09_keywords, g10_endpoints, g10_refreshed, g11_keep_filter, g12_document_candidates, g13_two_phases, g14_rebuild, g14_entities, g15_field_merge, g16_status_counts, g17_document_scores)}
SQL = {
    "g01_gleaning": "SELECT src_id, tgt_id, gid, description FROM (SELECT *, row_number() OVER (PARTITION BY src_id, tgt_id ORDER BY coalesce(length(description), 0) DESC, gid) AS r FROM (SELECT DISTINCT gid, src_id, tgt_id, properties ->> '$.description' AS description FROM graph_edges WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL)) WHERE r = 1",
    "g02_entity_merge": f"WITH {RECORDS_SQL} SELECT name, type FROM (SELECT name, type, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, min(pos)) AS r FROM rec WHERE name IS NOT NULL AND type IS NOT NULL AND type <> '' GROUP BY name, type) WHERE r = 1",
    "g03_source_merge": f"{SRCS_SQL} SELECT name, string_agg(v, '|' ORDER BY o) AS source_ids FROM f GROUP BY name",
    "g04_source_cap": f"{SRCS_SQL}, l AS (SELECT name, list(v ORDER BY o) AS v FROM f GROUP BY name) SELECT name, array_to_string(v[1:3], '|') AS keep, array_to_string(v[greatest(1, len(v) - 2):], '|') AS fifo FROM l",
    "g05_descriptions": f"{DESC_SQL} SELECT name, array_to_string(texts, '|') AS texts FROM tx",
    "g06_summary": f"{DESC_SQL} SELECT name, CAST(length(array_to_string(texts, '<SEP>')) AS BIGINT) AS size, len(texts) > 1 AND (len(texts) >= 8 OR length(array_to_string(texts, '')) >= 1200) AS needs_summary FROM tx",
    "g06_batches": f"{DESC_SQL}, rw AS (SELECT name, description, row_number() OVER w - 1 AS i, coalesce(lag(length(description)) OVER w, 0) AS l, coalesce(sum(length(description)) OVER (PARTITION BY name ORDER BY k.t, -length(description), k.p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM ds WINDOW w AS (PARTITION BY name ORDER BY k.t, -length(description), k.p)) SELECT name, CAST(floor((b - i % 2 * l) / 400) AS BIGINT) AS batch, count(*) AS texts, CAST(sum(length(description)) AS BIGINT) AS size FROM rw GROUP BY 1, 2",
    "g02_entities": (
        f"{DESC_SQL}, r AS (SELECT * FROM rec WHERE name IS NOT NULL AND regexp_replace(name, '^\\s+|\\s+$', '', 'g') <> ''),"
        " vt AS (SELECT name, type FROM (SELECT name, type, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, min(pos)) AS x FROM r WHERE type IS NOT NULL AND type <> '' GROUP BY 1, 2) WHERE x = 1),"
        " dd AS (SELECT name, texts, len(texts) > 1 AND (len(texts) >= 8 OR length(array_to_string(texts, '')) >= 1200) AS lg FROM tx),"
        f" sf AS ({_ORD.format(v='s', s=IN_ORDER)}), sl AS (SELECT name, list(v ORDER BY o) AS l FROM sf GROUP BY 1), ff AS ({_ORD.format(v='fp', s=FILES)}), fl AS (SELECT name, list(v ORDER BY o) AS l FROM ff GROUP BY 1)"
        " SELECT n.name, coalesce(vt.type, 'UNKNOWN') AS type, coalesce(CASE WHEN lg THEN list_reduce(texts, lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END) ELSE array_to_string(texts, '<SEP>') END, 'Entity ' || n.name) AS description, coalesce(lg, false) AS needs_summary,"
        " coalesce(array_to_string(sl.l[1:200], '<SEP>'), '') AS source_id, coalesce(array_to_string(CASE WHEN len(fl.l) > 75 THEN list_append(fl.l[1:75], '...truncated...(KEEP Old)') ELSE fl.l END, '<SEP>'), '') AS file_path, coalesce(len(sl.l), 0) AS chunks"
        " FROM (SELECT DISTINCT name FROM r) n LEFT JOIN vt USING (name) LEFT JOIN dd USING (name) LEFT JOIN sl USING (name) LEFT JOIN fl USING (name)"
    ),
    "g10_refreshed": (
        "WITH nn AS (SELECT DISTINCT gid, id, source_id FROM graph_nodes WHERE id IS NOT NULL), ee AS (SELECT DISTINCT gid, src_id, tgt_id, source_id FROM graph_edges), en AS (SELECT src_id AS id, gid, source_id FROM ee UNION ALL SELECT tgt_id, gid, source_id FROM ee),"
        " al AS (SELECT id, -1 AS gid, source_id FROM nn WHERE id IN (SELECT id FROM en) UNION ALL SELECT id, gid, source_id FROM en WHERE id IN (SELECT id FROM nn)),"
        f" f AS (SELECT id, v, min(struct_pack(g := gid, i := i)) AS o FROM (SELECT id, gid, unnest({IN_ORDER}) AS v, unnest(generate_series(1, len({IN_ORDER}))) AS i FROM al) GROUP BY 1, 2)"
        " SELECT id, array_to_string(list(v ORDER BY o)[1:20], '|') AS source_ids, count(*) AS tracked FROM f GROUP BY 1"
    ),
    "g13_two_phases": (
        f"WITH {RECORDS_SQL}, rt AS (SELECT * FROM rec WHERE time IS NOT NULL AND name IS NOT NULL AND regexp_replace(name, '^\\s+|\\s+$', '', 'g') <> ''), rl AS (SELECT DISTINCT gid, lower(src_id) AS s1, lower(tgt_id) AS t1, source_id FROM graph_edges WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL),"
        f" m AS (SELECT unnest({S}) AS s, name FROM rec WHERE time IS NOT NULL UNION ALL SELECT unnest({S}), s1 FROM rl UNION ALL SELECT unnest({S}), t1 FROM rl), ends AS (SELECT unnest([s1, t1]) AS id, source_id FROM rl)"
        " SELECT 'anchors' AS phase, count(*) AS rows FROM (SELECT DISTINCT left(s, 36), name FROM m WHERE name IS NOT NULL AND regexp_matches(s, '^doc-[0-9a-f]{32}-chunk-')) UNION ALL SELECT 'entities', count(DISTINCT name) FROM rt UNION ALL SELECT 'relations', count(*) FROM (SELECT DISTINCT least(s1, t1), greatest(s1, t1) FROM rl WHERE s1 <> t1)"
        f" UNION ALL SELECT * FROM (SELECT 'created' AS phase, count(DISTINCT id) AS rows FROM ends WHERE id NOT IN (SELECT name FROM rt) AND len({S}) > 0) WHERE rows > 0"
    ),
    "g07_file_cap": f"{FILES_SQL}, l AS (SELECT name, list(v ORDER BY o) AS v FROM f GROUP BY name) SELECT name, array_to_string(CASE WHEN len(v) > 5 THEN list_append(v[1:5], '...truncated...(KEEP Old)') ELSE v END, '|') AS files FROM l",
    "g08_edge_merge": f"WITH {REL_SQL} {_merged('rr')}",
    "g08_edge_merge_stored": (
        f"WITH {REL_SQL}, o AS (SELECT * FROM rr WHERE updated_at < TIMESTAMP '2024-07-01'), nw AS (SELECT * FROM rr WHERE updated_at >= TIMESTAMP '2024-07-01'), st AS ({_merged('o')}),"
        f" os AS (SELECT a, b, list(DISTINCT s) AS ids FROM (SELECT a, b, unnest({S}) AS s FROM o) GROUP BY a, b),"
        f" j AS (SELECT nw.a, nw.b, {S} AS ids, coalesce(os.ids, []) AS old, coalesce(st.weight, 0.0) AS w0, coalesce(nw.weight, 1.0) AS w FROM nw LEFT JOIN st ON st.a = nw.a AND st.b = nw.b LEFT JOIN os ON os.a = nw.a AND os.b = nw.b),"
        " s AS (SELECT a, b, max(w0) + sum(CASE WHEN len(list_intersect(ids, old)) > 0 THEN 0.0 ELSE w END) AS w FROM j GROUP BY a, b),"
        f" ev AS (SELECT a, b, count(DISTINCT x) AS n FROM (SELECT a, b, unnest(list_concat(ids, old)) AS x FROM j) WHERE {EV} GROUP BY a, b)"
        " SELECT s.a, s.b, greatest(s.w, CAST(coalesce(n, 0) AS DOUBLE)) AS weight, coalesce(n, 0) AS evidence FROM s LEFT JOIN ev ON ev.a = s.a AND ev.b = s.b"
    ),
    "g09_keywords": f"WITH {REL_SQL} SELECT a, b, string_agg(k, ',' ORDER BY k) AS keywords FROM (SELECT DISTINCT a, b, unnest(list_filter(list_transform(string_split(replace(keywords, '，', ','), ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')) AS k FROM rr) GROUP BY a, b",
    "g10_endpoints": (
        f"WITH el AS (SELECT gid, source_id, src_id AS id FROM (SELECT DISTINCT gid, src_id, tgt_id, source_id FROM graph_edges) UNION ALL SELECT gid, source_id, tgt_id FROM (SELECT DISTINCT gid, src_id, tgt_id, source_id FROM graph_edges)),"
        f" f AS (SELECT id, v, min(gid * 1000 + i) AS o FROM (SELECT id, gid, unnest({IN_ORDER}) AS v, unnest(generate_series(1, len({IN_ORDER}))) AS i FROM el WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM graph_nodes WHERE id IS NOT NULL)) GROUP BY id, v)"
        " SELECT id, 'UNKNOWN' AS type, string_agg(v, '|' ORDER BY o) AS source_ids FROM f GROUP BY id"
    ),
    "g11_keep_filter": f"{SRCS_SQL}, l AS (SELECT name, unnest(list(v ORDER BY o)[1:3]) AS s FROM f GROUP BY name) SELECT DISTINCT r.name, r.pos FROM (SELECT name, pos, unnest({S}) AS s FROM rec WHERE name IS NOT NULL) r JOIN l ON l.name = r.name AND l.s = r.s",
    "g12_document_candidates": (
        f"WITH m AS (SELECT unnest({S}) AS s, id AS name FROM graph_nodes UNION ALL SELECT unnest({S}), src_id FROM graph_edges UNION ALL SELECT unnest({S}), tgt_id FROM graph_edges)"
        " SELECT regexp_extract(s, '^(doc-[0-9a-f]{32})-chunk-', 1) AS doc_id, count(DISTINCT name) AS names FROM m WHERE name IS NOT NULL AND regexp_matches(s, '^doc-[0-9a-f]{32}-chunk-') GROUP BY 1"
    ),
    "g14_rebuild": (
        f"WITH {REL_SQL}, al AS (SELECT * FROM (SELECT rr.*, unnest({S}) AS s FROM rr) WHERE s IN (SELECT id FROM text_chunks)), og AS (SELECT DISTINCT a, b, gid, coalesce(weight, 1.0) AS w, keywords, description FROM al),"
        f" kw AS (SELECT a, b, string_agg(k, ',' ORDER BY k) AS keywords FROM (SELECT DISTINCT a, b, unnest({_KEYS}) AS k FROM og) GROUP BY a, b),"
        " tx AS (SELECT a, b, string_agg(description, '<SEP>' ORDER BY g) AS description FROM (SELECT a, b, description, min(gid) AS g FROM og WHERE regexp_replace(description, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY 1, 2, 3) GROUP BY a, b)"
        " SELECT w.a, w.b, greatest(w.w, CAST(n AS DOUBLE)) AS weight, n AS evidence, coalesce(kw.keywords, '') AS keywords, coalesce(tx.description, '') AS description FROM (SELECT a, b, sum(w) AS w FROM og GROUP BY a, b) w JOIN (SELECT a, b, count(DISTINCT s) AS n FROM al GROUP BY a, b) v ON v.a = w.a AND v.b = w.b LEFT JOIN kw ON kw.a = w.a AND kw.b = w.b LEFT JOIN tx ON tx.a = w.a AND tx.b = w.b"
    ),
    "g14_entities": (
        f"WITH {RECORDS_SQL}, r AS (SELECT * FROM rec WHERE name IS NOT NULL AND regexp_replace(name, '^\\s+|\\s+$', '', 'g') <> '' AND (type IS NULL OR type <> 'unknown')),"
        f" al AS (SELECT * FROM (SELECT r.*, unnest({IN_ORDER}) AS s, unnest(generate_series(0, len({IN_ORDER}) - 1)) AS i FROM r) WHERE s IN (SELECT id FROM text_chunks)),"
        " fi AS (SELECT name, s, min(pos * 1000 + i) AS o FROM al GROUP BY 1, 2), ix AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY o) AS k FROM fi), ids AS (SELECT name, string_agg(s, '<SEP>' ORDER BY o) AS ids FROM ix WHERE k <= 3 GROUP BY 1),"
        " kp AS (SELECT al.* FROM al JOIN ix ON ix.name = al.name AND ix.s = al.s AND ix.k <= 3),"
        " vt AS (SELECT name, type FROM (SELECT name, type, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, min(pos)) AS x FROM kp WHERE type IS NOT NULL AND type <> '' GROUP BY 1, 2) WHERE x = 1),"
        " vo AS (SELECT name, type FROM (SELECT name, type, row_number() OVER (PARTITION BY name ORDER BY count(*) DESC, min(pos)) AS x FROM r WHERE type IS NOT NULL AND type <> '' GROUP BY 1, 2) WHERE x = 1),"
        " ed AS (SELECT lower(src_id) AS name, properties ->> '$.description' AS description, gid AS pos FROM (SELECT DISTINCT * FROM graph_edges) UNION ALL SELECT lower(tgt_id), properties ->> '$.description', gid FROM (SELECT DISTINCT * FROM graph_edges)),"
        " te AS (SELECT name, description, pos FROM kp UNION ALL SELECT name, description, pos FROM ed WHERE name NOT IN (SELECT name FROM kp)),"
        " tx AS (SELECT name, string_agg(description, '<SEP>' ORDER BY p) AS d FROM (SELECT name, description, min(pos) AS p FROM te WHERE regexp_replace(description, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY 1, 2) GROUP BY 1),"
        f" ff AS (SELECT name, f, min(o) AS o FROM (SELECT name, pos * 1000 + unnest(generate_series(0, len({FILES}) - 1)) AS o, unnest({FILES}) AS f FROM kp) GROUP BY 1, 2), fl AS (SELECT name, list(f ORDER BY o) AS l FROM ff GROUP BY 1)"
        " SELECT n.name, coalesce(vt.type, vo.type, 'UNKNOWN') AS type, coalesce(tx.d, 'Entity ' || n.name) AS description, coalesce(ids.ids, '') AS source_id, coalesce(array_to_string(CASE WHEN len(l) > 2 THEN list_append(l[1:2], '...truncated...(KEEP 2/' || len(l) || ')') ELSE l END, '<SEP>'), '') AS file_path, ids.ids IS NOT NULL AS survived"
        " FROM (SELECT DISTINCT name FROM r) n LEFT JOIN vt USING (name) LEFT JOIN vo USING (name) LEFT JOIN tx USING (name) LEFT JOIN ids USING (name) LEFT JOIN fl USING (name)"
    ),
    "g15_field_merge": f"WITH {RECORDS_SQL} SELECT name, coalesce(string_agg(type, '<SEP>' ORDER BY pos), '') AS concatenate, arg_min(type, pos) FILTER (type IS NOT NULL) AS keep_first, arg_max(type, pos) FILTER (type IS NOT NULL) AS keep_last, coalesce(array_to_string(list_sort(list(DISTINCT type) FILTER (type IS NOT NULL)), ','), '') AS join_unique_comma, max(type) AS max, coalesce((SELECT string_agg(t, '<SEP>' ORDER BY p) FROM (SELECT type AS t, min(pos) AS p FROM rec r WHERE r.name = rec.name AND type IS NOT NULL GROUP BY 1)), '') AS join_unique FROM rec WHERE name IS NOT NULL GROUP BY name",
    "g16_status_counts": "SELECT regexp_replace(lower(status), '^\\s+|\\s+$', '', 'g') AS status, count(*) AS n FROM (SELECT DISTINCT id, status FROM doc_status) GROUP BY 1",
    "g17_document_scores": "SELECT full_doc_id AS doc, round(max(s), 9) AS best, round(avg(s), 9) AS mean, round(arg_min(s, id), 9) AS first FROM (SELECT DISTINCT id, full_doc_id, coalesce(tokens, 0) / 480.0 AS s FROM text_chunks) GROUP BY 1",
}
