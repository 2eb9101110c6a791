"""Graph operators over the library's nodes and edges (ids as in the survey)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators import graph as g
from graphloom.sources.tables import table, unique

HUB, CAP, DEPTH, TOP = "Knowledge Graph", 1000, 2, 300


def nodes(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return unique(spark, d, "graph_nodes", "id", *columns)


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """The canonical pair table."""
    return g.canonical(unique(spark, d, "graph_edges", "src_id", "tgt_id", "weight", "source_id", "updated_at"))


def names(spark: SparkSession, d: str) -> DataFrame:
    return nodes(spark, d).select("id").where("id is not null").distinct()


NODES_SQL = "n AS (SELECT DISTINCT gid, id, entity_type, source_id, file_path, properties, created_at, updated_at FROM graph_nodes)"
PAIRS_SQL = (
    "p AS (SELECT a, b, gid, weight, source_id, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY coalesce(updated_at, TIMESTAMP '0001-01-01') DESC, gid DESC) AS r FROM"
    " (SELECT DISTINCT gid, least(src_id, tgt_id) AS a, greatest(src_id, tgt_id) AS b, weight, source_id, updated_at FROM graph_edges WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL AND src_id <> tgt_id)) WHERE r = 1)"
)
ADJ_SQL = "adj AS (SELECT a AS node, b AS nbr FROM p UNION ALL SELECT b, a FROM p)"
DEG_SQL = "deg AS (SELECT node AS id, count(*) AS degree FROM adj GROUP BY node)"
LAB_SQL = "lab AS (SELECT DISTINCT id FROM graph_nodes WHERE id IS NOT NULL)"
NDEG_SQL = "nd AS (SELECT lab.id, coalesce(degree, 0) AS degree FROM lab LEFT JOIN deg USING (id))"
ALL_SQL = f"WITH {NODES_SQL}, {PAIRS_SQL}, {ADJ_SQL}, {DEG_SQL}, {LAB_SQL}, {NDEG_SQL}"


def n01_degree(spark, d):
    return g.with_degree(names(spark, d), pairs(spark, d))


def n02_edge_degree(spark, d):
    return g.edge_degrees(pairs(spark, d)).select("a", "b", "rank")


def n03_popular_labels(spark, d):
    return g.popular(names(spark, d), pairs(spark, d), TOP)


def n04_label_search(spark, d):
    return g.search_labels(names(spark, d), "graph", 50)


def n05_subgraph(spark, d):
    return g.subgraph(table(spark, d, "graph_nodes").where("id is not null"), table(spark, d, "graph_edges"), HUB, DEPTH, CAP)


def _level(n: int) -> str:
    had = " UNION ALL ".join(f"SELECT id FROM l{i}" for i in range(n))
    return (
        f", c{n} AS (SELECT DISTINCT nbr AS id FROM adj JOIN lab ON lab.id = adj.nbr WHERE node IN (SELECT id FROM l{n - 1}) AND nbr NOT IN ({had}))"
        f", l{n} AS (SELECT id, {n} AS level FROM c{n} JOIN nd USING (id)"
        f" ORDER BY degree DESC, id LIMIT (SELECT greatest(0, {CAP} - count(*)) FROM ({had})))"
    )


def _cut_off() -> str:
    return " OR ".join(f"(SELECT count(*) FROM c{n}) > (SELECT count(*) FROM l{n}) AND (SELECT count(*) FROM l{n}) > 0" for n in range(1, DEPTH + 1))


def full_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The canonical pair table with all its fields."""
    p = g.canonical(unique(spark, d, "graph_edges", "src_id", "tgt_id", "weight", "source_id", "file_path", "properties", "updated_at"))
    field = lambda k: F.get_json_object("properties", f"$.{k}").alias(k)
    return p.select("a", "b", "gid", "weight", "source_id", "file_path", field("keywords"), field("description"))


def n06_whole_view(spark, d):
    top = g.popular(names(spark, d), pairs(spark, d), TOP)
    return g.induced(pairs(spark, d), top).select("a", "b", "weight")


def n07_get_edge(spark, d):
    """Every stored edge asked for from its far end."""
    asked = unique(spark, d, "graph_edges", "src_id", "tgt_id").select(F.col("tgt_id").alias("x"), F.col("src_id").alias("y")).distinct()
    p = pairs(spark, d).select("a", "b", "weight", F.lit(True).alias("has_edge"))
    return asked.select("x", "y", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("x is not null and y is not null").join(p, ["a", "b"], "left").select("x", "y", F.coalesce("has_edge", F.lit(False)).alias("has_edge"), "weight")


def n08_keyset(spark, d):
    return g.keyset(names(spark, d), "id", "M", 200)


def n09_delete_nodes(spark, d):
    """The pairs that stay after the hub and its neighbours' names that were deleted are gone."""
    gone = table(spark, d, "deletions").where("tbl = 'graph_nodes'").select(F.col("record_key").alias("id")).unionByName(spark.createDataFrame([(HUB,)], "id string"))
    return g.without_nodes(pairs(spark, d), gone).select("a", "b")


def n10_entity_delete(spark, d):
    """The keys left in each table when the hub is deleted with its vectors and tracking."""
    gone = spark.createDataFrame([(HUB,)], "id string")
    vec = table(spark, d, "faiss_docs").select("id", *(F.get_json_object("record", f"$.{k}").alias(k) for k in ("entity_name", "src_id", "tgt_id")))
    keep = lambda c: F.coalesce(F.col(c), F.lit("")) != HUB
    parts_ = [
        names(spark, d).join(gone, "id", "left_anti").select(F.lit("nodes").alias("tbl"), F.col("id").alias("key")),
        g.without_nodes(pairs(spark, d), gone).select(F.lit("edges").alias("tbl"), F.concat_ws("|", "a", "b").alias("key")),
        table(spark, d, "entity_chunks").join(gone, "id", "left_anti").select(F.lit("tracking").alias("tbl"), F.col("id").alias("key")),
        vec.where(keep("entity_name") & keep("src_id") & keep("tgt_id")).select(F.lit("vectors").alias("tbl"), F.col("id").alias("key")).distinct(),
    ]
    whole = parts_[0]
    for x in parts_[1:]:
        whole = whole.unionByName(x)
    return whole


def n11_relation_delete(spark, d):
    """The pairs that stay after those of no weight are deleted."""
    p = pairs(spark, d)
    gone = p.where("weight is null or weight <= 0").select("a", "b")
    return p.join(gone, ["a", "b"], "left_anti").select("a", "b", "weight")


NEW_NAME = "Knowledge Graph (renamed)"


def _renamed(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(HUB, NEW_NAME)], "old string, new string"))


def _alike(spark: SparkSession, d: str) -> DataFrame:
    """Names that differ in case, spacing and signs only, and the first of them."""
    n = names(spark, d).withColumn("key", F.lower(F.regexp_replace("id", r"[\s.,'’-]+", "")))
    return n.join(n.groupBy("key").agg(F.min("id").alias("new")), "key").select(F.col("id").alias("old"), "new")


def _full_nodes(spark: SparkSession, d: str) -> DataFrame:
    n = nodes(spark, d, "entity_type", "source_id", "file_path", "properties").where("id is not null")
    return n.select("id", "entity_type", F.get_json_object("properties", "$.description").alias("description"), "source_id", "file_path", "gid")


def n12_rename(spark, d):
    return g.redirect(full_pairs(spark, d), _renamed(spark))


def n12_tracking(spark, d):
    """Tracking rows after the hub is renamed."""
    return g.redirect_tracking(table(spark, d, "entity_chunks"), _renamed(spark)).select("id", F.array_join("chunk_ids", "|").alias("chunk_ids"), "chunk_count")


def n13_relation_edit(spark, d):
    """Every edge's weight edited to the one in its properties."""
    p = g.canonical(unique(spark, d, "graph_edges", "src_id", "tgt_id", "weight", "source_id", "properties", "updated_at"))
    return g.edited(p, p.select("a", "b", F.get_json_object("properties", "$.weight").try_cast("double").alias("weight")))


def n14_create(spark, d):
    """What creating a relation for each relation vector, and for each stored edge, answers."""
    asked = table(spark, d, "faiss_docs").select(*(F.get_json_object("record", f"$.{k}").alias(k) for k in ("src_id", "tgt_id")))
    return g.created(names(spark, d), pairs(spark, d), asked.unionByName(table(spark, d, "graph_edges").select("src_id", "tgt_id")))


def n15_merge_entities(spark, d):
    """All names that differ in case, spacing and signs only become the first of them: the pairs."""
    return g.redirect(full_pairs(spark, d), _alike(spark, d))


def n15_merged_nodes(spark, d):
    """The nodes after that merge."""
    return g.redirect_nodes(_full_nodes(spark, d), _alike(spark, d))


def n15_merged_tracking(spark, d):
    """The tracking rows after that merge."""
    return g.redirect_tracking(table(spark, d, "entity_chunks"), _alike(spark, d)).select("id", F.array_join("chunk_ids", "|").alias("chunk_ids"), "chunk_count")


def n16_evidence(spark, d):
    return g.evidence_counts(pairs(spark, d)).select("a", "b", "evidence")


def n17_info(spark, d):
    """Each node with its type, degree and number of tracked chunks."""
    t = table(spark, d, "entity_chunks").select("id", F.size("chunk_ids").alias("n"))
    n = nodes(spark, d, "entity_type").select("id", "entity_type").distinct()
    return g.with_degree(n, pairs(spark, d)).join(t, "id", "left").select("id", "entity_type", "degree", F.when(F.col("n") >= 0, F.col("n").cast("long")).alias("tracked"))


def n18_canonical(spark, d):
    return pairs(spark, d).select("a", "b", "gid", "weight")


def n19_migration(spark, d):
    """Counts that a migration checks: rows read, self-loops and null ends refused, folded duplicates, rows written."""
    e = unique(spark, d, "graph_edges", "src_id", "tgt_id")
    bad = F.col("src_id").isNull() | F.col("tgt_id").isNull()
    per = e.groupBy(F.when(bad, "null end").when(F.col("src_id") == F.col("tgt_id"), "self-loop").otherwise("read").alias("what")).agg(F.count("*").alias("rows"))
    return per.unionByName(pairs(spark, d).groupBy(F.lit("written").alias("what")).agg(F.count("*").alias("rows")))


LIST_SQL = "list_filter(list_transform(string_split(coalesce({0}, ''), '<SEP>'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"
SPLIT_SQL = f"list_distinct({LIST_SQL})"  # in no order
SRC = SPLIT_SQL.format("source_id")
EVID = f"len(list_filter({SRC}, lambda x: x NOT IN ('manual_creation', 'UNKNOWN')))"


_IN = LIST_SQL
_KEY_LIST = "list_filter(list_transform(string_split(replace(coalesce(keywords, ''), '，', ','), ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"
_BLANK = "regexp_replace(coalesce(description, ''), '^\\s+|\\s+$', '', 'g') = ''"
_ALIKE = "SELECT id AS old, min(id) OVER (PARTITION BY lower(regexp_replace(id, '[\\s.,''’-]+', '', 'g'))) AS new FROM lab"


def _united(rows: str, keys: str, column: str, order: str) -> str:
    """The distinct parts of joined lists in the order of their first place."""
    lst = _IN.format(column)
    return f"SELECT {keys}, string_agg(v, '<SEP>' ORDER BY o) AS {column} FROM (SELECT {keys}, v, min(struct_pack(g := {order}, i := i)) AS o FROM (SELECT *, unnest({lst}) AS v, unnest(generate_series(1, len({lst}))) AS i FROM {rows}) GROUP BY {keys}, v) GROUP BY {keys}"


def _redirect_sql(names_sql: str) -> str:
    return (
        f"{ALL_SQL}, m AS ({names_sql}), pf AS (SELECT p.a, p.b, p.gid, p.weight, p.source_id, e.file_path, e.properties ->> '$.keywords' AS keywords, e.properties ->> '$.description' AS description FROM p JOIN (SELECT DISTINCT gid, file_path, properties FROM graph_edges) e USING (gid)),"
        " q AS (SELECT coalesce(ma.new, a) AS x, coalesce(mb.new, b) AS y, pf.* FROM pf LEFT JOIN m ma ON ma.old = a LEFT JOIN m mb ON mb.old = b),"
        " r AS (SELECT least(x, y) AS c, greatest(x, y) AS d, gid, weight, source_id, file_path, keywords, description FROM q WHERE x <> y),"
        f" rs AS ({_united('r', 'c, d', 'source_id', 'gid')}), rf AS ({_united('r', 'c, d', 'file_path', 'gid')}),"
        f" rk AS (SELECT c, d, string_agg(k, ',' ORDER BY k) AS keywords FROM (SELECT DISTINCT c, d, unnest({_KEY_LIST}) AS k FROM r) GROUP BY 1, 2),"
        f" rd AS (SELECT c, d, string_agg(description, '<SEP>' ORDER BY g) AS description FROM (SELECT c, d, description, min(gid) AS g FROM r WHERE NOT ({_BLANK}) GROUP BY 1, 2, 3) GROUP BY 1, 2),"
        f" re AS (SELECT c, d, count(DISTINCT s) AS n FROM (SELECT c, d, unnest({SRC}) AS s FROM r) WHERE s NOT IN ('manual_creation', 'UNKNOWN') GROUP BY 1, 2)"
        " SELECT w.c AS a, w.d AS b, greatest(coalesce(w.w, 0.0), CAST(coalesce(re.n, 0) AS DOUBLE)) AS weight, coalesce(rs.source_id, '') AS source_id, coalesce(rf.file_path, '') AS file_path, coalesce(rk.keywords, '') AS keywords, coalesce(rd.description, '') AS description"
        " FROM (SELECT c, d, max(weight) AS w FROM r GROUP BY 1, 2) w" + "".join(f" LEFT JOIN {t} ON {t}.c = w.c AND {t}.d = w.d" for t in ("rs", "rf", "rk", "rd", "re"))
    )


def _tracking_sql(names_sql: str) -> str:
    return (
        f"{ALL_SQL}, m AS (SELECT * FROM ({names_sql}) WHERE old <> new), t AS (SELECT coalesce(new, id) AS k, new IS NULL AS own, id AS old, chunk_ids FROM entity_chunks LEFT JOIN m ON m.old = id),"
        " f AS (SELECT k, s, min(struct_pack(w := own, o := old, i := i)) AS o FROM (SELECT k, own, old, unnest(chunk_ids) AS s, unnest(generate_series(1, len(chunk_ids))) AS i FROM t) WHERE s IS NOT NULL GROUP BY 1, 2)"
        " SELECT k AS id, coalesce(string_agg(s, '|' ORDER BY o), '') AS chunk_ids, CAST(count(s) AS INTEGER) AS chunk_count FROM (SELECT DISTINCT k FROM t) LEFT JOIN f USING (k) GROUP BY k"
    )


_NODES_MERGED = (
    f"{ALL_SQL}, m AS (SELECT * FROM ({_ALIKE}) WHERE old <> new), t AS (SELECT coalesce(new, id) AS k, struct_pack(w := CASE WHEN new IS NULL THEN 1 ELSE 0 END, g := gid) AS o, entity_type, properties ->> '$.description' AS description, source_id, file_path FROM (SELECT DISTINCT gid, id, entity_type, properties, source_id, file_path FROM n WHERE id IS NOT NULL) x LEFT JOIN m ON m.old = x.id),"
    f" ts AS ({_united('t', 'k', 'source_id', 'o')}), tf AS ({_united('t', 'k', 'file_path', 'o')}),"
    " ty AS (SELECT k, arg_min(entity_type, o) AS entity_type FROM t WHERE regexp_replace(entity_type, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY 1),"
    f" td AS (SELECT k, string_agg(description, '<SEP>' ORDER BY g) AS description FROM (SELECT k, description, min(o) AS g FROM t WHERE NOT ({_BLANK}) GROUP BY 1, 2) GROUP BY 1)"
    " SELECT k AS id, entity_type, coalesce(description, '') AS description, coalesce(source_id, '') AS source_id, coalesce(file_path, '') AS file_path FROM (SELECT DISTINCT k FROM t) LEFT JOIN ty USING (k) LEFT JOIN td USING (k) LEFT JOIN ts USING (k) LEFT JOIN tf USING (k)"
)
_ASKED = "SELECT DISTINCT src_id, tgt_id FROM (SELECT record ->> '$.src_id' AS src_id, record ->> '$.tgt_id' AS tgt_id FROM faiss_docs UNION ALL SELECT src_id, tgt_id FROM graph_edges) WHERE src_id IS NOT NULL AND tgt_id IS NOT NULL"


QUERIES = {f.__name__: f for f in (n01_degree, n02_edge_degree, n03_popular_labels, n04_label_search, n05_subgraph, n06_whole_view, n07_get_edge, n08_keyset, n09_delete_nodes, n10_entity_delete, n11_relation_delete, n12_rename, n12_tracking, n13_relation_edit, n14_create, n15_merge_entities, n15_merged_nodes, n15_merged_tracking, n16_evidence, n17_info, n18_canonical, n19_migration)}
SQL = {
    "n01_degree": f"{ALL_SQL} SELECT id, degree FROM nd",
    "n02_edge_degree": f"{ALL_SQL} SELECT a, b, da.degree + db.degree AS rank FROM p JOIN deg da ON da.id = a JOIN deg db ON db.id = b",
    "n03_popular_labels": f"{ALL_SQL} SELECT id, degree FROM nd ORDER BY degree DESC, id LIMIT {TOP}",
    "n04_label_search": f"{ALL_SQL} SELECT id, CASE WHEN lower(id) = 'graph' THEN 1000 WHEN starts_with(lower(id), 'graph') THEN 500 ELSE 100 - length(id) + CASE WHEN contains(lower(id), ' graph') OR contains(lower(id), '_graph') THEN 50 ELSE 0 END END AS score FROM lab WHERE contains(lower(id), 'graph') ORDER BY score DESC, id LIMIT 50",
    "n05_subgraph": f"{ALL_SQL}, l0 AS (SELECT id, 0 AS level FROM lab WHERE id = '{HUB}')" + "".join(_level(i) for i in range(1, DEPTH + 1)) + " " + f"SELECT id, level, {_cut_off()} AS truncated FROM (" + " UNION ALL ".join(f"SELECT id, level FROM l{i}" for i in range(DEPTH + 1)) + ")",
    "n06_whole_view": f"{ALL_SQL}, top AS (SELECT id FROM nd ORDER BY degree DESC, id LIMIT {TOP}) SELECT a, b, weight FROM p WHERE a IN (SELECT id FROM top) AND b IN (SELECT id FROM top)",
    "n07_get_edge": f"{ALL_SQL} SELECT x, y, p.a IS NOT NULL AS has_edge, weight FROM (SELECT DISTINCT tgt_id AS x, src_id AS y FROM graph_edges WHERE tgt_id IS NOT NULL AND src_id IS NOT NULL) q LEFT JOIN p ON p.a = least(x, y) AND p.b = greatest(x, y)",
    "n08_keyset": f"{ALL_SQL} SELECT id FROM lab WHERE id > 'M' ORDER BY id LIMIT 200",
    "n09_delete_nodes": f"{ALL_SQL}, gone AS (SELECT record_key AS id FROM deletions WHERE tbl = 'graph_nodes' UNION ALL SELECT '{HUB}') SELECT a, b FROM p WHERE a NOT IN (SELECT id FROM gone) AND b NOT IN (SELECT id FROM gone)",
    "n10_entity_delete": f"{ALL_SQL} SELECT 'nodes' AS tbl, id AS key FROM lab WHERE id <> '{HUB}' UNION ALL SELECT 'edges', a || '|' || b FROM p WHERE a <> '{HUB}' AND b <> '{HUB}' UNION ALL SELECT 'tracking', id FROM entity_chunks WHERE id <> '{HUB}' UNION ALL SELECT DISTINCT 'vectors', id FROM faiss_docs WHERE coalesce(record ->> '$.entity_name', '') <> '{HUB}' AND coalesce(record ->> '$.src_id', '') <> '{HUB}' AND coalesce(record ->> '$.tgt_id', '') <> '{HUB}'",
    "n11_relation_delete": f"{ALL_SQL} SELECT a, b, weight FROM p WHERE weight > 0",
    "n12_rename": _redirect_sql(f"SELECT '{HUB}' AS old, '{NEW_NAME}' AS new"),
    "n12_tracking": _tracking_sql(f"SELECT '{HUB}' AS old, '{NEW_NAME}' AS new"),
    "n13_relation_edit": f"{ALL_SQL} SELECT a, b, CASE WHEN w > 0 AND w >= n THEN w ELSE weight END AS weight, CASE WHEN w IS NULL THEN 'kept' WHEN w > 0 AND w >= n THEN 'edited' ELSE 'refused' END AS outcome FROM (SELECT p.a, p.b, p.weight, {EVID} AS n, TRY_CAST(e.properties ->> '$.weight' AS DOUBLE) AS w FROM p JOIN (SELECT DISTINCT gid, properties FROM graph_edges) e USING (gid))",
    "n14_create": f"{ALL_SQL} SELECT src_id, tgt_id, CASE WHEN src_id = tgt_id THEN 'self-loop' WHEN src_id NOT IN (SELECT id FROM lab) OR tgt_id NOT IN (SELECT id FROM lab) THEN 'endpoint missing' WHEN p.a IS NOT NULL THEN 'exists' ELSE 'created' END AS state FROM ({_ASKED}) x LEFT JOIN p ON p.a = least(src_id, tgt_id) AND p.b = greatest(src_id, tgt_id)",
    "n15_merge_entities": _redirect_sql(_ALIKE),
    "n15_merged_nodes": _NODES_MERGED,
    "n15_merged_tracking": _tracking_sql(_ALIKE),
    "n16_evidence": f"{ALL_SQL} SELECT a, b, {EVID} AS evidence FROM p",
    "n17_info": f"{ALL_SQL} SELECT n.id, n.entity_type, coalesce(degree, 0) AS degree, CAST(len(chunk_ids) AS BIGINT) AS tracked FROM (SELECT DISTINCT id, entity_type FROM n) n LEFT JOIN deg USING (id) LEFT JOIN entity_chunks e ON e.id = n.id",
    "n18_canonical": f"{ALL_SQL} SELECT a, b, gid, weight FROM p",
    "n19_migration": f"{ALL_SQL} SELECT CASE WHEN src_id IS NULL OR tgt_id IS NULL THEN 'null end' WHEN src_id = tgt_id THEN 'self-loop' ELSE 'read' END AS what, count(*) AS rows FROM (SELECT DISTINCT gid, src_id, tgt_id FROM graph_edges) GROUP BY 1 UNION ALL SELECT 'written', count(*) FROM p",
}
