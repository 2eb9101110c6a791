"""Retrieval legs, ranked lists, chunk choice and joins by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import parts, tokens
from graphloom.operators import graph, quality, retrieval
from graphloom.plans.graph_queries import ALL_SQL, HUB, SPLIT_SQL, names, pairs
from graphloom.sources.tables import table, unique

K, TOP = 40, 20
WORDS = ["glacier", "survey", "tidal", "archive", "catalogue", "of", "nested"]
BUDGET = 60_000


def vectors(spark: SparkSession, d: str) -> DataFrame:
    """The last write of every id that has a comparable vector: id, vector, entity_name, src_id, tgt_id."""
    v = table(spark, d, "faiss_docs").select("id", "vector", *(F.get_json_object("record", f"$.{k}").alias(k) for k in ("__write_seq__", "entity_name", "src_id", "tgt_id")))
    last = v.groupBy("id").agg(F.max_by(F.struct("vector", "entity_name", "src_id", "tgt_id"), F.col("__write_seq__").try_cast("long")).alias("x")).select("id", "x.*")
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return last.where((F.size("vector") == 64) & sound & F.exists("vector", lambda x: x != 0))


VEC_SQL = (
    "v0 AS (SELECT id, vector, record ->> '$.entity_name' AS entity_name, record ->> '$.src_id' AS src_id, record ->> '$.tgt_id' AS tgt_id, row_number() OVER (PARTITION BY id ORDER BY CAST(record ->> '$.__write_seq__' AS BIGINT) DESC) AS r FROM faiss_docs),"
    " vec AS (SELECT id, CAST(vector AS DOUBLE[]) AS vector, entity_name, src_id, tgt_id FROM v0 WHERE r = 1 AND len(vector) = 64 AND len(list_filter(vector, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(vector, lambda x: x <> 0)) > 0),"
    " q AS (SELECT vector AS qv FROM vec WHERE entity_name IS NOT NULL ORDER BY id LIMIT 1)"
)


def query_vector(v: DataFrame) -> list[float]:
    """The vector of the first entity stands for the embedded query."""
    return v.where("entity_name is not null").orderBy("id").select("vector").first()["vector"]


def _hits(kind: str) -> str:
    return f"h AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) - 1 AS pos FROM (SELECT id, entity_name, src_id, tgt_id, list_cosine_similarity(vector, qv) AS score FROM vec, q WHERE {kind} IS NOT NULL) WHERE score >= 0.2 ORDER BY score DESC, id LIMIT {K})"


def entity_hits(spark, d) -> DataFrame:
    v = vectors(spark, d)
    return retrieval.search(v.where("entity_name is not null"), query_vector(v), K, carry=("entity_name",))


def relation_hits(spark, d) -> DataFrame:
    v = vectors(spark, d)
    return retrieval.search(v.where("src_id is not null"), query_vector(v), K, carry=("src_id", "tgt_id"))


def r01_vector_search(spark, d):
    return entity_hits(spark, d).select("id", F.round("score", 6).alias("score"), "pos")


def r03_rank_given(spark, d):
    """The vectors of the hub's neighbours, ranked."""
    v = vectors(spark, d)
    near = graph.adjacency(pairs(spark, d)).where(F.col("node") == HUB).select(F.col("nbr").alias("entity_name"))
    return retrieval.search(v.join(near, "entity_name", "left_semi"), query_vector(v), K, -1.0).select("id", F.round("score", 6).alias("score"), "pos")


def _local(spark, d) -> DataFrame:
    n = graph.with_degree(names(spark, d), pairs(spark, d))
    return F.broadcast(entity_hits(spark, d)).join(n.withColumnRenamed("id", "entity_name"), "entity_name").select("entity_name", "degree", "pos")


def r04_local_leg(spark, d):
    return _local(spark, d)


def r05_local_edges(spark, d):
    p = pairs(spark, d)
    hits = _local(spark, d).select(F.col("entity_name").alias("node"), "pos")
    near = graph.adjacency(p, "weight").join(F.broadcast(hits), "node").select(F.least("node", "nbr").alias("a"), F.greatest("node", "nbr").alias("b"), "weight", "pos", "nbr")
    first = near.groupBy("a", "b").agg(F.min(F.struct("pos", "nbr")).alias("first"), F.max("weight").alias("weight"))
    ranked = graph.edge_degrees(p.select("a", "b")).join(F.broadcast(first), ["a", "b"]).orderBy(F.desc("rank"), F.desc("weight"), "first").limit(100)
    return ranked.select("a", "b", "rank", F.coalesce("weight", F.lit(1.0)).alias("weight"))


def r06_global_leg(spark, d):
    """Hit relations in order, with their stored weight."""
    h = relation_hits(spark, d).select(F.least("src_id", "tgt_id").alias("a"), F.greatest("src_id", "tgt_id").alias("b"), "pos")
    return pairs(spark, d).select("a", "b", "weight").join(F.broadcast(h), ["a", "b"]).select("a", "b", F.coalesce("weight", F.lit(1.0)).alias("weight"), "pos")


def j04_endpoints(spark, d):
    """Ends of the hit relations, first seen first (source before target)."""
    h = relation_hits(spark, d).select("pos", F.posexplode(F.array("src_id", "tgt_id")).alias("i", "id"))
    first = h.groupBy("id").agg(F.min(F.struct("pos", "i")).alias("x"))
    return names(spark, d).join(F.broadcast(first), "id").select("id", (F.col("x.pos") * 2 + F.col("x.i")).alias("place"))


def r07_vector_leg(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return retrieval.search(e, e.where("id = 0").first()["vector"], TOP).select("id", F.round("score", 6).alias("score"), "pos")


def chunks(spark, d) -> DataFrame:
    """Chunks as they were sent; operators on them count copies once by id, so that no text is shuffled for it."""
    return table(spark, d, "text_chunks").select("id", "full_doc_id", "content", "file_path", "chunk_order_index")


def lex(spark, d, k: int = K) -> DataFrame:
    return retrieval.lexical_leg(chunks(spark, d), WORDS, k)


def r08_lexical_leg(spark, d):
    return lex(spark, d).select("id", F.round("score", 6).alias("score"), "pos")


def bibliography_sql(x: str) -> str:
    """is_bibliography in SQL."""
    q = lambda p: "'" + p.replace("'", "''") + "'"
    m = lambda p: f"regexp_matches(l, {q(p)})"
    n = lambda p: f"len(regexp_extract_all(l, {q(p)}))"
    packed = f"length(l) > 600 AND {m(quality.ENTRY)} AND {n('(?i)doi|https?://')} >= 3 AND {n(quality.YEAR)} >= 5"
    return f"(len(list_filter(string_split({x}, chr(10)), lambda l: {m(quality.ENTRY)} AND {m(quality.YEAR)} AND {m(quality.CUE)})) >= 5 OR len(list_filter(string_split({x}, chr(10)), lambda l: {packed})) > 0)"


_QUESTION = retrieval.question_terms(WORDS)
_TERMS = "'" + "', '".join(_QUESTION) + "'"
_MOST = f"greatest({retrieval.COMMON_LEAST}, {retrieval.COMMON_PCT} * (SELECT count(*) FROM ch) / 100)"


def _lex_sql(k: int) -> str:
    return (
        "ch AS (SELECT DISTINCT id, full_doc_id, content, file_path, chunk_order_index FROM text_chunks), ht AS (SELECT id, unnest(list_filter(list_distinct(regexp_split_to_array(lower(content), '[^a-z]+')), lambda t: t IN (" + _TERMS + "))) AS w FROM ch),"
        f" dw AS (SELECT w, count(*) AS df, count(*) > {_MOST} AS common FROM ht GROUP BY w), fw AS (SELECT coalesce(min(ln((SELECT count(*) FROM ch) / (df + 1.0))), 0.0) AS f FROM dw WHERE NOT common),"
        " wt AS (SELECT w, df, common, CASE WHEN common THEN f ELSE ln((SELECT count(*) FROM ch) / (df + 1.0)) END AS wt FROM dw, fw), rare AS (SELECT w FROM wt WHERE NOT common ORDER BY df, w LIMIT 3),"
        f" l0 AS (SELECT id, round(sum(wt), 9) AS score FROM ht JOIN wt USING (w) GROUP BY id), l1 AS (SELECT * FROM l0 WHERE id IN (SELECT id FROM ht WHERE w IN (SELECT w FROM rare)) ORDER BY score DESC, id LIMIT {3 * k}),"
        f" lx AS (SELECT id, score, row_number() OVER (ORDER BY score DESC, id) - 1 AS pos FROM (SELECT l1.* FROM l1 JOIN ch USING (id) WHERE NOT {bibliography_sql('content')} ORDER BY score DESC, id LIMIT {k}))"
    )


LEX_SQL = _lex_sql(K)


def _lists(spark, d) -> list[DataFrame]:
    pop = retrieval.ranked(graph.popular(names(spark, d), pairs(spark, d), K), [F.desc("degree"), F.asc("id")])
    lab = retrieval.ranked(graph.search_labels(names(spark, d), "archive", K), [F.desc("score"), F.asc("id")])
    hit = entity_hits(spark, d).select(F.col("entity_name").alias("id"), "pos")
    return [hit, pop, lab]


LISTS_SQL = (
    f"{ALL_SQL}, {VEC_SQL}, {_hits('entity_name')}, po AS (SELECT id, row_number() OVER (ORDER BY degree DESC, id) - 1 AS pos FROM nd ORDER BY degree DESC, id LIMIT {K}),"
    " sc AS (SELECT id, CASE WHEN lower(id) = 'archive' THEN 1000 WHEN starts_with(lower(id), 'archive') THEN 500 ELSE 100 - length(id) + CASE WHEN contains(lower(id), ' archive') OR contains(lower(id), '_archive') THEN 50 ELSE 0 END END AS s FROM lab WHERE contains(lower(id), 'archive')),"
    f" la AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) - 1 AS pos FROM sc ORDER BY s DESC, id LIMIT {K}),"
    " li AS (SELECT entity_name AS id, 0 AS leg, pos FROM h UNION ALL SELECT id, 1, pos FROM po UNION ALL SELECT id, 2, pos FROM la)"
)


def r12_interleave(spark, d):
    return retrieval.interleave(_lists(spark, d)).select("id", "leg", "pos", "rank")


def r13_prepend(spark, d):
    return retrieval.prepend(_lists(spark, d)).select("id", "rank")


def _owned(spark, d) -> DataFrame:
    pop = retrieval.ranked(graph.popular(names(spark, d), pairs(spark, d), TOP), [F.desc("degree"), F.asc("id")])
    t = table(spark, d, "entity_chunks").join(F.broadcast(pop.select("id", F.col("pos").alias("group_pos"))), "id")
    return retrieval.owned_chunks(t.select("group_pos", F.posexplode("chunk_ids").alias("pos", "chunk_id")).where("chunk_id is not null"))


def r14_owned_chunks(spark, d):
    return _owned(spark, d).select("group_pos", "chunk_id", F.col("occurrence").cast("long").alias("occurrence"), F.col("place").cast("long").alias("place"))


def r16_pick_by_weight(spark, d):
    return retrieval.pick_by_weight(_owned(spark, d), 5).select("group_pos", "chunk_id")


OWNED_SQL = (
    f"{ALL_SQL}, po AS (SELECT id, row_number() OVER (ORDER BY degree DESC, id) - 1 AS group_pos FROM nd ORDER BY degree DESC, id LIMIT {TOP}),"
    " gc AS (SELECT group_pos, unnest(chunk_ids) AS chunk_id, unnest(generate_series(0, len(chunk_ids) - 1)) AS pos FROM entity_chunks JOIN po USING (id)),"
    " oc AS (SELECT *, count(*) OVER (PARTITION BY chunk_id) AS occurrence, row_number() OVER (PARTITION BY chunk_id ORDER BY group_pos, pos) AS r FROM gc WHERE chunk_id IS NOT NULL),"
    " ow AS (SELECT group_pos, chunk_id, occurrence, row_number() OVER (PARTITION BY group_pos ORDER BY occurrence DESC, pos) AS place FROM oc WHERE r = 1)"
)


def r17_relation_chunks(spark, d):
    """Chunks of the hit relations that the entity groups have not given."""
    h = relation_hits(spark, d).select(F.least("src_id", "tgt_id").alias("a"), F.greatest("src_id", "tgt_id").alias("b"), F.col("pos").alias("group_pos"))
    g = pairs(spark, d).join(F.broadcast(h), ["a", "b"]).select("group_pos", F.explode(parts(F.col("source_id"))).alias("chunk_id"))
    taken = retrieval.pick_by_weight(_owned(spark, d), 5).select("chunk_id")
    return g.join(taken, "chunk_id", "left_anti").select("group_pos", "chunk_id").distinct()


def j05_chunk_lookup(spark, d):
    picked = retrieval.pick_by_weight(_owned(spark, d), 5)
    hits = picked.select(F.col("chunk_id").alias("id"), "group_pos")
    return retrieval.with_rows(hits, chunks(spark, d), "content").select("id", "group_pos", F.length("content").cast("long").alias("size"))


def r18_token_budget(spark, d):
    c = retrieval.with_rows(lex(spark, d), chunks(spark, d), "content").select("id", "pos", F.coalesce(tokens(F.col("content")), F.lit(0)).cast("long").alias("tokens"))
    return retrieval.within_budget(c, F.col("tokens"), [F.asc("pos")], BUDGET).select("id", "pos", F.col("running").cast("long").alias("running"))


def r21_work_cap(spark, d):
    c = retrieval.with_rows(lex(spark, d), chunks(spark, d), "full_doc_id")
    return retrieval.capped_per_work(c, "full_doc_id", [F.asc("pos")], 1).select("id", "full_doc_id", "pos")


def r23_references(spark, d):
    return retrieval.references(retrieval.with_rows(lex(spark, d), chunks(spark, d), "file_path").where("file_path is not null"))


def r28_cache_key(spark, d):
    """Keys of the answer cache for each mode over the same knobs."""
    modes = spark.createDataFrame([(m,) for m in ("local", "global", "hybrid", "mix", "naive")], "mode string")
    return modes.select("mode", F.concat(F.col("mode"), F.lit(":query:"), F.md5(F.concat_ws("|", "mode", F.lit(" ".join(WORDS)), F.lit(str(K)), F.lit(str(BUDGET))))).alias("key"))


def r15_pick_by_vector(spark, d):
    """The hub's neighbours by similarity: groups are the popular names, candidates their neighbours with vectors."""
    v = vectors(spark, d)
    pop = retrieval.ranked(graph.popular(names(spark, d), pairs(spark, d), TOP), [F.desc("degree"), F.asc("id")])
    near = graph.adjacency(pairs(spark, d)).join(F.broadcast(pop.select(F.col("id").alias("node"), F.col("pos").alias("group_pos"))), "node")
    groups = near.select("group_pos", F.col("nbr").alias("chunk_id"), F.col("nbr").alias("pos"))
    picked = retrieval.pick_by_vector(retrieval.owned_chunks(groups), v.where("entity_name is not null").select(F.col("entity_name").alias("id"), "vector"), query_vector(v), 5, TOP)
    return picked.select("chunk_id", "group_pos", F.round("score", 6).alias("score"))


def j03_incident_edges(spark, d):
    """Pairs at the popular names, once each."""
    pop = graph.popular(names(spark, d), pairs(spark, d), TOP)
    near = graph.adjacency(pairs(spark, d)).join(F.broadcast(pop.select(F.col("id").alias("node"))), "node")
    return near.select(F.least("node", "nbr").alias("a"), F.greatest("node", "nbr").alias("b")).distinct()


def j07_contributions(spark, d):
    """Names that each document's tracked chunks support."""
    t = table(spark, d, "entity_chunks").select("id", F.explode("chunk_ids").alias("s")).where("s is not null")
    return t.select("id", F.substring("s", 1, 36).alias("doc_id")).distinct().groupBy("doc_id").agg(F.count("*").alias("names"))


def j08_coauthors(spark, d):
    """Pairs of authors with the number of papers they share."""
    a = table(spark, d, "papers").select("paper_id", F.explode("authors.author_id").alias("x")).where("x is not null").distinct()
    both = a.join(a.withColumnRenamed("x", "y"), "paper_id").where("x < y")
    return both.groupBy("x", "y").agg(F.count("*").alias("papers"))


def j09_contained(spark, d):
    return graph.induced(pairs(spark, d), graph.popular(names(spark, d), pairs(spark, d), TOP)).select("a", "b")


QUERIES = {f.__name__: f for f in (r01_vector_search, r03_rank_given, r04_local_leg, r05_local_edges, r06_global_leg, j03_incident_edges, j04_endpoints, j05_chunk_lookup, j07_contributions, j08_coauthors, j09_contained, r07_vector_leg, r08_lexical_leg, r12_interleave, r13_prepend, r14_owned_chunks, r15_pick_by_vector, r16_pick_by_weight, r17_relation_chunks, r18_token_budget, r21_work_cap, r23_references, r28_cache_key)}
_LOCAL = f"{ALL_SQL}, {VEC_SQL}, {_hits('entity_name')}, lo AS (SELECT entity_name, degree, pos FROM h JOIN nd ON nd.id = h.entity_name)"
_GLOBAL = f"{ALL_SQL}, {VEC_SQL}, {_hits('src_id')}, ga AS (SELECT least(src_id, tgt_id) AS a, greatest(src_id, tgt_id) AS b, pos FROM h), en AS (SELECT id, min(place) AS place FROM (SELECT src_id AS id, pos * 2 AS place FROM h UNION ALL SELECT tgt_id, pos * 2 + 1 FROM h) JOIN lab USING (id) GROUP BY id)"
_TAKEN = "cnt AS (SELECT group_pos, count(*) AS n FROM ow GROUP BY 1), g0 AS (SELECT *, row_number() OVER (ORDER BY group_pos) - 1 AS i, count(*) OVER () AS m FROM cnt), g1 AS (SELECT *, CAST(CASE WHEN m = 1 THEN 5 ELSE round_even(5 - i / (m - 1.0) * 4, 0) END AS INTEGER) AS want FROM g0), g2 AS (SELECT *, least(want, n) AS base, n - least(want, n) AS more FROM g1), g3 AS (SELECT group_pos, base + greatest(0, least(more, sum(want - base) OVER () - coalesce(sum(more) OVER (ORDER BY group_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS quota FROM g2), tk AS (SELECT ow.group_pos, chunk_id FROM ow JOIN g3 USING (group_pos) WHERE place <= quota)"
SQL = {
    "r01_vector_search": f"WITH {VEC_SQL}, {_hits('entity_name')} SELECT id, round(score, 6) AS score, pos FROM h",
    "r03_rank_given": f"{ALL_SQL}, {VEC_SQL} SELECT id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, id) - 1 AS pos FROM (SELECT vec.id, list_cosine_similarity(vector, qv) AS score FROM vec, q WHERE entity_name IN (SELECT nbr FROM adj WHERE node = '{HUB}')) WHERE score >= -1 ORDER BY score DESC, id LIMIT {K}",
    "r04_local_leg": f"{_LOCAL} SELECT entity_name, degree, pos FROM lo",
    "r05_local_edges": f"{_LOCAL}, ne AS (SELECT least(node, nbr) AS a, greatest(node, nbr) AS b, min(struct_pack(p := pos, n := nbr)) AS first FROM adj JOIN lo ON lo.entity_name = adj.node GROUP BY 1, 2) SELECT ne.a, ne.b, x.degree + y.degree AS rank, coalesce(p.weight, 1.0) AS weight FROM ne JOIN p ON p.a = ne.a AND p.b = ne.b JOIN deg x ON x.id = ne.a JOIN deg y ON y.id = ne.b ORDER BY rank DESC, p.weight DESC NULLS LAST, first LIMIT 100",
    "r06_global_leg": f"{_GLOBAL} SELECT p.a, p.b, coalesce(weight, 1.0) AS weight, pos FROM p JOIN ga ON ga.a = p.a AND ga.b = p.b",
    "j03_incident_edges": f"{ALL_SQL}, po AS (SELECT id FROM nd ORDER BY degree DESC, id LIMIT {TOP}) SELECT a, b FROM p WHERE a IN (SELECT id FROM po) OR b IN (SELECT id FROM po)",
    "j04_endpoints": f"{_GLOBAL} SELECT id, place FROM en",
    "j05_chunk_lookup": f"{OWNED_SQL}, {_TAKEN} SELECT id, group_pos, CAST(length(content) AS BIGINT) AS size FROM tk JOIN (SELECT DISTINCT id, content FROM text_chunks) c ON c.id = tk.chunk_id",
    "j07_contributions": "SELECT left(s, 36) AS doc_id, count(DISTINCT id) AS names FROM (SELECT id, unnest(chunk_ids) AS s FROM entity_chunks) WHERE s IS NOT NULL GROUP BY 1",
    "j08_coauthors": "WITH a AS (SELECT DISTINCT paper_id, unnest(authors).author_id AS x FROM papers) SELECT a.x, b.x AS y, count(*) AS papers FROM a JOIN a b ON a.paper_id = b.paper_id AND a.x < b.x GROUP BY 1, 2",
    "j09_contained": f"{ALL_SQL}, po AS (SELECT id FROM nd ORDER BY degree DESC, id LIMIT {TOP}) SELECT a, b FROM p WHERE a IN (SELECT id FROM po) AND b IN (SELECT id FROM po)",
    "r07_vector_leg": f"SELECT id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, id) - 1 AS pos FROM (SELECT e.vec_id AS id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q) WHERE score >= 0.2 ORDER BY score DESC, id LIMIT {TOP}",
    "r08_lexical_leg": f"WITH {LEX_SQL} SELECT id, round(score, 6) AS score, pos FROM lx",
    "r12_interleave": f"{LISTS_SQL} SELECT id, x.l AS leg, x.p AS pos, row_number() OVER (ORDER BY x) - 1 AS rank FROM (SELECT id, min(struct_pack(p := pos, l := leg)) AS x FROM li GROUP BY id)",
    "r13_prepend": f"{LISTS_SQL} SELECT id, row_number() OVER (ORDER BY x) - 1 AS rank FROM (SELECT id, min(struct_pack(l := leg, p := pos)) AS x FROM li GROUP BY id)",
    "r14_owned_chunks": f"{OWNED_SQL} SELECT group_pos, chunk_id, occurrence, place FROM ow",
    "r15_pick_by_vector": f"{ALL_SQL}, {VEC_SQL}, po AS (SELECT id, row_number() OVER (ORDER BY degree DESC, id) - 1 AS group_pos FROM nd ORDER BY degree DESC, id LIMIT {TOP}), g0 AS (SELECT group_pos, nbr FROM adj JOIN po ON po.id = adj.node), g1 AS (SELECT *, count(*) OVER (PARTITION BY nbr) AS occ, row_number() OVER (PARTITION BY nbr ORDER BY group_pos) AS r FROM g0), g2 AS (SELECT *, row_number() OVER (PARTITION BY group_pos ORDER BY occ DESC, nbr) AS place FROM g1 WHERE r = 1) SELECT nbr AS chunk_id, group_pos, round(score, 6) AS score FROM (SELECT nbr, group_pos, place, list_cosine_similarity(vector, qv) AS score FROM g2 JOIN vec ON vec.entity_name = g2.nbr, q) ORDER BY score DESC, group_pos, place LIMIT 50",
    "r16_pick_by_weight": f"{OWNED_SQL}, {_TAKEN} SELECT group_pos, chunk_id FROM tk",
    "r17_relation_chunks": f"{OWNED_SQL}, {_TAKEN}, {VEC_SQL}, {_hits('src_id')} SELECT DISTINCT pos AS group_pos, s AS chunk_id FROM (SELECT h.pos, unnest({SPLIT_SQL.format('source_id')}) AS s FROM p JOIN h ON p.a = least(h.src_id, h.tgt_id) AND p.b = greatest(h.src_id, h.tgt_id)) WHERE s NOT IN (SELECT chunk_id FROM tk)",
    "r18_token_budget": f"WITH {LEX_SQL} SELECT id, pos, CAST(running AS BIGINT) AS running FROM (SELECT lx.id, pos, sum(coalesce(length(content), 0)) OVER (ORDER BY pos) AS running FROM lx JOIN ch USING (id)) WHERE running <= {BUDGET}",
    "r21_work_cap": f"WITH {LEX_SQL} SELECT id, full_doc_id, pos FROM (SELECT lx.id, full_doc_id, pos, row_number() OVER (PARTITION BY full_doc_id ORDER BY pos) AS r FROM lx JOIN ch USING (id)) WHERE r = 1",
    "r23_references": f"WITH {LEX_SQL} SELECT row_number() OVER (ORDER BY n DESC, first) AS reference, file_path FROM (SELECT file_path, count(*) AS n, min(pos) AS first FROM lx JOIN ch USING (id) WHERE file_path IS NOT NULL GROUP BY 1)",
    "r28_cache_key": f"SELECT mode, mode || ':query:' || md5(mode || '|{' '.join(WORDS)}|{K}|{BUDGET}') AS key FROM (VALUES ('local'), ('global'), ('hybrid'), ('mix'), ('naive')) t(mode)",
}
