"""Citation structure, document lifecycle, evaluation and maintenance over the library's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import parts, strip
from graphloom.operators import citation, evaluation, graph, lifecycle, maintenance, merge, references, retrieval, timejoins, tools
from graphloom.plans import merge_queries
from graphloom.plans.graph_queries import ALL_SQL, LIST_SQL, SPLIT_SQL, full_pairs, names, pairs
from graphloom.sources import stores
from graphloom.session import cut
from graphloom.sources.tables import table, unique

PAPER, OTHER, TOPIC = 1, 100, "STANDARD"


def lists(spark: SparkSession, d: str) -> DataFrame:
    """Parts stand for papers, orders for reference lists."""
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("list_id"), F.col("l_partkey").alias("item"))


def cites(spark: SparkSession, d: str) -> DataFrame:
    """The part of each order line cites the part of the next line."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    nxt = li.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("p").alias("dst"))
    return li.join(nxt, ["l_orderkey", "l_linenumber"]).where("p <> dst").select(F.col("p").alias("src"), "dst").distinct()


def links(spark, d) -> DataFrame:
    return citation.link_weights(cites(spark, d), citation.coupling(lists(spark, d)))


CITE_SQL = (
    "li AS (SELECT l_orderkey AS o, l_linenumber AS n, min(l_partkey) AS p FROM lineitem GROUP BY 1, 2), ci AS (SELECT DISTINCT a.p AS src, b.p AS dst FROM li a JOIN li b ON a.o = b.o AND a.n = b.n - 1 WHERE a.p <> b.p),"
    " rl AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS i FROM lineitem), cp AS (SELECT a.i AS x, b.i AS y, count(*) AS shared FROM rl a JOIN rl b ON a.o = b.o AND a.i < b.i GROUP BY 1, 2),"
    " lk AS (SELECT x, y, sum(w) AS weight FROM (SELECT DISTINCT least(src, dst) AS x, greatest(src, dst) AS y, 1.0::DOUBLE AS w FROM ci UNION ALL SELECT x, y, shared * 2.0::DOUBLE FROM cp) GROUP BY 1, 2),"
    " ad AS (SELECT x AS node, y AS nbr, weight FROM lk UNION ALL SELECT y, x, weight FROM lk), dg AS (SELECT node, count(*) AS deg FROM ad GROUP BY 1)"
)


def topics(spark, d) -> tuple[DataFrame, DataFrame]:
    """Types of parts as topics, with the brands of each type below it."""
    p = table(spark, d, "part").select("p_partkey", "p_type", F.concat_ws(" / ", "p_type", "p_brand").alias("leaf"))
    tree = p.select(F.col("leaf").alias("topic"), F.col("p_type").alias("parent")).unionByName(p.select(F.col("p_type").alias("topic"), F.lit(None).cast("string").alias("parent"))).distinct()
    return tree, p.select(F.col("p_partkey").alias("paper"), F.col("leaf").alias("topic")).unionByName(p.where("p_partkey = 1").select(F.col("p_partkey").alias("paper"), F.col("p_type").alias("topic")))


def authors(spark, d) -> DataFrame:
    """Suppliers of a part stand for its authors."""
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("paper"), F.col("l_suppkey").alias("author")).distinct()


def z01_structure(spark, d):
    """Citations in both directions and coupled papers of every paper."""
    return citation.structure(cites(spark, d), citation.coupling(lists(spark, d)))


def z01_coupling(spark, d):
    return citation.coupling(lists(spark, d))


def z02_related(spark, d):
    years = table(spark, d, "part").select(F.col("p_partkey").alias("paper"), F.col("p_size").alias("year"))
    return citation.related(cites(spark, d), citation.coupling(lists(spark, d)), authors(spark, d), years, PAPER, 50)


def z03_topic_papers(spark, d):
    tree, papers = topics(spark, d)
    return citation.under_topic(papers, citation.ancestors(tree), TOPIC)


def z04_topic_search(spark, d):
    tree, _ = topics(spark, d)
    t = tree.select("topic").distinct()
    asked = ("brand#1", "stan", "brand#12 econ", "brand#1 tin", "bra")
    whole = None
    for q in asked:
        x = citation.topic_search(t, q).select(F.lit(q).alias("query"), "topic")
        whole = x if whole is None else whole.unionByName(x)
    return whole


def z05_cheapest(spark, d):
    return citation.cheapest(links(spark, d), PAPER, 2).select("node", F.round("cost", 6).alias("cost"), "hops")


def z05_paths(spark, d):
    """The three cheapest paths between two papers, of six hops at most."""
    return citation.cheapest_paths(links(spark, d), PAPER, OTHER, 3, 6).select("pos", F.round("cost", 6).alias("cost"), "hops", "path")


def z06_map(spark, d):
    return citation.paper_map(links(spark, d), PAPER, 20).select("node", "hop", F.round("strength", 6).alias("strength"))


def z07_thinned(spark, d):
    seeds = spark.createDataFrame([(PAPER,)], "node long")
    return citation.thinned(links(spark, d), seeds, 4000)


def z08_link_weights(spark, d):
    return links(spark, d)


def z09_dois(spark, d):
    return table(spark, d, "papers").select("paper_id", citation.doi(F.col("doi")).alias("doi")).distinct()


def papers(spark, d) -> DataFrame:
    return unique(spark, d, "papers", "title", "venue", "authors", "pub_year")


def z09_resolve(spark, d):
    """Papers by their DOIs as typed, their titles in capitals and their ids."""
    p = papers_full(spark, d)
    asked = p.select(F.explode(F.array("doi", F.upper("title"), "paper_id", F.concat(F.lit("https://doi.org/"), "doi"))).alias("asked"))
    return citation.resolve(p, asked)


def papers_full(spark, d) -> DataFrame:
    return unique(spark, d, "papers", "doi", "title", "venue", "authors", "pub_year", "attachment_key")


def _asked_work(p: DataFrame) -> tuple[list[str], int]:
    """Family name and year of the first paper with a sound year stand for those in a question."""
    r = p.where("pub_year between 1900 and 2030 and size(authors) > 0").orderBy("paper_id").select("pub_year", F.split(F.trim(F.col("authors")[0]["display_name"]), " ").alias("n")).first()
    return [citation.fold_text(r["n"][-1])], r["pub_year"]


def r09_find_works(spark, d):
    """Works of an author and year with their passages: the first document of each and its best by the question's words. The document
    of a paper's number stands for its passages."""
    p = papers_full(spark, d)
    works = cut(citation.find_works(p, *_asked_work(p)))
    c = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", F.concat(F.lit("W"), F.lpad((F.col("doc_id") - 2).cast("string"), 9, "0")).alias("paper_id")).where("text is not null")
    hits = F.size(F.array_intersect(retrieval.terms_of(F.col("text")), F.array(*map(F.lit, retrieval.question_terms(QUESTION)))))
    listed = retrieval.ranked(works, [F.desc("score"), F.asc("paper_id")]).select("paper_id", F.col("pos").alias("work_pos"))
    rows = c.join(F.broadcast(listed), "paper_id").select(F.col("paper_id").alias("work"), "work_pos", "id", F.col("id").alias("place"), hits.alias("score"))
    return retrieval.per_work(rows, 20, works.count()).select("work", "id", "pos")


QUESTION = ["glacier", "survey", "tidal", "archive", "catalogue", "of", "nested"]


def r10_mentions(spark, d):
    c = unique(spark, d, "text_chunks", "content").select("id", "content")
    return citation.mentions(c, "id", "content")


def r31_citation_line(spark, d):
    return papers(spark, d).select("paper_id", citation.citation_line(F.try_element_at("authors", F.lit(1))["display_name"], F.col("pub_year"), F.col("title")).alias("line"))


def r32_paper_search(spark, d):
    return citation.paper_search(papers(spark, d), "on a")


def r33_passages(spark, d):
    """Passages of every item for a question: by the vectors of the documents that have one, and by words."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    c = table(spark, d, "documents").select(F.col("item_key").alias("work"), F.col("doc_id").alias("id"), F.col("text").alias("content"))
    return citation.passages(c, v, v.where("id = 0").first()["vector"], QUESTION)


LINKING = 10


def r34_linking_names(spark, d):
    """Names that link two names of one document or more, the LINKING best of each document: neighbours of what it contributes."""
    prov = maintenance.provenance(unique(spark, d, "graph_nodes", "id", "source_id"))
    adj = graph.adjacency(pairs(spark, d))
    near = prov.withColumnRenamed("name", "node").join(adj, "node").groupBy("doc_id", "nbr").agg(F.count("*").alias("n")).where("n >= 2")
    near = near.join(prov.withColumnRenamed("name", "nbr"), ["doc_id", "nbr"], "left_anti")
    return retrieval.capped_per_work(near, "doc_id", [F.desc("n"), F.asc("nbr")], LINKING)


def r34_relations(spark, d):
    """Relations that each document's chunks contribute."""
    p = pairs(spark, d).select("a", "b", F.explode(parts(F.col("source_id"))).alias("s"))
    return p.select(F.regexp_extract("s", "^(doc-[0-9a-f]{32})-chunk-", 1).alias("doc_id"), "a", "b").where("doc_id <> ''").distinct()


def docs(spark, d) -> DataFrame:
    return unique(spark, d, "doc_status", "file_path", "status", "created_at", "updated_at", "content_hash").withColumn("state", strip(F.lower("status")))


def p01_enqueue(spark, d):
    return lifecycle.enqueue(docs(spark, d))


def p02_moves(spark, d):
    """Which stored documents may go on to which state."""
    x = docs(spark, d).select("id", "state", F.explode(F.array(*map(F.lit, lifecycle.STATES))).alias("target"))
    return x.select("id", "target", lifecycle.may_move(F.col("state"), F.col("target")).alias("may"))


def p03_keyset_page(spark, d):
    return lifecycle.page_after(docs(spark, d), ["processed", "failed"], "2024-01-01 00:00:00", "", 100).select("id", "created_at")


def p04_offset_page(spark, d):
    return lifecycle.offset_page(docs(spark, d), 2, 50).select("id", "total")


def p05_conflicts(spark, d):
    """Conflicts of file names (as they are, and without the end of the id that makes them unique) and of contents."""
    name = lifecycle.file_key(F.col("file_path"))
    kinds = {"file": name, "title": F.regexp_replace(name, r"^.*?([^ ]+) [0-9a-f]{6}(?=\.[a-z]+$)", "$1"), "content": F.col("content_hash")}
    whole = None
    for kind, key in kinds.items():
        x = lifecycle.conflicts(docs(spark, d), key).select(F.lit(kind).alias("kind"), "name", "n", F.array_join("ids", "|").alias("ids"))
        whole = x if whole is None else whole.unionByName(x)
    return whole


def p05_settled(spark, d):
    """Conflicts of contents settled for the earliest row."""
    x = docs(spark, d)
    first = x.where("content_hash is not null").groupBy(F.col("content_hash").alias("name")).agg(F.min_by("id", F.struct("created_at", "id")).alias("winner"), F.count("*").alias("n")).where("n > 1")
    return lifecycle.settled(x, first.select("name", "winner"), F.col("content_hash"))


def _hub_document(spark, d) -> str:
    """The document with most chunks."""
    return unique(spark, d, "text_chunks", "full_doc_id").where("full_doc_id is not null").groupBy("full_doc_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "full_doc_id").first()["full_doc_id"]


def p06_rebuilt(spark, d):
    """Entities after the document with most chunks is deleted: those of it alone are gone, shared ones are rebuilt from what is left."""
    doc = _hub_document(spark, d)
    live = unique(spark, d, "text_chunks", "full_doc_id").where(F.col("full_doc_id") != doc).select("id")
    r = merge_queries.records(spark, d).where("type is null or type <> 'unknown'")
    mine = r.where(F.exists(merge_queries.parts(F.col("source_id")), lambda x: x.startswith(doc))).select("name").distinct()
    e = spark.createDataFrame([], "name string, description string, pos long")
    x = merge.rebuilt_entities(r.join(mine, "name", "left_semi"), live, e)
    return x.select("name", F.when(F.col("survived"), "rebuilt").otherwise("gone").alias("state"), "source_id", "description")


def p06_delete_document(spark, d):
    """What stays of each tracked name when its first chunk's document is deleted."""
    t = table(spark, d, "entity_chunks").where("size(chunk_ids) > 0")
    return lifecycle.after_deletion(t, F.substring(F.col("chunk_ids")[0], 1, 36))


def p08_resumable(spark, d):
    return docs(spark, d).where(~F.col("state").isin("failed", "processed")).groupBy("state").agg(F.count("*").alias("n"))


def s08_upsert(spark, d):
    """The vector buffer's last row of each id."""
    v = table(spark, d, "faiss_docs").select("id", F.get_json_object("record", "$.__write_seq__").try_cast("long").alias("seq"))
    return lifecycle.upsert(v.where("seq < 500000 or seq is null"), v.where("seq >= 500000"), "id", "seq")


def s08_missing_keys(spark, d):
    asked = table(spark, d, "entity_chunks").select(F.explode("chunk_ids").alias("id")).where("id is not null")
    return lifecycle.missing_keys(asked, table(spark, d, "text_chunks"), "id")


def s09_rows(spark, d):
    """A bounded scan of all chunks by pages of the key: what the pages hold, one after the other."""
    rows = table(spark, d, "text_chunks").select("id").distinct()
    return stores.paged(rows, "id", 500)


def s14_first_contexts(spark, d):
    """Distinct texts with the first document that holds each."""
    return table(spark, d, "documents").where("text is not null").groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("first"))


def e01_tfidf(spark, d):
    docs_ = table(spark, d, "documents").select(F.col("doc_id").alias("name"), "text")
    return evaluation.tfidf(docs_, _queries(spark, d), 10).select("query", "name", F.round("score", 6).alias("score"), "rank")


def _queries(spark, d) -> DataFrame:
    """Titles of papers are the queries."""
    return papers(spark, d).where("title is not null").select(F.col("paper_id").alias("query"), F.col("title").alias("text"))


def e02_terms(spark, d):
    return table(spark, d, "documents").where("text is not null").select("doc_id", F.size(evaluation.terms(F.col("text"))).alias("n"))


def e03_measures(spark, d):
    """The ranker against documents of the same item as a query's paper."""
    ranked = evaluation.tfidf(table(spark, d, "documents").select(F.col("doc_id").alias("name"), "text"), _queries(spark, d), 10)
    p = unique(spark, d, "papers", "attachment_key", "title").where("title is not null").select(F.col("paper_id").alias("query"), F.col("attachment_key").alias("item_key"))
    expected = p.join(table(spark, d, "documents").select("item_key", F.col("doc_id").alias("name")), "item_key").select("query", "name").distinct()
    return evaluation.measures(ranked, expected, 10).select("queries", F.round("recall", 9).alias("recall"), F.round("mrr", 9).alias("mrr"), "full", "none")


def m01_rebuild_vectors(spark, d):
    n = unique(spark, d, "graph_nodes", "id", "properties").select("id", F.get_json_object("properties", "$.description").alias("description"))
    return maintenance.entity_vectors(n.where("id is not null"))


def m01_relation_vectors(spark, d):
    return maintenance.relation_vectors(full_pairs(spark, d))


def m01_chunk_vectors(spark, d):
    return maintenance.chunk_vectors(unique(spark, d, "text_chunks", "content").select("id", "content"))


def m06_equations(spark, d):
    """The equation tool: display formulas of chunks with their order."""
    return tools.equations(unique(spark, d, "text_chunks", "content").select("id", "content"), "id", "content")


def m06_health(spark, d):
    """The health tool: rows, null keys and repeated keys of the library's tables."""
    return tools.health({t: (table(spark, d, t), k) for t, k in (("doc_status", "id"), ("text_chunks", "id"), ("graph_nodes", "gid"), ("graph_edges", "gid"), ("entity_chunks", "id"), ("papers", "paper_id"), ("faiss_docs", "id"))})


def m02_clean_cache(spark, d):
    """Keys that stay when query answers are cleaned from a cache of the library's ids."""
    k = names(spark, d).select(F.concat(F.when(F.length("id") % 2 == 0, F.lit("mix:query:")).otherwise(F.lit("default:extract:")), F.md5("id")).alias("key"))
    return k.where(~maintenance.is_query_answer(F.col("key")))


def m03_copy_cache(spark, d):
    k = names(spark, d).select(F.concat(F.when(F.length("id") % 2 == 0, F.lit("mix:query:")).otherwise(F.lit("default:extract:")), F.md5("id")).alias("key"))
    return k.where(F.col("key").startswith("default:extract:"))


def m04_clear_workspace(spark, d):
    """Rows of each table and workspace when the largest workspace is cleared."""
    keys = {"doc_status": "id", "text_chunks": "id", "graph_nodes": "gid", "graph_edges": "gid"}
    tables = {t: table(spark, d, t).select("workspace", F.col(k).cast("string").alias("key")).distinct() for t, k in keys.items()}
    largest = tables["text_chunks"].where("workspace is not null").groupBy("workspace").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "workspace").first()["workspace"]
    whole = None
    for t, df in maintenance.without_workspace(tables, largest).items():
        x = df.groupBy("workspace").agg(F.count("*").alias("n")).select(F.lit(t).alias("tbl"), "workspace", "n")
        whole = x if whole is None else whole.unionByName(x)
    return whole


def j10_anchor_gaps(spark, d):
    """Provenance of nodes against the tracking rows as anchors."""
    t = table(spark, d, "entity_chunks").select(F.col("id").alias("name"), F.explode("chunk_ids").alias("s")).where(F.col("s").rlike(references.CHUNK_FORM)).select(F.substring("s", 1, 36).alias("doc_id"), "name")
    return maintenance.anchor_gaps(maintenance.provenance(unique(spark, d, "graph_nodes", "id", "source_id")), t)


def j11_tracking_repair(spark, d):
    t = table(spark, d, "entity_chunks")
    bad = maintenance.wrong_counts(t).select("id", F.lit("count").alias("what"))
    return bad.unionByName(maintenance.orphan_tracking(t, names(spark, d)).select("id", F.lit("orphan").alias("what")))


def j11_repaired(spark, d):
    """The tracking table after the repair."""
    n = unique(spark, d, "graph_nodes", "id", "source_id").select("id", "source_id").where("id is not null")
    return maintenance.repaired_tracking(table(spark, d, "entity_chunks"), n).select("id", F.array_join("chunk_ids", "|").alias("chunk_ids"), "chunk_count")


def j12_live_paths(spark, d):
    """Sources and files of nodes without dangling chunks."""
    n = unique(spark, d, "graph_nodes", "source_id", "file_path").select("gid", "source_id", "file_path")
    files = unique(spark, d, "doc_status", "file_path").select(F.col("id").alias("doc"), F.when(lifecycle.file_key(F.col("file_path")).isNotNull(), strip(F.col("file_path"))).alias("file"))
    return maintenance.live_paths(n, table(spark, d, "text_chunks").select("id"), files, references.CHUNK_FORM, "gid")


def j13_as_of(spark, d):
    """Each purchase with the value of its user's last view before it."""
    e = table(spark, d, "events")
    views = e.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("view_value"), "event_id")
    return timejoins.as_of(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), views, "user_id", "ts", "view_value", "event_id", "day").select("event_id", "view_value")


def j13_interval(spark, d):
    """Errors of a user within an hour after a click."""
    e = table(spark, d, "events")
    return timejoins.interval(e.where("event_type = 'click'"), e.where("event_type = 'error'"), "user_id", "ts", 3600, "event_id")


def j13_range(spark, d):
    """Price bands of parts."""
    bands = spark.createDataFrame([("low", 0.0, 1000.0), ("mid", 950.0, 1500.0), ("high", 1500.0, 1e6)], "band string, lo double, hi double")
    return timejoins.in_range(table(spark, d, "part"), bands, "p_retailprice", "lo", "hi", 100.0, "p_partkey", "band")


def g18_histogram(spark, d):
    """Sizes of chunks by workspace, in classes."""
    c = unique(spark, d, "text_chunks", "workspace", "content").select("workspace", F.length("content").alias("n"))
    return timejoins.histogram(c, "n", [100.0, 400.0, 800.0, 1600.0, 3200.0], "workspace")


def g19_rollup(spark, d):
    return timejoins.rolled_up(table(spark, d, "documents").select("source", "lang"), "source", "lang")


def d14_sliding(spark, d):
    """Events in windows of an hour that begin every quarter."""
    return timejoins.sliding(table(spark, d, "events"), "ts", "1 hour", "15 minutes", "event_type", n=F.count("*"))


def d14_sessions(spark, d):
    """Sessions of users: they end after six hours without an event."""
    return timejoins.sessions(table(spark, d, "events"), "ts", "6 hours", "user_id", n=F.count("*"))


def j12_live_references(spark, d):
    x = maintenance.live_references(table(spark, d, "entity_chunks"), table(spark, d, "text_chunks"), references.CHUNK_FORM)
    return x.select("id", F.array_join("kept", "|").alias("kept"), "dropped")


def j06_unseen(spark, d):
    """Names that no chunk tracking row has seen."""
    return names(spark, d).join(table(spark, d, "entity_chunks").select("id"), "id", "left_anti")


def s16_noop(spark, d):
    """A store that keeps nothing: what a search for each name finds in it after all names were written."""
    store = stores.NoStore(spark)
    store.write(names(spark, d))
    found = store.read().groupBy("id").agg(F.count("*").alias("hits"))
    return names(spark, d).join(found, "id", "left").select("id", F.coalesce("hits", F.lit(0)).cast("long").alias("hits"))


_DS = "ds AS (SELECT DISTINCT id, file_path, status, created_at, updated_at, content_hash, regexp_replace(lower(status), '^\\s+|\\s+$', '', 'g') AS state FROM doc_status)"
_FK = "nullif(nullif(nullif(lower(regexp_replace(regexp_extract(file_path, '([^/\\\\]*)$', 1), '^\\s+|\\s+$', '', 'g')), ''), 'unknown_source'), 'no-file-path')"
_PROV = f"pv AS (SELECT DISTINCT regexp_extract(s, '^(doc-[0-9a-f]{{32}})-chunk-', 1) AS doc_id, id AS name FROM (SELECT id, unnest({LIST_SQL.format('source_id')}) AS s FROM graph_nodes) WHERE regexp_matches(s, '^doc-[0-9a-f]{{32}}-chunk-'))"
_TERM = "list_concat(list_filter(regexp_extract_all(lower({0}), '[a-z0-9]{{2,}}'), lambda w: w NOT IN ('" + "', '".join(evaluation.STOP) + "')), list_filter(list_transform(generate_series(1, length({0}) - 1), lambda i: substr({0}, i, 2)), lambda g: regexp_full_match(g, '[\\x{{4E00}}-\\x{{9FFF}}]{{2}}')))"
_TFIDF = (
    f"tf AS (SELECT doc_id AS name, t, count(*) AS tf FROM (SELECT doc_id, unnest({_TERM.format('text')}) AS t FROM documents) GROUP BY 1, 2), df AS (SELECT t, count(*) AS df FROM tf GROUP BY 1),"
    f" qt AS (SELECT DISTINCT paper_id AS query, t FROM (SELECT paper_id, unnest({_TERM.format('title')}) AS t FROM papers WHERE title IS NOT NULL)),"
    " sc AS (SELECT query, name, sum((1 + ln(tf)) * (ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1)) + 1)) AS score FROM qt JOIN df USING (t) JOIN tf USING (t) GROUP BY 1, 2),"
    " rk AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, name) AS rank FROM sc WHERE score > 0)"
)
_KEY = "CASE WHEN length(id) % 2 = 0 THEN 'mix:query:' ELSE 'default:extract:' END || md5(id)"

_FOLD = "translate(lower({0}), 'áàâäãåéèêëíìîïóòôöõøúùûüñçýšžč', 'aaaaaaeeeeiiiioooooouuuuncyszc')"
_PLAIN = "regexp_replace(" + _FOLD + ", '[^a-z0-9]+', ' ', 'g')"
_SPACED = "(' ' || " + _PLAIN + " || ' ')"
_DOI = "CASE WHEN regexp_matches(regexp_replace(regexp_replace(lower(trim({0})), '^(?:https?://)?(?:dx\\.)?doi\\.org/|^doi:\\s*', '', 'g'), '[\\s.,;)]+$', '', 'g'), '^10\\.[0-9]{{4,9}}/\\S+$') THEN regexp_replace(regexp_replace(lower(trim({0})), '^(?:https?://)?(?:dx\\.)?doi\\.org/|^doi:\\s*', '', 'g'), '[\\s.,;)]+$', '', 'g') END"

QUERIES = {f.__name__: f for f in (z01_coupling, z01_structure, z02_related, z03_topic_papers, z04_topic_search, z05_cheapest, z05_paths, z06_map, z07_thinned, z08_link_weights, z09_dois, z09_resolve, r09_find_works, r10_mentions, r31_citation_line, r32_paper_search, r33_passages, r34_linking_names, r34_relations, p01_enqueue, p02_moves, p03_keyset_page, p04_offset_page, p05_conflicts, p05_settled, p06_delete_document, p06_rebuilt, p08_resumable, s08_upsert, s08_missing_keys, s09_rows, s14_first_contexts, s16_noop, e01_tfidf, e02_terms, e03_measures, m01_rebuild_vectors, m01_relation_vectors, m01_chunk_vectors, m06_equations, m06_health, m02_clean_cache, m03_copy_cache, m04_clear_workspace, j06_unseen, j10_anchor_gaps, j11_tracking_repair, j11_repaired, j12_live_references, j12_live_paths, j13_as_of, j13_interval, j13_range, g18_histogram, g19_rollup, d14_sliding, d14_sessions)}
# names of lifecycle operators begin like those of the numbered problems, so they are registered under another prefix
for _name in [k for k in QUERIES if k.startswith("p0")]:
    QUERIES[f"d{_name[1:]}"] = QUERIES.pop(_name)
SQL = {
    "z01_coupling": f"WITH {CITE_SQL} SELECT x, y, shared FROM cp",
    "z02_related": (
        f"WITH {CITE_SQL}, au AS (SELECT DISTINCT l_partkey AS p, l_suppkey AS a FROM lineitem), sa AS (SELECT p, count(*) AS w FROM au WHERE a IN (SELECT a FROM au WHERE p = {PAPER}) GROUP BY 1), cin AS (SELECT dst, count(*) AS n FROM ci GROUP BY 1),"
        f" u AS (SELECT dst AS other, 1 AS o, 0 AS i, 0 AS c, 0 AS w FROM ci WHERE src = {PAPER} UNION ALL SELECT src, 0, 1, 0, 0 FROM ci WHERE dst = {PAPER} UNION ALL SELECT y, 0, 0, shared, 0 FROM cp WHERE x = {PAPER} UNION ALL SELECT x, 0, 0, shared, 0 FROM cp WHERE y = {PAPER} UNION ALL SELECT p, 0, 0, 0, w FROM sa),"
        f" s AS (SELECT other, greatest(max(o), max(i)) * 1.0 + max(o) * max(i) * 0.25 + sum(c) * 2.0 + least(sum(w), 4) * 0.25 AS score FROM u WHERE other <> {PAPER} GROUP BY 1)"
        " SELECT other, CAST(score AS DOUBLE) AS score, coalesce(n, 0) AS cited_in, p_size AS year FROM s LEFT JOIN cin ON cin.dst = other LEFT JOIN part ON p_partkey = other ORDER BY score DESC, cited_in DESC, year DESC NULLS LAST, other LIMIT 50"
    ),
    "z03_topic_papers": f"SELECT p_partkey AS paper, p_partkey = 1 AS primary FROM part WHERE p_type = '{TOPIC}'",
    "z04_topic_search": "WITH t AS (SELECT DISTINCT topic, regexp_split_to_array(lower(topic), '[\\s/]+') AS w FROM (SELECT p_type || ' / ' || p_brand AS topic FROM part UNION ALL SELECT p_type FROM part)), q AS (SELECT unnest(['brand#1', 'stan', 'brand#12 econ', 'brand#1 tin', 'bra']) AS query), qw AS (SELECT query, unnest(string_split(query, ' ')) AS x FROM q) SELECT query, topic FROM (SELECT query, topic, bool_and(list_contains(w, x) OR length(x) >= 4 AND len(list_filter(w, lambda y: starts_with(y, x))) > 0) AS ok FROM qw, t GROUP BY 1, 2) WHERE ok",
    "z05_cheapest": f"WITH {CITE_SQL}, tl AS (SELECT node AS nbr, 1 + 0.5 * log2(1 + deg) AS toll FROM dg), h1 AS (SELECT nbr AS node, toll AS cost FROM ad JOIN tl USING (nbr) WHERE node = {PAPER}), b1 AS (SELECT node, min(cost) AS cost FROM h1 GROUP BY 1), h2 AS (SELECT ad.nbr AS node, b1.cost + tl.toll AS cost FROM b1 JOIN ad ON ad.node = b1.node JOIN tl ON tl.nbr = ad.nbr) SELECT node, round(x.c, 6) AS cost, x.h AS hops FROM (SELECT node, min(struct_pack(c := cost, h := hops)) AS x FROM (SELECT {PAPER} AS node, 0.0::DOUBLE AS cost, 0 AS hops UNION ALL SELECT node, cost, 1 FROM b1 UNION ALL SELECT node, cost, 2 FROM h2) GROUP BY node)",
    "z06_map": f"WITH {CITE_SQL}, f1 AS (SELECT nbr AS node, sum(weight) AS s FROM ad WHERE node = {PAPER} GROUP BY 1 ORDER BY s DESC, 1 LIMIT 20), f2 AS (SELECT ad.nbr AS node, sum(f1.s * weight / log2(2 + deg)) AS s FROM f1 JOIN ad USING (node) JOIN dg USING (node) WHERE ad.nbr <> {PAPER} AND ad.nbr NOT IN (SELECT node FROM f1) GROUP BY 1 ORDER BY s DESC, 1 LIMIT 20) SELECT node, 1 AS hop, round(s, 6) AS strength FROM f1 UNION ALL SELECT node, 2, round(s, 6) FROM f2",
    "z07_thinned": f"WITH {CITE_SQL}, rn AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, nbr) AS r FROM ad), k AS (SELECT least(node, nbr) AS x, greatest(node, nbr) AS y, max(weight) AS weight, bool_or(r = 1) AS best, bool_or(node = {PAPER}) AS seed FROM rn WHERE node = {PAPER} OR r <= 6 GROUP BY 1, 2), t AS (SELECT x, y, weight FROM k ORDER BY seed DESC, weight DESC, x, y LIMIT 4000) SELECT x, y, weight FROM k WHERE best UNION SELECT x, y, weight FROM t",
    "z01_structure": f"WITH {CITE_SQL} SELECT node, CAST(sum(c) AS BIGINT) AS cites, CAST(sum(i) AS BIGINT) AS cited, CAST(sum(k) AS BIGINT) AS coupled FROM (SELECT src AS node, 1 AS c, 0 AS i, 0 AS k FROM ci UNION ALL SELECT dst, 0, 1, 0 FROM ci UNION ALL SELECT x, 0, 0, 1 FROM cp UNION ALL SELECT y, 0, 0, 1 FROM cp) GROUP BY 1",
    "z09_resolve": (
        f"WITH p AS (SELECT DISTINCT paper_id, doi, title FROM papers), a AS (SELECT DISTINCT asked FROM (SELECT unnest([doi, upper(title), paper_id, 'https://doi.org/' || doi]) AS asked FROM p) WHERE asked IS NOT NULL),"
        f" k AS (SELECT '1 id' AS rule, paper_id AS key, paper_id FROM p UNION ALL SELECT '2 doi', {_DOI.format('doi')}, paper_id FROM p UNION ALL SELECT '3 title', {_PLAIN.format('title')}, paper_id FROM p), k1 AS (SELECT rule, key, min(paper_id) AS paper_id FROM k WHERE key IS NOT NULL AND key <> '' GROUP BY 1, 2),"
        f" x AS (SELECT asked, '1 id' AS rule, asked AS key FROM a UNION ALL SELECT asked, '2 doi', {_DOI.format('asked')} FROM a UNION ALL SELECT asked, '3 title', {_PLAIN.format('asked')} FROM a)"
        " SELECT asked, m.p AS paper_id, substr(m.r, 3) AS rule FROM (SELECT asked, min(struct_pack(r := x.rule, p := k1.paper_id)) AS m FROM x JOIN k1 ON k1.rule = x.rule AND k1.key = x.key GROUP BY 1)"
    ),
    "r09_find_works": (
        f"WITH p AS (SELECT DISTINCT * FROM papers), q AS (SELECT {_FOLD.format("string_split(trim(authors[1].display_name), ' ')[-1]")} AS s, pub_year AS y FROM p WHERE pub_year BETWEEN 1900 AND 2030 AND len(authors) > 0 ORDER BY paper_id LIMIT 1),"
        f" au AS (SELECT paper_id, pub_year, attachment_key, i, list_contains(regexp_split_to_array({_FOLD.format('a.display_name')}, '[^a-z]+'), s) AS ok FROM (SELECT paper_id, pub_year, attachment_key, unnest(authors) AS a, unnest(generate_series(0, len(authors) - 1)) AS i FROM p), q),"
        " sc AS (SELECT paper_id, any_value(attachment_key) AS k, coalesce(any_value(pub_year) = (SELECT y FROM q), false) AS exact, any_value(pub_year) AS yr, 1 + CAST(min(i) = 0 AS INTEGER) + CAST(coalesce(any_value(pub_year) = (SELECT y FROM q), false) AS INTEGER) AS score FROM au WHERE ok GROUP BY 1),"
        " ok AS (SELECT * FROM sc WHERE exact OR abs(yr - (SELECT y FROM q)) = 1 AND score > (SELECT coalesce(max(score), 0) FROM sc WHERE exact)), wk AS (SELECT *, row_number() OVER (ORDER BY score DESC, paper_id) - 1 AS work_pos, count(*) OVER () AS m FROM ok WHERE (SELECT count(*) FROM ok WHERE score = (SELECT max(score) FROM ok)) <= 9),"
        f" c AS (SELECT wk.paper_id AS work, work_pos, m, doc_id AS id, len(list_filter(list_distinct(regexp_split_to_array(lower(text), '[^a-z]+')), lambda t: list_contains({retrieval.question_terms(QUESTION)!r}, t))) AS h FROM documents JOIN wk ON wk.paper_id = 'W' || lpad(CAST(doc_id - 2 AS VARCHAR), 9, '0') WHERE text IS NOT NULL),"
        " d AS (SELECT *, row_number() OVER (PARTITION BY work ORDER BY id) = 1 AS lead FROM c), e AS (SELECT *, row_number() OVER (PARTITION BY work ORDER BY lead DESC, h DESC, id) AS r FROM d)"
        " SELECT work, id, row_number() OVER (ORDER BY work_pos, r) - 1 AS pos FROM e WHERE r <= ceil(20.0 / m)"
    ),
    "r32_paper_search": (
        f"SELECT *, row_number() OVER (ORDER BY named DESC, whole DESC, title_hits DESC, year DESC NULLS LAST, paper_id) - 1 AS pos FROM (SELECT paper_id, coalesce(trim({_SPACED.format('title')}) = 'on a', false) AS named, CAST(contains({_SPACED.format('t')}, ' on ') AS INTEGER) + CAST(contains({_SPACED.format('t')}, ' a ') AS INTEGER) AS whole,"
        f" coalesce(CAST(contains({_FOLD.format('title')}, 'on') AS INTEGER) + CAST(contains({_FOLD.format('title')}, 'a') AS INTEGER), 0) AS title_hits, pub_year AS year FROM (SELECT *, concat_ws(' ', {_FOLD.format('title')}, {_FOLD.format('venue')}, {_FOLD.format("array_to_string(list_transform(authors, lambda x: x.display_name), ' ')")}) AS t FROM (SELECT DISTINCT * FROM papers)) WHERE contains(t, 'on') AND contains(t, 'a')) ORDER BY pos LIMIT 1000"
    ),
    "r34_relations": f"{ALL_SQL} SELECT DISTINCT regexp_extract(s, '^(doc-[0-9a-f]{{32}})-chunk-', 1) AS doc_id, a, b FROM (SELECT a, b, unnest({LIST_SQL.format('source_id')}) AS s FROM p) WHERE regexp_matches(s, '^doc-[0-9a-f]{{32}}-chunk-')",
    "z08_link_weights": f"WITH {CITE_SQL} SELECT x, y, weight FROM lk",
    "z09_dois": "SELECT DISTINCT paper_id, CASE WHEN regexp_matches(x, '^10\\.[0-9]{4,9}/\\S+$') THEN x END AS doi FROM (SELECT paper_id, regexp_replace(regexp_replace(lower(trim(doi)), '^(?:https?://)?(?:dx\\.)?doi\\.org/|^doi:\\s*', '', 'g'), '[\\s.,;)]+$', '', 'g') AS x FROM papers)",
    "r10_mentions": f"SELECT mention, count(*) AS n FROM (SELECT unnest(regexp_extract_all(content, '{citation.MENTION[1:-1]}')) AS mention FROM (SELECT DISTINCT id, content FROM text_chunks)) GROUP BY 1",
    "r31_citation_line": "SELECT paper_id, substr(concat_ws(' ', authors[1].display_name, '(' || pub_year || ')', title), 1, 80) AS line FROM (SELECT DISTINCT * FROM papers)",
    "r33_passages": (
        f"WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS qv FROM embeddings WHERE vec_id = 0), c AS (SELECT item_key AS work, doc_id AS id, length(text) AS chars, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS digest, len(list_filter(list_distinct(regexp_split_to_array(lower(text), '[^a-z]+')), lambda t: list_contains({retrieval.question_terms(QUESTION)!r}, t))) AS hits,"
        " list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), qv) AS cosine FROM documents JOIN q ON true LEFT JOIN embeddings e ON e.vec_id = doc_id WHERE item_key IS NOT NULL AND regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''),"
        " o AS (SELECT work, digest, min(id) AS id, max(chars) AS chars, max(hits) AS hits, max(cosine) AS cosine, count(*) OVER (PARTITION BY work) <= 60 AS small FROM c GROUP BY work, digest),"
        " ev AS (SELECT * FROM o WHERE small UNION SELECT * FROM (SELECT * FROM o WHERE NOT small AND cosine IS NOT NULL QUALIFY row_number() OVER (PARTITION BY work ORDER BY cosine DESC, id) <= 40) UNION SELECT * FROM (SELECT * FROM o WHERE NOT small AND hits > 0 QUALIFY row_number() OVER (PARTITION BY work ORDER BY hits DESC, id) <= 40))"
        " SELECT work, id, CAST(chars AS INTEGER) AS chars, row_number() OVER (PARTITION BY work ORDER BY round(cosine, 9) DESC NULLS LAST, hits DESC, id) - 1 AS pos FROM ev QUALIFY pos < 10"
    ),
    "r34_linking_names": f"{ALL_SQL}, {_PROV} SELECT doc_id, nbr, n FROM (SELECT doc_id, nbr, count(*) AS n FROM pv JOIN adj ON adj.node = pv.name GROUP BY 1, 2) x WHERE n >= 2 AND NOT EXISTS (SELECT 1 FROM pv WHERE pv.doc_id = x.doc_id AND pv.name = x.nbr) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, nbr) <= {LINKING}",
    "d01_enqueue": f"WITH {_DS}, k AS (SELECT *, {_FK} AS fk FROM ds), n AS (SELECT fk, arg_min(id, struct_pack(c := created_at, i := id)) AS o FROM k WHERE fk IS NOT NULL GROUP BY 1), h AS (SELECT content_hash, arg_min(id, struct_pack(c := created_at, i := id)) AS o FROM k WHERE content_hash IS NOT NULL GROUP BY 1) SELECT k.id, CASE WHEN (n.o IS NULL OR n.o = k.id) AND (h.o IS NULL OR h.o = k.id) THEN 'pending' ELSE 'duplicate' END AS state, CASE WHEN n.o <> k.id THEN n.o WHEN h.o <> k.id THEN h.o END AS original, CASE WHEN n.o <> k.id THEN 'name' WHEN h.o <> k.id THEN 'hash' END AS rule FROM k LEFT JOIN n USING (fk) LEFT JOIN h ON h.content_hash = k.content_hash",
    "d02_moves": f"WITH {_DS}, mv AS (SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, bs in lifecycle.MOVES.items() for b in bs) + ") t(a, b)) SELECT id, target, (state, target) IN (SELECT (a, b) FROM mv) AS may FROM ds, (SELECT unnest([" + ", ".join(f"'{x}'" for x in lifecycle.STATES) + "]) AS target)",
    "d03_keyset_page": f"WITH {_DS} SELECT id, created_at FROM ds WHERE state IN ('processed', 'failed') AND (created_at > TIMESTAMP '2024-01-01' OR (created_at = TIMESTAMP '2024-01-01' AND id > '')) ORDER BY created_at, id LIMIT 100",
    "d04_offset_page": f"WITH {_DS} SELECT id, (SELECT count(*) FROM ds) AS total FROM ds ORDER BY updated_at DESC NULLS LAST, id LIMIT 50 OFFSET 50",
    "d05_conflicts": f"WITH {_DS}, f AS (SELECT id, {_FK} AS fk, content_hash FROM ds), k AS (SELECT 'file' AS kind, id, fk AS name FROM f UNION ALL SELECT 'title', id, regexp_replace(fk, '^.*?([^ ]+) [0-9a-f]{{6}}(\\.[a-z]+)$', '\\1\\2') FROM f UNION ALL SELECT 'content', id, content_hash FROM f) SELECT kind, name, count(*) AS n, array_to_string(list(id ORDER BY id)[1:5], '|') AS ids FROM k WHERE name IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1",
    "d06_delete_document": "SELECT id, len(list_filter(chunk_ids, lambda x: left(x, 36) <> left(chunk_ids[1], 36))) AS kept, len(list_filter(chunk_ids, lambda x: left(x, 36) = left(chunk_ids[1], 36))) AS gone FROM entity_chunks WHERE len(chunk_ids) > 0",
    "d08_resumable": f"WITH {_DS} SELECT state, count(*) AS n FROM ds WHERE state NOT IN ('failed', 'processed') GROUP BY 1",
    "d05_settled": f"WITH {_DS}, w AS (SELECT content_hash AS h, arg_min(id, struct_pack(c := created_at, i := id)) AS o FROM ds WHERE content_hash IS NOT NULL GROUP BY 1 HAVING count(*) > 1) SELECT id, CASE WHEN o <> id THEN 'duplicate' ELSE state END AS state, CASE WHEN o <> id THEN o END AS original FROM ds LEFT JOIN w ON h = content_hash",
    "d06_rebuilt": (
        f"WITH {merge_queries.RECORDS_SQL}, hd AS (SELECT full_doc_id AS doc FROM (SELECT DISTINCT id, full_doc_id FROM text_chunks) WHERE full_doc_id IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1), r0 AS (SELECT * FROM rec WHERE name IS NOT NULL AND (type IS NULL OR type <> 'unknown')),"
        f" r AS (SELECT * FROM r0 WHERE name IN (SELECT name FROM (SELECT name, unnest({SPLIT_SQL.format('source_id')}) AS s FROM r0) WHERE starts_with(s, (SELECT doc FROM hd)))),"
        f" al AS (SELECT * FROM (SELECT r.*, unnest({LIST_SQL.format('source_id')}) AS s, unnest(generate_series(0, len({LIST_SQL.format('source_id')}) - 1)) AS i FROM r) WHERE s IN (SELECT id FROM text_chunks WHERE full_doc_id <> (SELECT doc FROM hd))),"
        " ids AS (SELECT name, array_to_string(list(s ORDER BY o)[1:200], '<SEP>') AS ids FROM (SELECT name, s, min(pos * 1000 + i) AS o FROM al GROUP BY 1, 2) GROUP BY 1),"
        " tx AS (SELECT name, string_agg(description, '<SEP>' ORDER BY p) AS d FROM (SELECT name, description, min(pos) AS p FROM al WHERE regexp_replace(description, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY 1, 2) GROUP BY 1)"
        " SELECT n.name, CASE WHEN ids IS NULL THEN 'gone' ELSE 'rebuilt' END AS state, coalesce(ids, '') AS source_id, coalesce(d, 'Entity ' || n.name) AS description FROM (SELECT DISTINCT name FROM r) n LEFT JOIN ids USING (name) LEFT JOIN tx USING (name)"
    ),
    "m01_relation_vectors": f"{ALL_SQL} SELECT 'rel-' || md5(a || b) AS vid, coalesce(e.properties ->> '$.keywords', '') || chr(9) || a || chr(10) || b || chr(10) || coalesce(e.properties ->> '$.description', '') AS content FROM p JOIN (SELECT DISTINCT gid, properties FROM graph_edges) e USING (gid)",
    "m01_chunk_vectors": "SELECT 'chunk-' || md5(id) AS vid, content FROM (SELECT DISTINCT id, content FROM text_chunks WHERE content IS NOT NULL)",
    "m06_equations": "SELECT id, i AS item, regexp_replace(f, '^\\s+|\\s+$', '', 'g') AS formula FROM (SELECT id, unnest(regexp_extract_all(content, '(?s)\\\\begin\\{equation\\}(.*?)\\\\end\\{equation\\}', 1)) AS f, unnest(range(1, 1 + len(regexp_extract_all(content, '(?s)\\\\begin\\{equation\\}(.*?)\\\\end\\{equation\\}', 1)))) AS i FROM (SELECT DISTINCT id, content FROM text_chunks))",
    "m06_health": " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS rows, count(DISTINCT {k}) AS keys, CAST(sum(CASE WHEN {k} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_keys FROM {t}" for t, k in (("doc_status", "id"), ("text_chunks", "id"), ("graph_nodes", "gid"), ("graph_edges", "gid"), ("entity_chunks", "id"), ("papers", "paper_id"), ("faiss_docs", "id"))),
    "j11_repaired": f"WITH n AS (SELECT id, list_sort(list_filter(list_distinct(flatten(list({LIST_SQL.format('source_id')}))), lambda x: starts_with(x, 'doc-'))) AS own FROM (SELECT DISTINCT gid, id, source_id FROM graph_nodes WHERE id IS NOT NULL) GROUP BY id), x AS (SELECT n.id, CASE WHEN e.id IS NULL THEN own ELSE coalesce(chunk_ids, []) END AS c FROM n LEFT JOIN entity_chunks e ON e.id = n.id) SELECT id, array_to_string(c, '|') AS chunk_ids, CAST(len(c) AS INTEGER) AS chunk_count FROM x",
    "j12_live_paths": (
        f"WITH n AS (SELECT DISTINCT gid, source_id, file_path FROM graph_nodes), ds AS (SELECT DISTINCT id AS doc, CASE WHEN {_FK} IS NOT NULL THEN regexp_replace(file_path, '^\\s+|\\s+$', '', 'g') END AS file FROM doc_status),"
        f" x AS (SELECT gid, s, min(i) AS i FROM (SELECT gid, unnest({LIST_SQL.format('source_id')}) AS s, unnest(generate_series(1, len({LIST_SQL.format('source_id')}))) AS i FROM n) GROUP BY 1, 2), y AS (SELECT x.*, regexp_full_match(s, 'doc-[0-9a-f]{{32}}-chunk-[0-9]+') AS fm, s IN (SELECT id FROM text_chunks) AS there FROM x),"
        " z AS (SELECT y.*, there OR NOT fm AS keep, CASE WHEN fm THEN left(s, 36) END AS doc, file FROM y LEFT JOIN ds ON fm AND ds.doc = left(s, 36)), fo AS (SELECT gid, file, min(i) AS i FROM z WHERE keep AND file IS NOT NULL GROUP BY 1, 2), fj AS (SELECT gid, string_agg(file, '<SEP>' ORDER BY i) AS files FROM fo GROUP BY 1),"
        " a AS (SELECT gid, coalesce(string_agg(s, '<SEP>' ORDER BY i) FILTER (keep), '') AS ids, CAST(sum(CASE WHEN keep THEN 0 ELSE 1 END) AS BIGINT) AS dropped, bool_or(keep AND doc IS NOT NULL AND file IS NULL) AS unknown FROM z GROUP BY 1)"
        " SELECT n.gid, CASE WHEN dropped > 0 THEN ids ELSE n.source_id END AS source_id, CASE WHEN dropped > 0 AND NOT unknown THEN coalesce(files, '') ELSE n.file_path END AS file_path, coalesce(dropped, 0) AS dropped FROM n LEFT JOIN a USING (gid) LEFT JOIN fj USING (gid)"
    ),
    "j13_as_of": "SELECT p.event_id, v.value AS view_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts",
    "j13_interval": "SELECT a.event_id, b.event_id AS other FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'error' AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR",
    "j13_range": "SELECT p_partkey, band FROM part JOIN (VALUES ('low', 0.0, 1000.0), ('mid', 950.0, 1500.0), ('high', 1500.0, 1e6)) t(band, lo, hi) ON p_retailprice >= lo AND p_retailprice < hi",
    "g18_histogram": "SELECT workspace, (CASE WHEN n >= 100 THEN 1 ELSE 0 END) + (CASE WHEN n >= 400 THEN 1 ELSE 0 END) + (CASE WHEN n >= 800 THEN 1 ELSE 0 END) + (CASE WHEN n >= 1600 THEN 1 ELSE 0 END) + (CASE WHEN n >= 3200 THEN 1 ELSE 0 END) AS bucket, count(*) AS n FROM (SELECT DISTINCT id, workspace, length(content) AS n FROM text_chunks WHERE content IS NOT NULL) GROUP BY 1, 2",
    "g19_rollup": "SELECT source, lang, grouping(source) + grouping(lang) AS level, count(*) AS n FROM documents GROUP BY ROLLUP (source, lang)",
    "d14_sliding": "SELECT s AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 15 MINUTE, ts), time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE, time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 30 MINUTE, time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 45 MINUTE]) AS s FROM events) GROUP BY 1, 2",
    "d14_sessions": "SELECT min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS \"end\", user_id, count(*) AS n FROM (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS nw FROM events)) GROUP BY user_id, g",
    "s08_upsert": "SELECT id, max(CAST(record ->> '$.__write_seq__' AS BIGINT)) AS seq FROM faiss_docs GROUP BY 1",
    "s08_missing_keys": "SELECT DISTINCT id FROM (SELECT unnest(chunk_ids) AS id FROM entity_chunks) WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM text_chunks)",
    "s09_rows": "SELECT page, count(*) AS rows, min(id) AS first, max(id) AS last FROM (SELECT id, (row_number() OVER (ORDER BY id) - 1) // 500 AS page FROM (SELECT DISTINCT id FROM text_chunks)) GROUP BY 1",
    "s14_first_contexts": "SELECT md5(text) AS digest, min(doc_id) AS first FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "s16_noop": "SELECT DISTINCT id, CAST(0 AS BIGINT) AS hits FROM graph_nodes WHERE id IS NOT NULL",
    "e01_tfidf": f"WITH {_TFIDF} SELECT query, name, round(score, 6) AS score, rank FROM rk WHERE rank <= 10",
    "e02_terms": f"SELECT doc_id, len({_TERM.format('text')}) AS n FROM documents WHERE text IS NOT NULL",
    "e03_measures": f"WITH {_TFIDF}, ex AS (SELECT DISTINCT paper_id AS query, doc_id AS name FROM papers JOIN documents ON attachment_key = item_key WHERE title IS NOT NULL), e AS (SELECT ex.query, ex.name, rank FROM ex LEFT JOIN (SELECT * FROM rk WHERE rank <= 10) r ON r.query = ex.query AND r.name = ex.name), p AS (SELECT query, count(rank) / count(*) AS recall, coalesce(max(1.0 / rank), 0) AS rr FROM e GROUP BY 1) SELECT count(*) AS queries, round(avg(recall), 9) AS recall, round(avg(rr), 9) AS mrr, CAST(sum(CASE WHEN recall = 1 THEN 1 ELSE 0 END) AS BIGINT) AS full, CAST(sum(CASE WHEN recall = 0 THEN 1 ELSE 0 END) AS BIGINT) AS none FROM p",
    "m01_rebuild_vectors": "SELECT 'ent-' || md5(id) AS vid, id || chr(10) || coalesce(properties ->> '$.description', '') AS content FROM (SELECT DISTINCT gid, id, properties FROM graph_nodes WHERE id IS NOT NULL)",
    "m02_clean_cache": f"SELECT {_KEY} AS key FROM (SELECT DISTINCT id FROM graph_nodes WHERE id IS NOT NULL) WHERE length(id) % 2 <> 0",
    "m03_copy_cache": f"SELECT {_KEY} AS key FROM (SELECT DISTINCT id FROM graph_nodes WHERE id IS NOT NULL) WHERE length(id) % 2 <> 0",
    "m04_clear_workspace": "WITH big AS (SELECT workspace FROM (SELECT DISTINCT workspace, id FROM text_chunks) WHERE workspace IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS tbl, workspace, count(DISTINCT {k}) AS n FROM {t} GROUP BY 2" for t, k in (("doc_status", "id"), ("text_chunks", "id"), ("graph_nodes", "gid"), ("graph_edges", "gid"))) + ") WHERE workspace IS NULL OR workspace <> (SELECT workspace FROM big)",
    "j06_unseen": "SELECT DISTINCT id FROM graph_nodes WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM entity_chunks WHERE id IS NOT NULL)",
    "j10_anchor_gaps": f"WITH {_PROV}, an AS (SELECT DISTINCT left(s, 36) AS doc_id, id AS name FROM (SELECT id, unnest(chunk_ids) AS s FROM entity_chunks) WHERE regexp_full_match(s, 'doc-[0-9a-f]{{32}}-chunk-[0-9]+')) SELECT doc_id, name, 'not anchored' AS gap FROM (SELECT * FROM pv EXCEPT SELECT * FROM an) UNION ALL SELECT doc_id, name, 'no provenance' FROM (SELECT * FROM an EXCEPT SELECT * FROM pv)",
    "j11_tracking_repair": "SELECT id, 'count' AS what FROM entity_chunks WHERE chunk_count IS NULL OR chunk_count <> coalesce(len(chunk_ids), 0) UNION ALL SELECT id, 'orphan' FROM entity_chunks WHERE id NOT IN (SELECT id FROM graph_nodes WHERE id IS NOT NULL)",
    "j12_live_references": "SELECT id, coalesce(string_agg(s, '|' ORDER BY i) FILTER (k), '') AS kept, CAST(sum(CASE WHEN k THEN 0 ELSE 1 END) AS BIGINT) AS dropped FROM (SELECT id, s, i, s IN (SELECT id FROM text_chunks) OR NOT regexp_full_match(s, 'doc-[0-9a-f]{32}-chunk-[0-9]+') AS k FROM (SELECT id, unnest(chunk_ids) AS s, unnest(generate_series(1, len(chunk_ids))) AS i FROM entity_chunks) WHERE s IS NOT NULL) GROUP BY id",
}
