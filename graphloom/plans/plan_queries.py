"""The query plan as a whole: search, truncation, choice and merging of chunks, post-processing and context, for every mode.

Lists are DataFrames with an explicit ``pos``. The question is given by its words and its vector (that of the first entity stands for
the embedded question); the works it names are the first two files named after an author and a year. A chunk stands for its
vector by the first name whose tracking begins with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import parts
from graphloom.operators import graph, retrieval
from graphloom.plans.graph_queries import ALL_SQL, LIST_SQL, names, nodes
from graphloom.plans.retrieval_queries import K, VEC_SQL, WORDS, _hits, _lex_sql, bibliography_sql, chunks, lex, query_vector, vectors
from graphloom.session import cut
from graphloom.sources.tables import table, unique

#: Budgets in characters for the records of entities, of relations, and for chunks; chunks of one group, of the vector list, at last.
ENTITY_BUDGET, RELATION_BUDGET, CHUNK_BUDGET, RELATED, CHUNK_TOP = 6000, 8000, 30_000, 5, 20
#: Chunks a work may give, and chunks of a named work that are pinned; the least share of the question's terms.
WORK_MOST, PIN_MOST, FLOOR = 3, 2, 0.1
#: A relation's record has more characters than this, so that the budget bounds the list before it is read.
RECORD_LEAST = 50
#: A file named after an author and a year, with the end of its id.
NAMED = r"^([A-Z][a-z]{2,}) ((?:19|20)[0-9]{2}) [0-9a-f]{6}\.[a-z]+$"


class Plan:
    """One question over one set of tables; tables that several lists read are made once."""

    def __init__(self, spark: SparkSession, d: str, mode: str):
        self.spark, self.d, self.mode = spark, d, mode
        self.low, self.high = retrieval.routed(mode, WORDS, WORDS)
        e = unique(spark, d, "graph_edges", "src_id", "tgt_id", "weight", "source_id", "properties", "updated_at")
        self.pairs = cut(graph.canonical(e)) if mode != "naive" else None
        self.vectors = cut(vectors(spark, d))
        self.query = query_vector(self.vectors)

    def hits(self, kind: str, *columns: str) -> DataFrame:
        """The vector hits among entities or relations (bounded by K): pos and the columns."""
        return retrieval.held(retrieval.search(self.vectors.where(F.col(kind).isNotNull()), self.query, K, carry=columns).select("pos", *columns))

    def local(self) -> tuple[DataFrame, DataFrame]:
        """Hit entities in their order with their degree, and their edges by the degree of both ends, then weight."""
        hits = self.hits("entity_name", "entity_name").select(F.col("entity_name").alias("id"), F.col("pos").alias("hit"))
        there = names(self.spark, self.d).join(F.broadcast(hits), "id", "left_semi")
        found = retrieval.held(retrieval.ranked(there.join(F.broadcast(hits), "id"), [F.asc("hit")]).select("id", "pos"))
        near = graph.adjacency(self.pairs, "weight").join(F.broadcast(found.withColumnRenamed("id", "node")), "node")
        near = near.groupBy(F.least("node", "nbr").alias("a"), F.greatest("node", "nbr").alias("b")).agg(F.min(F.struct("pos", "nbr")).alias("first"), F.max("weight").alias("weight"))
        near = cut(near)
        # degrees of the ends of these edges alone
        ends = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        degree = graph.adjacency(self.pairs.select("a", "b")).join(ends, "node", "left_semi").groupBy("node").agg(F.count("*").alias("degree"))
        of = lambda c: degree.select(F.col("node").alias(c), F.col("degree").alias(f"_{c}"))
        rank = near.join(of("a"), "a").join(of("b"), "b").withColumn("rank", F.col("_a") + F.col("_b")).withColumn("weight", F.coalesce("weight", F.lit(1.0)))
        order = [F.desc("rank"), F.desc("weight"), F.asc("first")]
        edges = retrieval.ranked(rank.orderBy(*order).limit(RELATION_BUDGET // RECORD_LEAST), order)
        return found, edges.select("a", "b", "pos")

    def overall(self) -> tuple[DataFrame, DataFrame]:
        """Ends of the hit relations, first seen first, and the hit relations that are stored, by similarity."""
        h = self.hits("src_id", "src_id", "tgt_id").select("pos", "src_id", "tgt_id", F.least("src_id", "tgt_id").alias("a"), F.greatest("src_id", "tgt_id").alias("b"))
        one = h.groupBy("a", "b").agg(F.min("pos").alias("hit"))
        edges = retrieval.ranked(self.pairs.select("a", "b").join(F.broadcast(one), ["a", "b"]), [F.asc("hit")]).select("a", "b", "pos")
        first = h.select("pos", F.posexplode(F.array("src_id", "tgt_id")).alias("i", "id")).groupBy("id").agg(F.min(F.col("pos") * 2 + F.col("i")).alias("place"))
        found = retrieval.ranked(names(self.spark, self.d).join(F.broadcast(first), "id"), [F.asc("place")]).select("id", "pos")
        return found, edges

    def search(self) -> tuple[DataFrame, DataFrame]:
        """Ranked entities (id, pos) and relations (id: both ends as an array, pos) of the mode's lists in turn."""
        lists = ([self.local()] if self.low else []) + ([self.overall()] if self.high else [])
        if not lists:
            empty = self.spark.createDataFrame([], "id string, pos int")
            return empty, self.spark.createDataFrame([], "id array<string>, pos int")
        ends = F.array("a", "b").alias("id")
        merged = [retrieval.interleave([x[i] if i == 0 else x[i].select(ends, "pos") for x in lists]).select("id", F.col("rank").alias("pos")) for i in (0, 1)]
        return merged[0], merged[1]

    def truncated(self) -> tuple[DataFrame, DataFrame]:
        """Entities and relations with their JSON records, cut to the budgets, and the sources their chunks come from."""
        entities, relations = self.search()
        field = lambda k: F.coalesce(F.get_json_object("properties", f"$.{k}"), F.lit("")).alias(k)
        n = nodes(self.spark, self.d, "entity_type", "source_id", "properties").select("id", F.coalesce("entity_type", F.lit("UNKNOWN")).alias("type"), "source_id", field("description"))
        e = n.join(F.broadcast(entities), "id").dropDuplicates(["id"])
        e = e.withColumn("line", F.to_json(F.struct(F.col("id").alias("entity"), "type", "description")))
        e = retrieval.within_budget(e, F.length("line") + 1, [F.asc("pos")], ENTITY_BUDGET).select("id", "pos", "line", "source_id")
        p = self.pairs.withColumn("id", F.array("a", "b")).select("id", "a", "b", "source_id", field("description"), field("keywords"))
        r = p.join(F.broadcast(relations), "id").withColumn("line", F.to_json(F.struct(F.col("a").alias("entity1"), F.col("b").alias("entity2"), "description", "keywords")))
        r = retrieval.within_budget(r, F.length("line") + 1, [F.asc("pos")], RELATION_BUDGET).select(F.array_join("id", "|").alias("id"), "pos", "line", "source_id")
        return retrieval.held(e), retrieval.held(r)

    def chunk_vectors(self) -> DataFrame:
        """(id, vector): a chunk's vector is that of the first name whose tracking begins with it."""
        first = table(self.spark, self.d, "entity_chunks").select(F.col("id").alias("entity_name"), F.try_element_at("chunk_ids", F.lit(1)).alias("chunk")).where("chunk is not null")
        v = self.vectors.where("entity_name is not null").select("entity_name", "vector")
        return v.join(first, "entity_name").groupBy(F.col("chunk").alias("id")).agg(F.min_by("vector", "entity_name").alias("vector"))

    def _groups(self, ranked: DataFrame) -> DataFrame:
        return ranked.select(F.col("pos").alias("group_pos"), F.posexplode(parts(F.col("source_id"))).alias("pos", "chunk_id")).where(F.col("chunk_id").startswith("doc-"))

    def _pick(self, groups: DataFrame, n_groups: int, v: DataFrame) -> DataFrame:
        """Chunks of groups by similarity; by weight where no candidate has a vector."""
        owned = retrieval.held(retrieval.owned_chunks(groups))
        near = retrieval.pick_by_vector(owned, v, self.query, RELATED, n_groups)
        near = retrieval.ranked(near, [F.desc("score"), F.asc("group_pos"), F.asc("place")]).select(F.col("chunk_id").alias("id"), "pos")
        near = retrieval.held(near)
        if near.count():
            return near
        heavy = retrieval.pick_by_weight(owned, RELATED)
        return retrieval.ranked(heavy.select(F.col("chunk_id").alias("id"), "group_pos", "place"), [F.asc("group_pos"), F.asc("place")]).select("id", "pos")

    def works(self) -> DataFrame:
        """(work, work_pos): the works that the question names."""
        w = table(self.spark, self.d, "text_chunks").where(F.col("file_path").rlike(NAMED)).groupBy("full_doc_id").agg(F.min("file_path").alias("file")).orderBy("full_doc_id").limit(2)
        return retrieval.ranked(w.select(F.col("full_doc_id").alias("work")), [F.asc("work")]).select("work", F.col("pos").alias("work_pos"))

    def metadata(self, words_hit: DataFrame) -> DataFrame:
        """(id, pos): of each named work its first chunk and its best by the lexical score."""
        works = self.works()
        c = chunks(self.spark, self.d).select("id", F.col("full_doc_id").alias("work"), "chunk_order_index").join(F.broadcast(works), "work").distinct()
        c = c.join(F.broadcast(words_hit.select("id", "score")), "id", "left").withColumn("place", F.coalesce("chunk_order_index", F.lit(1 << 30)))
        return retrieval.per_work(c.na.fill(0.0, ["score"]), CHUNK_TOP, 2).select("id", "pos")

    def text_lists(self, v: DataFrame) -> DataFrame:
        """(id, pos): named works' chunks before the vector list, and the lexical list in turn with both. v: the chunks' vectors."""
        near = retrieval.search(v, self.query, CHUNK_TOP).select("id", "pos")
        hits = retrieval.held(lex(self.spark, self.d, CHUNK_TOP))
        first = retrieval.prepend([self.metadata(hits), near]).select("id", F.col("rank").alias("pos"))
        return retrieval.interleave([first, hits.select("id", "pos")]).select("id", F.col("rank").alias("pos"))

    def result(self) -> dict[str, DataFrame]:
        """entities, relations and chunks of the plan: id, pos, line (the record as it stands in the context) and, of chunks, file_path."""
        v = cut(self.chunk_vectors())  # as many as there are chunks
        lists, out = [], {}
        if self.mode in ("mix", "naive"):
            lists.append(self.text_lists(v))
        if self.mode != "naive":
            entities, relations = self.truncated()
            mine = retrieval.held(self._pick(self._groups(entities), entities.count(), v))
            rest = self._groups(relations).join(F.broadcast(mine.select(F.col("id").alias("chunk_id"))), "chunk_id", "left_anti")
            lists += [mine, self._pick(rest, relations.count(), v)]
            out = {"entity": entities, "relation": relations}
        merged = retrieval.interleave(lists).select("id", F.col("rank").alias("pos"))
        rows = retrieval.held(retrieval.with_rows(retrieval.held(merged), chunks(self.spark, self.d).withColumnRenamed("full_doc_id", "work"), "work", "content", "file_path"))
        done = retrieval.processed(rows, WORDS, CHUNK_TOP, CHUNK_BUDGET, FLOOR, WORK_MOST, self.works(), PIN_MOST)
        done = done.join(rows.select("id", "content", "file_path"), "id").select("id", "pos", F.to_json(F.struct("id", "content")).alias("line"), "file_path")
        return {**out, "chunk": retrieval.held(done)}


def _rows(result: dict[str, DataFrame]) -> DataFrame:
    whole = None
    for kind, df in result.items():
        x = df.select(F.lit(kind).alias("kind"), F.col("pos").cast("long").alias("pos"), "id", "line")
        whole = x if whole is None else whole.unionByName(x)
    return whole


def _mode(mode: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _rows(Plan(spark, d, mode).result()).drop("line")

    run.__name__, run.__doc__ = f"r11_mode_{mode}", f"Everything that a {mode} query gives: entities, relations and chunks in their order."
    return run


def r29_naive(spark, d):
    """Naive mode: the vector list with the named works' chunks before it, in turn with the lexical list, and the post-processing."""
    return _rows(Plan(spark, d, "naive").result()).select("id", "pos")


def r20_processed_chunks(spark, d):
    """Lexical candidates through the whole post-processing."""
    rows = retrieval.with_rows(lex(spark, d, 3 * K), chunks(spark, d).withColumnRenamed("full_doc_id", "work"), "work", "content")
    return retrieval.processed(rows, WORDS, CHUNK_TOP, CHUNK_BUDGET, FLOOR, WORK_MOST, Plan.works(_Only(spark, d)), PIN_MOST)


#: The budget of the context fit, which ends among the chunks.
FIT_BUDGET = 20_000


def r19_context_fit(spark, d):
    """The local and global hits and the lexical chunks fitted to one budget."""
    v = vectors(spark, d)
    query = query_vector(v)
    e = retrieval.search(v.where("entity_name is not null"), query, K, carry=("entity_name",)).select("pos", F.length("entity_name").alias("tokens"))
    r = retrieval.search(v.where("src_id is not null"), query, K, carry=("src_id", "tgt_id")).select("pos", (F.length("src_id") + F.length("tgt_id")).alias("tokens"))
    c = retrieval.with_rows(lex(spark, d), chunks(spark, d), "content").select("pos", F.coalesce(F.length("content"), F.lit(0)).alias("tokens"))
    return retrieval.fit_context(e, r, c, FIT_BUDGET)


class _Only(Plan):
    """A plan of which only the tables are asked."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d


def r22_named_work_pin(spark, d):
    """The named works' chunks and their order by the metadata list, with those that a pin moves to the front."""
    plan = _Only(spark, d)
    hits = lex(spark, d, CHUNK_TOP)
    found = plan.metadata(hits)
    rows = retrieval.with_rows(retrieval.interleave([hits.select("id", "pos"), found]).select("id", F.col("rank").alias("pos")), chunks(spark, d).withColumnRenamed("full_doc_id", "work"), "work", "content")
    return retrieval.processed(rows, WORDS, 2 * CHUNK_TOP, 10 * CHUNK_BUDGET, 0.0, 0, plan.works(), PIN_MOST).select("id", "pinned", "pos")


def r26_context(spark, d):
    """The context of a hybrid query as JSON lines: entities, relations, then chunks, numbered through."""
    r = _rows(Plan(spark, d, "hybrid").result())
    order = F.when(F.col("kind") == "entity", 0).when(F.col("kind") == "relation", 1).otherwise(2)
    x = r.withColumn("_k", order).withColumnRenamed("pos", "_p")
    return retrieval.ranked(x, [F.asc("_k"), F.asc("_p")]).select(F.col("pos").cast("long").alias("place"), "kind", "line")


def r27_structured_result(spark, d):
    """The result of a mix query as one table: records of each kind with their counts, and the references of its chunks."""
    result = Plan(spark, d, "mix").result()
    refs = retrieval.references(result["chunk"].where("file_path is not null")).select(F.lit("reference").alias("kind"), (F.col("reference") - 1).cast("long").alias("pos"), F.col("file_path").alias("id"))
    whole = _rows(result).drop("line").unionByName(refs)
    return whole.join(F.broadcast(whole.groupBy("kind").agg(F.count("*").alias("count"))), "kind")


_F = lambda c, k: f"coalesce({c}.properties ->> '$.{k}', '')"


def _plan_sql(mode: str) -> str:
    """CTEs en, re and ck (kind's rows: id, pos, line) of a mode."""
    use_local, use_all, text = mode in ("local", "hybrid", "mix"), mode in ("global", "hybrid", "mix"), mode in ("mix", "naive")
    sql = [
        ALL_SQL, VEC_SQL, _hits("entity_name"), _hits("src_id").replace("h AS", "h2 AS", 1), _lex_sql(CHUNK_TOP),
        "pe AS (SELECT p.*, e.properties FROM p JOIN (SELECT DISTINCT gid, properties FROM graph_edges) e USING (gid))",
        "cv AS (SELECT chunk AS id, arg_min(vector, entity_name) AS vector FROM (SELECT id AS entity_name, chunk_ids[1] AS chunk FROM entity_chunks) JOIN vec USING (entity_name) WHERE chunk IS NOT NULL GROUP BY 1)",
        f"wk AS (SELECT work, row_number() OVER (ORDER BY work) - 1 AS work_pos FROM (SELECT full_doc_id AS work FROM ch WHERE regexp_matches(file_path, '{NAMED}') GROUP BY 1 ORDER BY 1 LIMIT 2))",
        # entities and relations
        "le AS (SELECT entity_name AS id, row_number() OVER (ORDER BY h.pos) - 1 AS pos FROM h JOIN lab ON lab.id = h.entity_name)",
        "ne AS (SELECT least(node, nbr) AS a, greatest(node, nbr) AS b, min(struct_pack(p := pos, n := nbr)) AS first FROM adj JOIN le ON le.id = adj.node GROUP BY 1, 2)",
        f"lr AS (SELECT ne.a, ne.b, row_number() OVER (ORDER BY x.degree + y.degree DESC, coalesce(p.weight, 1.0) DESC, first) - 1 AS pos FROM ne JOIN p ON p.a = ne.a AND p.b = ne.b JOIN deg x ON x.id = ne.a JOIN deg y ON y.id = ne.b QUALIFY pos < {RELATION_BUDGET // RECORD_LEAST})",
        "gr AS (SELECT p.a, p.b, row_number() OVER (ORDER BY hit) - 1 AS pos FROM p JOIN (SELECT least(src_id, tgt_id) AS a, greatest(src_id, tgt_id) AS b, min(pos) AS hit FROM h2 GROUP BY 1, 2) o ON o.a = p.a AND o.b = p.b)",
        "ge AS (SELECT id, row_number() OVER (ORDER BY place) - 1 AS pos FROM (SELECT id, min(place) AS place FROM (SELECT src_id AS id, pos * 2 AS place FROM h2 UNION ALL SELECT tgt_id, pos * 2 + 1 FROM h2) GROUP BY 1) JOIN lab USING (id))",
    ]
    legs = [x for x, on in (("l", use_local), ("g", use_all)) if on]
    if legs:
        u = lambda k, cols: " UNION ALL ".join(f"SELECT {cols}, pos, {i} AS leg FROM {x}{k}" for i, x in enumerate(legs))
        sql += [
            f"e1 AS (SELECT id, row_number() OVER (ORDER BY x) - 1 AS pos FROM (SELECT id, min(struct_pack(p := pos, l := leg)) AS x FROM ({u('e', 'id')}) GROUP BY 1))",
            f"r1 AS (SELECT a, b, row_number() OVER (ORDER BY x) - 1 AS pos FROM (SELECT a, b, min(struct_pack(p := pos, l := leg)) AS x FROM ({u('r', 'a, b')}) GROUP BY 1, 2))",
            f"e2 AS (SELECT e1.id, pos, nn.source_id, '{{\"entity\":' || to_json(e1.id) || ',\"type\":' || to_json(coalesce(entity_type, 'UNKNOWN')) || ',\"description\":' || to_json({_F('nn', 'description')}) || '}}' AS line FROM e1 JOIN (SELECT DISTINCT id, entity_type, source_id, properties FROM n) nn ON nn.id = e1.id)",
            f"en AS (SELECT id, pos, line, source_id FROM (SELECT *, sum(length(line) + 1) OVER (ORDER BY pos) AS t FROM e2) WHERE t <= {ENTITY_BUDGET})",
            f"r2 AS (SELECT pe.a || '|' || pe.b AS id, pos, pe.source_id, '{{\"entity1\":' || to_json(pe.a) || ',\"entity2\":' || to_json(pe.b) || ',\"description\":' || to_json({_F('pe', 'description')}) || ',\"keywords\":' || to_json({_F('pe', 'keywords')}) || '}}' AS line FROM r1 JOIN pe ON pe.a = r1.a AND pe.b = r1.b)",
            f"re AS (SELECT id, pos, line, source_id FROM (SELECT *, sum(length(line) + 1) OVER (ORDER BY pos) AS t FROM r2) WHERE t <= {RELATION_BUDGET})",
        ]
        own = lambda name, rows, but: (
            f"{name}0 AS (SELECT group_pos, s AS chunk_id, min(i) AS pos FROM (SELECT pos AS group_pos, unnest({LIST_SQL.format('source_id')}) AS s, unnest(generate_series(0, len({LIST_SQL.format('source_id')}) - 1)) AS i FROM {rows}) WHERE starts_with(s, 'doc-'){but} GROUP BY 1, 2),"
            f" {name}1 AS (SELECT *, count(*) OVER (PARTITION BY chunk_id) AS occ, row_number() OVER (PARTITION BY chunk_id ORDER BY group_pos, pos) AS r FROM {name}0),"
            f" {name}2 AS (SELECT group_pos, chunk_id, row_number() OVER (PARTITION BY group_pos ORDER BY occ DESC, pos) AS place FROM {name}1 WHERE r = 1),"
            f" {name}v AS (SELECT chunk_id AS id, row_number() OVER (ORDER BY score DESC, group_pos, place) - 1 AS pos FROM (SELECT {name}2.*, list_cosine_similarity(vector, qv) AS score FROM {name}2 JOIN cv ON cv.id = chunk_id, q) QUALIFY pos < greatest(1, {RELATED} * (SELECT count(*) FROM {rows}) // 2)),"
            f" {name}c AS (SELECT group_pos, count(*) AS n FROM {name}2 GROUP BY 1), {name}d AS (SELECT *, row_number() OVER (ORDER BY group_pos) - 1 AS i, count(*) OVER () AS m FROM {name}c),"
            f" {name}e AS (SELECT *, CAST(CASE WHEN m = 1 THEN {RELATED} ELSE round_even({RELATED} - i / (m - 1.0) * {RELATED - 1}, 0) END AS INTEGER) AS want FROM {name}d), {name}f AS (SELECT *, least(want, n) AS base, n - least(want, n) AS more FROM {name}e),"
            f" {name}g AS (SELECT group_pos, base + greatest(0, least(more, sum(want - base) OVER () - coalesce(sum(more) OVER (ORDER BY group_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS quota FROM {name}f),"
            f" {name}w AS (SELECT chunk_id AS id, row_number() OVER (ORDER BY group_pos, place) - 1 AS pos FROM {name}2 JOIN {name}g USING (group_pos) WHERE place <= quota),"
            f" {name} AS (SELECT id, pos FROM {name}v UNION ALL SELECT id, pos FROM {name}w WHERE NOT EXISTS (SELECT 1 FROM {name}v))"
        )
        sql += [own("mine", "en", ""), own("rest", "re", " AND s NOT IN (SELECT id FROM mine)")]
    lists = []
    if text:
        sql += [
            f"nv AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) - 1 AS pos FROM (SELECT id, list_cosine_similarity(vector, qv) AS score FROM cv, q) WHERE score >= {retrieval.THRESHOLD} QUALIFY pos < {CHUNK_TOP})",
            "m0 AS (SELECT ch.id, work, work_pos, coalesce(chunk_order_index, 1073741824) AS place, coalesce(lx.score, 0.0) AS score FROM ch JOIN wk ON wk.work = ch.full_doc_id LEFT JOIN lx ON lx.id = ch.id)",
            "m1 AS (SELECT *, row_number() OVER (PARTITION BY work ORDER BY place, id) = 1 AS lead FROM m0)",
            f"md AS (SELECT id, row_number() OVER (ORDER BY work_pos, r) - 1 AS pos FROM (SELECT *, row_number() OVER (PARTITION BY work ORDER BY lead DESC, score DESC, place, id) AS r FROM m1) WHERE r <= {-(-CHUNK_TOP // 2)})",
            "t1 AS (SELECT id, row_number() OVER (ORDER BY x) - 1 AS pos FROM (SELECT id, min(struct_pack(l := leg, p := pos)) AS x FROM (SELECT id, pos, 0 AS leg FROM md UNION ALL SELECT id, pos, 1 FROM nv) GROUP BY 1))",
            "tl AS (SELECT id, row_number() OVER (ORDER BY x) - 1 AS pos FROM (SELECT id, min(struct_pack(p := pos, l := leg)) AS x FROM (SELECT id, pos, 0 AS leg FROM t1 UNION ALL SELECT id, pos, 1 FROM lx) GROUP BY 1))",
        ]
        lists.append("tl")
    lists += ["mine", "rest"] if legs else []
    union = " UNION ALL ".join(f"SELECT id, pos, {i} AS leg FROM {x}" for i, x in enumerate(lists))
    sql += [f"mg AS (SELECT id, row_number() OVER (ORDER BY x) - 1 AS pos FROM (SELECT id, min(struct_pack(p := pos, l := leg)) AS x FROM ({union}) GROUP BY 1))", _processed_sql("mg", CHUNK_TOP, CHUNK_BUDGET, FLOOR, WORK_MOST)]
    return ", ".join(sql)


def _processed_sql(rows: str, top: int, budget: int, floor: float, most: int) -> str:
    terms = retrieval.question_terms(WORDS)
    share = f"round(len(list_filter(list_distinct(regexp_split_to_array(lower(content), '[^a-z]+')), lambda t: list_contains({terms!r}, t))) / {float(len(terms))}, 6)"
    cap = f" QUALIFY row_number() OVER (PARTITION BY work ORDER BY pinned DESC, score DESC, pos) <= {most}" if most else ""
    return (
        f"c1 AS (SELECT ch.id, {rows}.pos, full_doc_id AS work, content, file_path, {share} AS score FROM {rows} JOIN ch USING (id) WHERE content IS NOT NULL AND NOT {bibliography_sql('content')}),"
        f" c2 AS (SELECT *, work IN (SELECT work FROM wk) AND row_number() OVER (PARTITION BY work ORDER BY score DESC, pos) <= {PIN_MOST} AS pinned FROM c1 WHERE score >= {floor}),"
        f" c3 AS (SELECT * FROM c2{cap}), c4 AS (SELECT * FROM c3 ORDER BY pinned DESC, score DESC, pos LIMIT {top}),"
        f" c5 AS (SELECT *, sum(length(content)) OVER (ORDER BY pinned DESC, score DESC, pos) AS t FROM c4),"
        f" ck AS (SELECT id, score, pinned, row_number() OVER (ORDER BY pinned DESC, score DESC, c5.pos) - 1 AS pos, '{{\"id\":' || to_json(id) || ',\"content\":' || to_json(content) || '}}' AS line, file_path FROM c5 WHERE t <= {budget})"
    )


def _rows_sql(mode: str, columns: str = "pos, id") -> str:
    kinds = [("chunk", "ck")] if mode == "naive" else [("entity", "en"), ("relation", "re"), ("chunk", "ck")]
    return " UNION ALL ".join(f"SELECT '{k}' AS kind, {columns} FROM {t}" for k, t in kinds)


_WORKS_SQL = f"wk AS (SELECT work, row_number() OVER (ORDER BY work) - 1 AS work_pos FROM (SELECT full_doc_id AS work FROM ch WHERE regexp_matches(file_path, '{NAMED}') GROUP BY 1 ORDER BY 1 LIMIT 2))"
_META_SQL = (
    "m0 AS (SELECT ch.id, work, work_pos, coalesce(chunk_order_index, 1073741824) AS place, coalesce(lx.score, 0.0) AS score FROM ch JOIN wk ON wk.work = ch.full_doc_id LEFT JOIN lx ON lx.id = ch.id),"
    " m1 AS (SELECT *, row_number() OVER (PARTITION BY work ORDER BY place, id) = 1 AS lead FROM m0),"
    f" md AS (SELECT id, row_number() OVER (ORDER BY work_pos, r) - 1 AS pos FROM (SELECT *, row_number() OVER (PARTITION BY work ORDER BY lead DESC, score DESC, place, id) AS r FROM m1) WHERE r <= {-(-CHUNK_TOP // 2)}),"
    " mg AS (SELECT id, row_number() OVER (ORDER BY x) - 1 AS pos FROM (SELECT id, min(struct_pack(p := pos, l := leg)) AS x FROM (SELECT id, pos, 0 AS leg FROM lx UNION ALL SELECT id, pos, 1 FROM md) GROUP BY 1))"
)
QUERIES = {f.__name__: f for f in (_mode("local"), _mode("global"), _mode("hybrid"), _mode("mix"), r19_context_fit, r20_processed_chunks, r22_named_work_pin, r26_context, r27_structured_result, r29_naive)}
SQL = {
    **{f"r11_mode_{m}": f"{_plan_sql(m)} {_rows_sql(m)}" for m in ("local", "global", "hybrid", "mix")},
    "r19_context_fit": (
        f"WITH {VEC_SQL}, {_hits('entity_name')}, {_hits('src_id').replace('h AS', 'h2 AS', 1)}, {_lex_sql(K)}, w AS (SELECT 0 AS leg, 'entity' AS kind, pos, length(entity_name) AS tokens FROM h UNION ALL SELECT 1, 'relation', pos, length(src_id) + length(tgt_id) FROM h2),"
        f" b AS (SELECT *, sum(tokens) OVER (ORDER BY pos, leg) AS t FROM w QUALIFY t <= {FIT_BUDGET}), rest AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.leg = w.leg AND b.pos = w.pos) UNION ALL SELECT 2, 'chunk', pos, coalesce(length(content), 0) FROM lx JOIN ch USING (id)),"
        f" m AS (SELECT *, sum(tokens) OVER (ORDER BY leg, pos) AS t FROM rest QUALIFY t + (SELECT coalesce(sum(tokens), 0) FROM b) <= {FIT_BUDGET}) SELECT kind, pos, tokens FROM b UNION ALL SELECT kind, pos, tokens FROM m"
    ),
    "r29_naive": f"{_plan_sql('naive')} SELECT id, pos FROM ck",
    "r20_processed_chunks": f"WITH {_lex_sql(3 * K)}, {_WORKS_SQL}, {_processed_sql('lx', CHUNK_TOP, CHUNK_BUDGET, FLOOR, WORK_MOST)} SELECT id, score, pinned, pos FROM ck",
    "r22_named_work_pin": f"WITH {_lex_sql(CHUNK_TOP)}, {_WORKS_SQL}, {_META_SQL}, {_processed_sql('mg', 2 * CHUNK_TOP, 10 * CHUNK_BUDGET, 0.0, 0)} SELECT id, pinned, pos FROM ck",
    "r26_context": f"{_plan_sql('hybrid')} SELECT row_number() OVER (ORDER BY CASE kind WHEN 'entity' THEN 0 WHEN 'relation' THEN 1 ELSE 2 END, pos) - 1 AS place, kind, line FROM ({_rows_sql('hybrid', 'pos, line')})",
    "r27_structured_result": (
        f"{_plan_sql('mix')}, al AS ({_rows_sql('mix')} UNION ALL SELECT 'reference', row_number() OVER (ORDER BY n DESC, first) - 1, file_path FROM (SELECT file_path, count(*) AS n, min(pos) AS first FROM ck WHERE file_path IS NOT NULL GROUP BY 1))"
        " SELECT *, count(*) OVER (PARTITION BY kind) AS count FROM al"
    ),
}
