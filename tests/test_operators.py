"""Small cases of the core operators, with order-sensitive rules against hand-made results."""

import pytest
from pyspark.sql import functions as F

from graphloom.operators import chunking, citation, evaluation, graph, lifecycle, maintenance, merge, quality, records, retrieval


@pytest.fixture(scope="module")
def small(spark):
    edges = [(1, "b", "a", 1.0, "s1<SEP>s2"), (2, "a", "b", 2.0, "s2"), (3, "a", "c", 1.0, "s1"), (4, "c", "d", None, "s3"), (5, "e", "e", 1.0, "s1"), (6, None, "a", 1.0, None), (7, "f", "a", 3.0, "UNKNOWN")]
    nodes = spark.createDataFrame([(x,) for x in "abcdefg"], "id string")
    return nodes, graph.canonical(spark.createDataFrame([(*e, None) for e in edges], "gid long, src_id string, tgt_id string, weight double, source_id string, updated_at timestamp_ntz"))


def test_canonical_and_degrees(small, rows):
    nodes, pairs = small
    assert rows(pairs, "a", "b", "gid") == [("a", "b", 2), ("a", "c", 3), ("a", "f", 7), ("c", "d", 4)]
    assert rows(graph.with_degree(nodes, pairs))[:3] == [("a", 3), ("b", 1), ("c", 2)]
    assert [tuple(r) for r in graph.popular(nodes, pairs, 2).collect()] == [("a", 3), ("c", 2)]
    assert ("g", 0) in rows(graph.with_degree(nodes, pairs))


def test_subgraph_depth_and_cap(small, rows):
    nodes, pairs = small
    edges = pairs.select(F.col("b").alias("src_id"), F.col("a").alias("tgt_id"))
    assert rows(graph.subgraph(nodes, edges, "b", 2, 10)) == [("a", 1, False), ("b", 0, False), ("c", 2, False), ("f", 2, False)]
    assert rows(graph.subgraph(nodes, edges, "b", 3, 3)) == [("a", 1, True), ("b", 0, True), ("c", 2, True)]
    assert rows(graph.subgraph(nodes, edges, "nobody", 2, 10)) == []


def test_redirect_and_label_search(spark, small, rows):
    _, pairs = small
    names = spark.createDataFrame([("b", "a"), ("d", "f")], "old string, new string")
    full = pairs.withColumn("file_path", F.concat("a", F.lit(".pdf"))).withColumn("keywords", F.concat_ws(", ", "b", F.lit("k"))).withColumn("description", F.lit(None).cast("string"))
    assert rows(graph.redirect(full, names), "a", "b", "weight") == [("a", "c", 1.0), ("a", "f", 3.0), ("c", "f", 1.0)]
    assert rows(graph.redirect(full, names).where("b = 'f'"), "a", "source_id", "file_path", "keywords", "description") == [("a", "UNKNOWN", "a.pdf", "f,k", ""), ("c", "s3", "c.pdf", "d,k", "")]
    labels = spark.createDataFrame([("graph",), ("Graph theory",), ("a graph",), ("paragraph",)], "id string")
    assert [tuple(r) for r in graph.search_labels(labels, "graph", 9).collect()] == [("graph", 1000), ("Graph theory", 500), ("a graph", 143), ("paragraph", 91)]


def test_type_vote_ties_and_caps(spark, rows):
    r = spark.createDataFrame([("x", "b", 1), ("x", "a", 2), ("x", "a", 3), ("x", "b", 4), ("y", None, 1)], "name string, type string, pos long")
    assert rows(merge.type_vote(r)) == [("x", "b")]
    ids = spark.createDataFrame([(["p", "q", "r"],)], "v array<string>")
    got = ids.select(merge.capped(F.col("v"), 2).alias("k"), merge.capped(F.col("v"), 2, "FIFO").alias("f"), merge.capped_files(F.col("v"), 2).alias("n")).first()
    assert (got.k, got.f, got.n[-1]) == (["p", "q"], ["q", "r"], "...truncated...(KEEP Old)")


def test_edge_weight_does_not_grow_again(spark, rows):
    schema = "gid long, src string, tgt string, weight double, source_id string"
    new = spark.createDataFrame([(1, "a", "b", 1.0, "s1"), (2, "b", "a", 1.0, "s2"), (3, "a", "a", 9.0, "s3")], schema)
    first = merge.relations(new)
    assert rows(first) == [("a", "b", 2.0, 2)]
    stored = first.select("a", "b", "weight").withColumn("source_id", F.lit("s1<SEP>s2"))
    assert rows(merge.relations(new, stored)) == [("a", "b", 2.0, 2)]
    assert merge.relations(new.limit(0)).count() == 0


def test_entities_keep_every_name(spark):
    schema = "name string, type string, description string, source_id string, file_path string, pos long, time long"
    e = merge.entities(spark.createDataFrame([("x", "t", None, None, None, 1, 1), (" ", "t", "d", "s", "f", 2, 1), (None, "t", "d", "s", "f", 3, 1)], schema)).collect()
    assert [(r.name, r.description, r.source_id, r.chunks) for r in e] == [("x", "Entity x", "", 0)]


def lists(spark, *names):
    return [spark.createDataFrame([(x, i) for i, x in enumerate(n)], "id string, pos int") for n in names]


def test_interleave_advances_over_duplicates(spark):
    got = retrieval.interleave(lists(spark, "abc", "bxa")).orderBy("rank").collect()
    assert [r.id for r in got] == ["a", "b", "x", "c"]
    assert [r.id for r in retrieval.prepend(lists(spark, "ab", "cb")).orderBy("rank").collect()] == ["a", "b", "c"]


def test_quotas_are_half_even(spark):
    g = spark.createDataFrame([(i, 9) for i in range(5)], "group_pos int, n int")
    assert [r.quota for r in retrieval.quotas(g, 2).orderBy("group_pos").collect()] == [2, 2, 2, 1, 1]
    assert [r.quota for r in retrieval.quotas(g, 0).collect()] == [0] * 5
    g = spark.createDataFrame([(0, 5), (1, 1), (2, 0)], "group_pos int, n int")
    assert [r.quota for r in retrieval.quotas(g, 3).orderBy("group_pos").collect()] == [5, 1, 0]


def test_owned_chunks(spark, rows):
    g = spark.createDataFrame([(0, "x", 0), (0, "y", 1), (1, "y", 0), (1, "z", 1), (2, "x", 0)], "group_pos int, chunk_id string, pos int")
    assert rows(retrieval.owned_chunks(g), "group_pos", "chunk_id", "occurrence", "place") == [(0, "x", 2, 1), (0, "y", 2, 2), (1, "z", 1, 1)]


def test_search_and_budget(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0]), ("z", [0.0, 0.0]), ("c", [0.0, 1.0])], "id string, vector array<float>")
    assert [r.id for r in retrieval.search(v, [1.0, 0.0], 5).orderBy("pos").collect()] == ["a", "b"]
    b = spark.createDataFrame([(0, 4), (1, 4), (2, 1)], "pos int, n int")
    assert retrieval.within_budget(b, F.col("n"), [F.asc("pos")], 8).count() == 2
    assert retrieval.within_budget(b, F.col("n"), [F.asc("pos")], 0).count() == 0


def test_lexical_without_known_words(spark):
    c = spark.createDataFrame([("1", "reef and lichen"), ("2", None), ("3", "")], "id string, content string")
    assert retrieval.lexical(c, ["glacier"], 5).count() == 0
    assert [r.id for r in retrieval.lexical(c, ["lichen"], 5).collect()] == ["1"]


def test_windows(spark):
    d = spark.createDataFrame([(1, "abcdefghij"), (2, ""), (3, None)], "doc_id long, text string")
    got = [tuple(r) for r in chunking.windows(d, "text", 4, 1).orderBy("start").collect()]
    assert got == [(1, 0, 0, 4, "abcd"), (1, 1, 3, 4, "defg"), (1, 2, 6, 4, "ghij"), (1, 3, 9, 1, "j")]
    with pytest.raises(ValueError):
        chunking.windows(d, "text", 4, 4)


def test_python_chunkers():
    text = "One sentence here. Another one there.\n\n" * 10
    assert all(len(c) <= 80 for c in chunking.recursive(text, 80, 10))
    assert chunking.recursive("x" * 100, 30, 5) and chunking.recursive(None, 30, 5) == [] and chunking.recursive("  ", 30, 5) == []
    assert chunking.semantic("", chunking.hashed_vectors) == []
    assert [h for h, _ in chunking.structured("# A\n\none\n\ntwo\n\n# B\n\nthree", 100)] == ["A", "B"]


def test_records(spark, rows):
    reply = "(entity<|#|>Reef<|#|>Natural Place<|#|>a reef)\nentity<|#|>Bad<|#|>a/b<|#|>x\n(relation<|#|>A<|#|>B<|#|>k，l<|#|>d)<|#|>relation<|#|>A<|#|>A<|#|>k<|#|>d<|COMPLETE|>"
    p = records.parse_reply(spark.createDataFrame([(1, reply), (2, None), (3, "")], "key int, reply string"), "key", "reply")
    assert rows(records.entity_records(p, "key"), "name", "type") == [("Reef", "naturalplace")]
    assert rows(records.relation_records(p, "key"), "src", "tgt", "keywords") == [("A", "B", "k,l")]


def test_names(spark):
    n = spark.createDataFrame([("Smith et al. (1999)",), ("Figure 3",), ("12.5",), ("J. Smith",), ("Reef",)], "n string")
    assert [r[0] for r in n.select(records.junk_kind(F.col("n"))).collect()] == ["citation", "label", "numeric", "person", None]
    assert records.fold_name("Neural Networks") == records.fold_name("neural-network")
    assert records.fold_name(None) is None and records.fold_name("++") == "§++"
    long_ = spark.createDataFrame([("é" * 300,)], "n string").select(records.capped_name(F.col("n")).alias("n")).first().n
    assert len(long_.encode()) <= 512 and len(long_) == 256


def test_quality(spark):
    d = spark.createDataFrame([(1, "x"), (2, None), (3, "\n".join(["The running header of this whole report, page 3"] * 6 + ["body"] * 40))], "id int, text string")
    got = {r.id: r.text for r in quality.repeated_lines(d, "text", most_loss=0.9).collect()}
    assert got[1] == "x" and got[2] is None and got[3].count("header") == 1
    refs = "\n".join(f"Smith, A. B. ({1990 + i}). Title. Journal of X, vol. 3" for i in range(5))
    b = spark.createDataFrame([(refs,), ("plain text",)], "t string").select(quality.is_bibliography(F.col("t")).alias("b")).collect()
    assert [r.b for r in b] == [True, False]


def test_citation(spark, rows):
    refs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (2, "c"), (3, None)], "list_id int, item string")
    assert rows(citation.coupling(refs)) == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]
    t = spark.createDataFrame([("x", "y"), ("y", "z"), ("z", None)], "topic string, parent string")
    assert rows(citation.ancestors(t)) == [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    links = spark.createDataFrame([(1, 2), (2, 3), (1, 3)], "x long, y long")
    assert [(r.node, r.hops) for r in citation.cheapest(links, 1, 2).orderBy("node").collect()] == [(1, 0), (2, 1), (3, 1)]
    d = spark.createDataFrame([("https://doi.org/10.1234/AbC.",), ("doi: 10.99/x",), (None,)], "d string")
    assert [r[0] for r in d.select(citation.doi(F.col("d"))).collect()] == ["10.1234/abc", None, None]


def test_lifecycle(spark, rows):
    import datetime as dt

    d = spark.createDataFrame([("1", "A.pdf", "h1", dt.datetime(2024, 1, 2)), ("2", "x/a.pdf", "h2", dt.datetime(2024, 1, 1)), ("3", "b.pdf", "h1", dt.datetime(2024, 1, 3)), ("4", "unknown_source", None, dt.datetime(2024, 1, 3)), ("5", None, None, dt.datetime(2024, 1, 3))], "id string, file_path string, content_hash string, created_at timestamp_ntz")
    assert rows(lifecycle.enqueue(d)) == [("1", "duplicate", "2", "name"), ("2", "pending", None, None), ("3", "duplicate", "1", "hash"), ("4", "pending", None, None), ("5", "pending", None, None)]
    assert rows(lifecycle.conflicts(d), "name", "n") == [("a.pdf", 2)]


def test_evaluation(spark):
    docs = spark.createDataFrame([("a", "glacier survey"), ("b", "reef survey"), ("c", None)], "name string, text string")
    q = spark.createDataFrame([("q", "glacier"), ("r", "nothing known")], "query string, text string")
    ranked = evaluation.tfidf(docs, q, 2)
    assert [(r.query, r.name) for r in ranked.collect()] == [("q", "a")]
    expected = spark.createDataFrame([("q", "a"), ("r", "b")], "query string, name string")
    m = evaluation.measures(ranked, expected, 2).first()
    assert (m.queries, m.recall, m.mrr, m.full, m.none) == (2, 0.5, 0.5, 1, 1)


def test_maintenance(spark, rows):
    t = spark.createDataFrame([("x", ["doc-" + "a" * 32 + "-chunk-001", "free", None], 2), ("y", None, 1), ("z", [], 0)], "id string, chunk_ids array<string>, chunk_count int")
    live = spark.createDataFrame([("other",)], "id string")
    got = maintenance.live_references(t, live, r"^doc-[0-9a-f]{32}-chunk-[0-9]+$").first()
    assert (got.id, got.kept, got.dropped) == ("x", ["free"], 1)
    assert rows(maintenance.wrong_counts(t), "id") == [("x",), ("y",)]


def test_results_do_not_depend_on_partitions(spark, small, rows):
    nodes, pairs = small
    assert rows(graph.with_degree(nodes, pairs.repartition(7, "b"))) == rows(graph.with_degree(nodes, pairs.coalesce(1)))


def test_surroundings_of_every_mention(spark, rows):
    d = spark.createDataFrame([("a", "Table 1 and Table 2, then " + "x" * 300 + "Table Table 3"), ("b", "none"), ("c", None), ("d", "ends with Table ")], "doc_id string, text string")
    got = rows(chunking.mentions_around(d, "doc_id", "text", "Table ", 20))
    assert got == [("a", 1, "", "Table 1 an"), ("a", 2, "ble 1 and ", "Table 2, t"), ("a", 3, "x" * 10, "Table Tabl"), ("a", 4, "xxxxTable ", "Table 3"), ("d", 1, "ends with ", "Table ")]


def test_cheapest_paths(spark):
    """Against every simple path by brute force; the later paths avoid the inner nodes of those before."""
    import itertools
    import math
    import random

    rng = random.Random(5)
    edges = {tuple(sorted(rng.sample(range(12), 2))) for _ in range(22)} | {(0, 11)}
    adj = {n: {b if a == n else a for a, b in edges if n in (a, b)} for n in range(12)}
    toll = {n: 1 + 0.5 * math.log2(1 + len(adj[n])) for n in adj}
    want, banned, direct = [], set(), False
    for _ in range(3):
        ways = [(0, *inner, 11) for n in range(4) for inner in itertools.permutations(sorted(set(range(1, 11)) - banned), n)]
        ways = [w for w in ways if all(b in adj[a] for a, b in zip(w, w[1:], strict=False)) and not (direct and len(w) == 2)]
        if not ways:
            break
        best = min(ways, key=lambda w: (round(sum(toll[n] for n in w[1:-1]) + 1, 9), w))
        want.append((round(sum(toll[n] for n in best[1:-1]) + 1, 6), len(best) - 1))
        direct = direct or len(best) == 2
        banned |= set(best[1:-1])
    links = spark.createDataFrame(sorted(edges), "x long, y long")
    got = citation.cheapest_paths(links, 0, 11, 3, 4).orderBy("pos").collect()
    assert [(round(r.cost, 6), r.hops) for r in got] == want and len(want) > 1
    assert all(b in adj[a] for r in got for a, b in zip(r.path, r.path[1:], strict=False))
    assert citation.cheapest_paths(links, 0, 0, 3, 4).count() == 0
