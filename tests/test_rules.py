"""Rules of records, texts, chunks, merges, citations and time joins on small cases, against brute force where there is one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import chunking, citation, graph, maintenance, merge, quality, records, retrieval, timejoins

T = dt.datetime


# --- records
@pytest.mark.parametrize("text,names", [('{"entities": [{"name": "A"}]}', ["A"]), ('So: ```json\n{"entities": [{"name": "A"}, {"name": "B"}, {"na', ["A", "B"]), ('{"entities": [{"name": "A }\\" ]"},]}', ['A }" ]']), ('{"entities": [{"name": "A"}]} and {"more": 1}', ["A"]), ("nothing", None), ("", None), (None, None), ('{"entities": [', None)])
def test_json_is_mended(text, names):
    import json

    got = records.mended_json(text)
    assert (got and [e["name"] for e in json.loads(got)["entities"]]) == names


def test_names_are_capped_by_bytes_and_wide_names_close_up(spark):
    names = ["x" * 300, "é" * 300, "日" * 300, "𝒳" * 200, "日 本 語", "日本 API v2", None, ""]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(records.capped_name(F.col("n"))).collect()]
    assert got == ["x" * 256, "é" * 256, "日" * 170, "𝒳" * 128, "日本語", "日本API v2", None, ""]


def test_folding():
    same = lambda *names: len({records.fold_name(n) for n in names}) == 1
    assert same("Neural Networks", "neural-network", "NEURAL NETWORK") and same("Case studies", "case study") and same("speeches", "speech") and same("analyses", "Analysis") and same("ﬁeld notes", "field note")
    assert not same("Physics", "Physic") and not same("bus", "bu") and records.fold_name("AIDS") != records.fold_name("aids")
    assert records.is_flawed(" Reef") and records.is_flawed("Reef (big") and records.is_flawed("Reef,") and not records.is_flawed("Reef (big)") and not records.is_flawed("C++")


def test_canonical_name_of_a_fold(spark, rows):
    n = spark.createDataFrame([("coral reefs", 9), ("coral reef", 9), ("coral reef,", 50), ("Coral Reef", 3)], "name string, degree int")
    assert {r.canonical for r in records.fold_map(n).collect()} == {"coral reef"}


def test_junk_goes_with_its_own_chunk(spark, rows):
    e = spark.createDataFrame([(1, "J. Smith", "person"), (2, "J. Smith", "concept"), (1, "Reef", "place"), (3, "J. Smith", "person"), (3, "J. Smith", "method")], "key int, name string, type string")
    r = spark.createDataFrame([(1, "Reef", "J. Smith"), (2, "Reef", "J. Smith"), (4, "Reef", "J. Smith"), (4, "Reef", "Lichen"), (3, "Reef", "J. Smith")], "key int, src string, tgt string")
    kept, left = records.without_junk(e, r, "key")
    assert rows(kept, "key", "name") == [(1, "J. Smith"), (1, "Reef")] and rows(left, "key", "tgt") == [(1, "J. Smith"), (4, "Lichen")]


def test_a_declared_contract(spark, rows):
    r = spark.createDataFrame([("a", "b", "owned by"), ("a", "b", "owns, near"), ("a", "b", "other"), ("a", "b", None)], "src string, tgt string, keywords string")
    assert rows(records.typed_relations(r, {"owns": "owned_by"})) == [("a", "b", "owns"), ("b", "a", "owns")]
    assert rows(records.typed_relations(r, {"owns": "owned_by", "related_to": None}), "types") == [("owns",), ("owns",), ("related_to",), ("related_to",)]


def test_headings_collapse_one_by_one(spark):
    h = ["Part one", "x" * 30, "y" * 10, "Leaf"]
    path = lambda budget: spark.createDataFrame([(h,)], "h array<string>").select(records.heading_path(F.col("h"), budget)).first()[0]
    assert path(200) == " → ".join(h) and path(40) == "Part one → … → " + "y" * 10 + " → Leaf" and path(30) == "Part one → … → Leaf" and path(1) == "Part one → … → Leaf"


# --- quality
def test_repeated_lines_against_plain_python(spark):
    rng = random.Random(3)
    running = ["The running title of the whole report, page %d", "# A heading that stands on every single page %d", "short %d", "Another line of forty characters or more  %d"]
    texts = []
    for _ in range(30):
        n = rng.randint(1, 14)
        texts.append("\n".join(line for i in range(n) for line in (rng.choice(running) % i, f"own text {rng.random()} " * rng.randint(4, 12))))
    texts += [None, "", "\n\n"]

    def plain(t):
        import re

        if not t:
            return t
        key = [re.sub("[0-9]+", "#", re.sub(r"\s+", " ", x).strip(" ")) if not re.match(r"(?:[#|-]|```)", re.sub(r"\s+", " ", x).strip(" ")) else "" for x in t.split("\n")]
        out, seen = [], set()
        for line, k in zip(t.split("\n"), key, strict=True):
            if len(k) >= 40 and key.count(k) >= 5:
                if k in seen:
                    continue
                seen.add(k)
            out.append(line)
        return "\n".join(out) if len("\n".join(out)) >= 0.75 * len(t) else t

    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.text for r in quality.repeated_lines(df, "text").collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)} and any(got[i] != texts[i] for i in got)


def test_sections_of_references_and_indexes(spark):
    refs = "Smith, A. (1999). One.\n  continued on a line\n[2] B. Jones 2001.\nJones, B. C. (2001). Two."
    index = "reef, 12, 14-15\nsand, see also shore\ntide, 3"
    text = f"Body.\n\n## 7. References\n{refs}\n\n## Appendix\nMore body.\n\nSubject Index\n{index}"
    prose = "Body.\n\nReferences\nwere checked by two people over the whole summer.\nThey agreed."
    df = spark.createDataFrame([(1, text), (2, prose), (3, None), (4, ""), (5, "Index\nno pages here")], "id int, text string")
    got = {r.id: r.text for r in quality.without_tail_references(df, "text").collect()}
    assert got == {1: "Body.\n\n## Appendix\nMore body.", 2: prose, 3: None, 4: "", 5: "Index\nno pages here"}


# --- chunks
def test_structured_chunks():
    table = "| a | b |\n| --- | --- |\n" + "\n".join(f"| row {i} | {'x' * 20} |" for i in range(40))
    text = f"# One\n\nIntro.\n\n## Two\n\n{table}\n\n## Three\n\n" + "\n".join(f"{i}. " + "word " * 30 for i in range(12)) + "\n\n# Four\n\nEnd."
    got = chunking.structured(text, 400)
    assert all(len(c) <= 400 for _, c in got)
    parts = [c for _, c in got if "| row" in c]
    assert len(parts) > 2 and all("| --- |" in c for c in parts) and sum(c.count("| row") for c in parts) == 40
    assert got[-1][0] == "Four" and got[-1][1].startswith("# Four") and not any(c.rstrip().split("\n")[-1].startswith("#") for _, c in got)
    assert "".join(sorted("\n".join(c for _, c in got).replace("| a | b |", "").replace("| --- | --- |", "").split())) == "".join(sorted(text.replace("| a | b |", "").replace("| --- | --- |", "").split()))
    assert chunking.structured(None, 100) == [] and chunking.structured("# only", 100) == [("only", "# only")]


@pytest.mark.parametrize("method", ["percentile", "standard_deviation", "interquartile", "gradient"])
def test_semantic_chunks(method):
    text = " ".join(["The reef is wet."] * 4 + ["Kernels run code."] * 4)
    got = chunking.semantic(text, chunking.hashed_vectors, method, {"standard_deviation": 1.0}.get(method))
    assert " ".join(got) == text and len(got) >= 2
    assert chunking.semantic(text, None, size=40) == chunking.recursive(text, 40, 0) and max(map(len, chunking.semantic(text * 9, chunking.hashed_vectors, size=50))) <= 50
    with pytest.raises(ValueError):
        chunking.semantic(text, chunking.hashed_vectors, "other")


def test_chunkers_are_registered():
    chunking.register("lines", lambda text, most=3: text.split("\n")[:most], replace=True)
    assert chunking.registry()["lines"]("a\nb") == ["a", "b"]
    for bad in (("recursive", str.split), ("two", lambda a, b: []), ("none", lambda: []), ("", str.split), ("key", lambda t, *, k: [])):
        with pytest.raises(ValueError):
            chunking.register(*bad)


def test_options_choose_the_chunker(spark, rows):
    d = spark.createDataFrame([(1, "# A\n\none", "P!"), (2, "a" * 25, None), (3, "one. two", "r"), (4, None, "V")], "id int, text string, options string")
    got = rows(chunking.by_option(d, "id", "text", "options", 10, 0), "id", "chunker", "chunk_order_index", "skip_graph")
    assert got == [(1, "structured", 0, True), (2, "fixed", 0, False), (2, "fixed", 1, False), (2, "fixed", 2, False), (3, "recursive", 0, False)]


def test_tables_and_their_surroundings(spark):
    d = spark.createDataFrame([("a", "Before it. Near.\n| x | y |\n| --- | --- |\n| 1 | 2 |\nAfter it. Far."), ("b", "a | b alone"), ("c", None)], "id string, text string")
    got = chunking.table_context(d, "id", "text", 24).collect()
    assert [(r.id, r.item, r.rows, r.leading, r.trailing, r.table) for r in got] == [("a", 1, 2, "Near.", "After it.", "| x | y |\n| --- | --- |")]


# --- merges
def test_first_and_last_of_a_hub(spark):
    df = spark.range(20_000).select(F.lit("hub").alias("k"), F.concat(F.lit("v"), F.col("id") % 5000).alias("v"), F.col("id").alias("p"))
    first = merge.first_n(df, ["k"], "v", "p", "out", 3).first()
    assert (first.out, first.out_n) == (["v0", "v1", "v2"], 5000)
    assert merge.first_n(df, ["k"], "v", "p", "out", 2, last=True).first().out == ["v4998", "v4999"]


def test_summaries_in_batches(spark):
    rows_ = [("a", "x" * n, n) for n in range(1, 60)] + [("b", "one", 1)] + [("c", "y" * 9000, 1), ("c", "z" * 9000, 2), ("c", "w", 3)]
    df = spark.createDataFrame(rows_, "name string, text string, place long")
    b = merge.batches(df, ["name"], 100)
    sizes = {(r.name, r.batch): (r.n, r.chars) for r in b.groupBy("name", "batch").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()}
    last = {name: max(k for m, k in sizes if m == name) for name in "abc"}
    assert all(n >= 2 for (name, k), (n, _) in sizes.items() if k != last[name])
    assert {r.name: len(r.summary) for r in merge.summarised(df, ["name"], most=100).collect()} == {"a": 59, "b": 3, "c": 9000}


def test_rebuild_keeps_what_survives(spark, rows):
    c = [f"doc-{x * 32}-chunk-000" for x in "abc"]
    r = spark.createDataFrame([("n", "t", "d1", c[0], "f1", 1), ("n", "u", "d2", c[1], "f2", 2), ("n", "u", "d3", "<SEP>".join(c[1:]), "f3", 3), ("lost", "old", "gone", c[0], "f1", 4)], "name string, type string, description string, source_id string, file_path string, pos long")
    live = spark.createDataFrame([(x,) for x in c[1:]], "id string")
    e = spark.createDataFrame([("lost", "from its edge", 9)], "name string, description string, pos long")
    got = rows(merge.rebuilt_entities(r, live, e, 200, 1), "name", "type", "description", "source_id", "file_path", "survived")
    assert got == [("lost", "old", "from its edge", "", "", False), ("n", "u", "d2<SEP>d3", "<SEP>".join(c[1:]), "f2<SEP>...truncated...(KEEP 1/2)", True)]


# --- graph
def test_edits_and_creation(spark, rows):
    p = spark.createDataFrame([("a", "b", 1.0, "s1<SEP>s2"), ("a", "c", None, None)], "a string, b string, weight double, source_id string")
    edits = spark.createDataFrame([("a", "b", 1.5), ("a", "c", 0.5)], "a string, b string, weight double")
    assert rows(graph.edited(p, edits)) == [("a", "b", 1.0, "refused"), ("a", "c", 0.5, "edited")]
    n = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    asked = spark.createDataFrame([("b", "a"), ("b", "c"), ("a", "a"), ("a", "x"), (None, "a")], "src_id string, tgt_id string")
    assert rows(graph.created(n, p, asked)) == [("a", "a", "self-loop"), ("a", "x", "endpoint missing"), ("b", "a", "exists"), ("b", "c", "created")]


# --- citations
def test_long_lists_meet_block_by_block(spark, rows, monkeypatch):
    df = spark.createDataFrame([("l", i) for i in range(40)] + [("m", 1), ("m", 2), ("m", 2)], "list_id string, item long")
    whole = rows(citation.coupling(df))
    monkeypatch.setattr(citation, "LIST_BLOCK", 7)
    assert rows(citation.coupling(df)) == whole and len(whole) == 780


def test_works_by_author_and_year(spark, rows):
    schema = "paper_id string, pub_year int, authors array<struct<author_id string, display_name string>>"
    p = spark.createDataFrame([("1", 2001, [("x", "A. Müller"), ("y", "B. Ito")]), ("2", 2000, [("y", "B. Ito"), ("x", "Muller, A.")]), ("3", 1990, [("x", "Anna Muller")]), ("4", None, None)], schema)
    assert rows(citation.find_works(p, ["Müller"], 2001)) == [("1", 3)]
    assert rows(citation.find_works(p, ["muller", "ito"], 2001)) == [("1", 4)]
    assert rows(citation.find_works(p, ["muller"], None)) == [("1", 2), ("2", 1), ("3", 2)]
    assert rows(citation.find_works(p, ["muller"], 1991)) == [("3", 2)]
    many = spark.createDataFrame([(f"{i}", 2001, [("x", "A Reef")]) for i in range(10)], schema)
    assert citation.find_works(many, ["reef"], 2001).count() == 0


def test_cited_works(spark, rows):
    c = spark.createDataFrame([("As Smith 1999 and Smith and Jones (1999) say, so Smith et al. 1999.",), ("Brown, 2000. Smith 1999",), (None,)], "content string")
    w = spark.createDataFrame([("w1", ["Smith", "Jones"], 1999), ("w2", ["Smith"], 1999), ("w3", ["Brown"], 2001)], "work string, surnames array<string>, year int")
    assert rows(citation.cited_works(c, w, 5), "work", "mentions") == [("w1", 4), ("w2", 3)]
    many = w.unionByName(spark.createDataFrame([(f"x{i}", ["Smith"], 1999) for i in range(3)], w.schema))
    assert rows(citation.cited_works(c, many, 5), "work", "mentions") == [("w1", 1)]


# --- retrieval
def test_modes():
    assert retrieval.routed("local", [], ["h"]) == (["h"], []) and retrieval.routed("global", ["l"], []) == ([], ["l"]) and retrieval.routed("mix", ["l"], ["h"]) == (["l"], ["h"]) and retrieval.routed("naive", ["l"], ["h"]) == ([], [])
    with pytest.raises(ValueError):
        retrieval.routed("bypass", [], [])


def test_post_processing_in_its_order(spark):
    rows_ = [("a", 0, "w1", "reef tide"), ("b", 1, "w1", "reef"), ("c", 2, "w2", "nothing"), ("d", 3, "w3", "tide"), ("e", 4, "w1", "reef tide sand"), ("f", 5, "w4", None)]
    c = spark.createDataFrame(rows_, "id string, pos int, work string, content string")
    run = lambda **k: [r.id for r in retrieval.processed(c, ["reef", "tide", "the"], k.pop("top", 9), k.pop("budget", 999), **k).orderBy("pos").collect()]
    assert run() == ["a", "e", "b", "d", "c"] and run(floor=0.1) == ["a", "e", "b", "d"] and run(per_work_most=1) == ["a", "d", "c"]
    pins = spark.createDataFrame([("w3",)], "work string")
    assert run(pins=pins) == ["d", "a", "e", "b", "c"] and run(top=2) == ["a", "e"] and run(budget=10) == ["a"] and run(budget=0) == []


def test_common_terms_give_no_candidates(spark):
    c = spark.createDataFrame([(f"{i}", "reef " + ("tide" if i < 2 else "")) for i in range(20)], "id string, content string")
    assert [r.id for r in retrieval.lexical(c, ["reef", "tide", "the"], 9, cap=5).orderBy("pos").collect()] == ["0", "1"]
    assert retrieval.lexical(c, ["reef"], 9, cap=5).count() == 0 and retrieval.lexical(c, ["the"], 9).count() == 0


# --- time joins
def test_as_of_against_brute_force(spark):
    rng = random.Random(1)
    at = lambda: T(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 600))
    left = [(i, rng.choice("aab"), at()) for i in range(120)] + [(900, None, at()), (901, "a", None)]
    right = [(i, rng.choice("aab"), at(), i * 1.0) for i in range(80)] + [(700, "a", None, 1.0)]
    l, r = spark.createDataFrame(left, "id int, k string, ts timestamp_ntz"), spark.createDataFrame(right, "rid int, k string, ts timestamp_ntz, v double")
    got = {x.id: x.v for x in timejoins.as_of(l, r, "k", "ts", "v", "rid").collect()}
    want = {i: max(((t2, rid, v) for rid, k2, t2, v in right if k2 == k and t2 and t and t2 <= t), default=(0, 0, None))[2] for i, k, t in left}
    assert got == want
    assert timejoins.as_of(l.limit(0), r, "k", "ts", "v", "rid").count() == 0
    both = {(x.id, x.other) for x in timejoins.interval(l.select("id", "k", "ts"), r.select(F.col("rid").alias("id"), "k", "ts"), "k", "ts", 1800, "id").collect()}
    assert both == {(i, rid) for i, k, t in left for rid, k2, t2, _ in right if k == k2 and t and t2 and dt.timedelta(0) <= t2 - t <= dt.timedelta(minutes=30)}


def test_histograms_and_rollups(spark, rows):
    d = spark.createDataFrame([("a", 1.0), ("a", 5.0), (None, 9.0), ("b", None)], "k string, v double")
    assert rows(timejoins.histogram(d, "v", [2.0, 9.0])) == [(0, 1), (1, 1), (2, 1)]
    assert rows(timejoins.rolled_up(d, "k")) == [("a", 0, 2), ("b", 0, 1), (None, 0, 1), (None, 1, 4)]


def test_paths_follow_live_chunks(spark, rows):
    c = [f"doc-{x * 32}-chunk-000" for x in "abc"]
    r = spark.createDataFrame([(1, f"{c[0]}<SEP>{c[1]}<SEP>free", "old"), (2, f"{c[0]}<SEP>{c[2]}", "old"), (3, c[1], "old"), (4, None, None)], "gid int, source_id string, file_path string")
    live = spark.createDataFrame([(c[1],), (c[2],)], "id string")
    files = spark.createDataFrame([("doc-" + "b" * 32, "b.pdf"), ("doc-" + "c" * 32, None)], "doc string, file string")
    got = rows(maintenance.live_paths(r, live, files, r"^doc-[0-9a-f]{32}-chunk-[0-9]+$", "gid"))
    assert got == [(1, f"{c[1]}<SEP>free", "b.pdf", 1), (2, c[2], "old", 1), (3, c[1], "old", 0), (4, None, None, 0)]
