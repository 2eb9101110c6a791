"""The exact ranker against scores of all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from graphloom.operators import evaluation, topdocs


def brute(docs, queries, k):
    """docs: name to terms; queries: query to terms. The first k of each query."""
    tf = {n: Counter(t) for n, t in docs.items()}
    df = Counter(t for c in tf.values() for t in c)
    out = []
    for q, ts in queries.items():
        s = {n: sum((1 + math.log(c[t])) * (math.log((len(docs) + 1) / (df[t] + 1)) + 1) for t in set(ts) & set(c)) for n, c in tf.items() if set(ts) & set(c)}
        out += [(q, n, round(s[n], 6), i + 1) for i, n in enumerate(sorted(s, key=lambda n: (-round(s[n], 9), n))[:k])]
    return sorted(out)


def library(n, words, seed):
    """Documents of frequent and rare words, some of them many times."""
    r = random.Random(seed)
    often, rare = [f"w{i}" for i in range(words)], [f"rare{i}" for i in range(40)]
    return {f"d{i:05}": [w for w in r.sample(often, r.randint(0, words // 3)) + r.sample(rare, r.random() < 0.1) for _ in range(r.choice([1] * 20 + [2, 2, 3, 9]))] for i in range(n)}


@pytest.mark.parametrize("steps", [topdocs.STEPS, 2])
def test_blocks_give_the_best_documents(monkeypatch, steps):
    monkeypatch.setattr(topdocs, "STEPS", steps)
    docs, r = library(700, 24, 1), random.Random(2)
    words = sorted({w for t in docs.values() for w in t})
    at, tf = {w: i for i, w in enumerate(words)}, [(n, w, c) for n, t in docs.items() for w, c in Counter(t).items()]
    df = Counter(w for _, w, _ in tf)
    block = topdocs.Block(pa.chunked_array([pa.array([x[0] for x in tf])]), np.array([at[x[1]] for x in tf]), np.array([float(x[2]) for x in tf]))
    queries = {i: r.sample(words, r.choice([1, 2, 3, 4, 5, 14])) for i in range(120)}
    got = []
    for q, ts in queries.items():
        places, score = block.best([at[w] for w in ts] + [10**6], [math.log((len(docs) + 1) / (df[w] + 1)) + 1 for w in ts] + [1.0], 10)
        names = block.names.take(pa.array(places)).to_pylist()
        got += [(q, n, round(s, 6), i + 1) for i, (n, s) in enumerate(sorted(zip(names, score.tolist(), strict=True), key=lambda x: (-round(x[1], 9), x[0])))]
    assert sorted(got) == brute(docs, queries, 10)


def test_few_documents_are_scored(monkeypatch):
    """Queries of frequent words: most documents that hold one of them are never scored."""
    r, scored, n = np.random.default_rng(3), [], 20_000
    tf = r.random((12, n)) < 0.1
    term, doc = np.nonzero(tf)
    block = topdocs.Block(pa.chunked_array([pa.array(doc)]), term, 1.0 + (r.random(len(term)) < 0.05))
    own = topdocs.Block.scores
    monkeypatch.setattr(topdocs.Block, "scores", lambda self, terms, docs: scored.append(len(docs)) or own(self, terms, docs))
    for i in range(9):
        places, _ = block.best([i, i + 1, i + 2, i + 3], [1.0, 1.1, 1.2, 1.3], 10)
        assert len(places) == 10
    assert sum(scored) < 0.3 * sum(int(tf[i : i + 4].any(0).sum()) for i in range(9))


@pytest.mark.parametrize("block", [3_000_000, 2_000])
def test_ranker_equals_all_pairs(spark, block):
    docs, r = library(600, 18, 4), random.Random(5)
    words = sorted({w for t in docs.values() for w in t})
    queries = {f"q{i:03}": r.sample(words, r.randint(1, 6)) + ["unknown"] for i in range(60)}
    queries |= {f"same{i}": ["w1", "w2"] for i in range(3)} | {"none": ["unknown"]}
    d = spark.createDataFrame([(n, " ".join(t)) for n, t in docs.items()], "name string, text string")
    q = spark.createDataFrame([(k, " ".join(t)) for k, t in queries.items()], "query string, text string")
    got = evaluation.tfidf(d, q, 7, block)
    assert sorted((x.query, x.name, round(x.score, 6), x["rank"]) for x in got.collect()) == brute(docs, queries, 7)


def test_odd_rows(spark):
    """A query in two rows has each term once, documents of one name are one, and a document without a name comes last among equals."""
    d = spark.createDataFrame([(None, "reef survey"), (2, "reef"), (1, "reef"), (1, "glacier"), (3, None)], "name long, text string")
    q = spark.createDataFrame([("q", "reef glacier"), ("q", "reef"), (None, "survey reef")], "query string, text string")
    got = {(x.query, x["rank"]): (x.name, round(x.score, 9)) for x in evaluation.tfidf(d, q, 3).collect()}
    reef, other = math.log(6 / 4) + 1, math.log(6 / 2) + 1
    assert got == {("q", 1): (1, round(reef + other, 9)), ("q", 2): (2, round(reef, 9)), ("q", 3): (None, round(reef, 9)), (None, 1): (None, round(reef + other, 9)), (None, 2): (1, round(reef, 9)), (None, 3): (2, round(reef, 9))}
    assert evaluation.tfidf(d.where("text is null"), q, 3).count() == 0


def test_measures_equal_their_sql(spark, tmp_path):
    """Papers and documents in several rows: each expected pair counts once, and the measures are those of the SQL."""
    duckdb = pytest.importorskip("duckdb")
    from graphloom.plans import library_queries as plans

    r, docs = random.Random(6), library(300, 18, 7)
    d = [(i, " ".join(t), f"K{r.randint(0, 30)}") for i, t in enumerate(docs.values())] + [(1, "w1 w2", "K1"), (1, "w3", "K1"), (None, "w1", "K2"), (400, None, "K3")]
    p = [(f"p{i}", " ".join(f"w{r.randint(0, 17)}" for _ in range(3)), f"K{r.randint(0, 34)}") for i in range(40)]
    p += [("p1", "w1 w4", "K1"), ("p1", "w4", "K1"), ("p1", "w4", "K2"), ("p2", None, "K4"), (None, "w5", "K5"), ("p3", "w6", None)]
    con = duckdb.connect()
    for name, data, columns in (("documents", d, "doc_id long, text string, item_key string"), ("papers", [(*x, None, None, []) for x in p], "paper_id string, title string, attachment_key string, venue string, pub_year int, authors array<string>")):
        spark.createDataFrame(data, columns).write.parquet(f"{tmp_path}/{name}.parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(plans.SQL["e03_measures"]).fetchall()[0]
    got = plans.e03_measures(spark, str(tmp_path)).select("queries", "recall", "mrr", "full", "none").first()
    assert want[0] > 30 and 0 < want[1] < 1
    assert tuple(got) == pytest.approx(want, abs=1e-9)
    rank = {(x.query, x["rank"]): x.name for x in plans.e01_tfidf(spark, str(tmp_path)).collect()}
    assert rank == {(q, i): n for q, n, _, i in con.sql(plans.SQL["e01_tfidf"]).fetchall()}
