"""External functions with deterministic stand-ins: embedding, reranking, keyword extraction and record extraction.

Each is a callable over a batch; a caller passes another one to use a model. Equal inputs are computed once and joined back.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def hash_embedding(texts: list[str], dim: int = 64) -> np.ndarray:
    """Words hashed into signed buckets, unit length."""
    out = np.zeros((len(texts), dim))
    for i, t in enumerate(texts):
        for w in re.findall(r"\w+", (t or "").lower()):
            h = zlib.crc32(w.encode())
            out[i, h % dim] += 1 if h & 1 << 20 else -1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def overlap_rerank(query: str, texts: list[str]) -> list[float]:
    """Share of the query's words in each text."""
    q = set(re.findall(r"\w+", query.lower()))
    return [len(q & set(re.findall(r"\w+", (t or "").lower()))) / max(1, len(q)) for t in texts]


def embed(df: DataFrame, text: str, out: str = "vector", function=hash_embedding) -> DataFrame:
    """Adds the embedding of a text column; each distinct text is embedded once."""

    @F.pandas_udf("array<float>")
    def work(texts: pd.Series) -> pd.Series:
        return pd.Series(list(function(texts.fillna("").tolist()).astype("float32")))

    once = df.select(text).where(F.col(text).isNotNull()).distinct().withColumn(out, work(F.col(text)))
    return df.join(once, text, "left")


def rerank(df: DataFrame, query: str, text: str, out: str = "rerank_score", function=overlap_rerank, failed: str | None = None) -> DataFrame:
    """Adds a score; where a function fails the scores of its batch are null, and the order before stays. ``failed`` names a column that
    tells so, for a count of it."""

    @F.pandas_udf("struct<score double, failed boolean>")
    def work(texts: pd.Series) -> pd.DataFrame:
        try:
            return pd.DataFrame({"score": pd.Series(function(query, texts.tolist()), dtype="float64"), "failed": False})
        except Exception:  # noqa: BLE001 - a model's failure must not fail the query
            return pd.DataFrame({"score": pd.Series([None] * len(texts), dtype="float64"), "failed": True})

    scored = df.withColumn("_r", work(F.col(text))).withColumn(out, F.col("_r.score"))
    return (scored.withColumn(failed, F.col("_r.failed")) if failed else scored).drop("_r")


def rare_keywords(questions: DataFrame, texts: DataFrame, key: str, question: str, text: str, n: int = 5) -> DataFrame:
    """(key, word, rank): the n words of each question (letters, three or more) that the fewest texts hold, ties by the word. Counts are
    those of the questions' words alone."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z]{3,})"), 1))
    q = questions.where(F.col(question).isNotNull()).select(key, F.explode(words(F.col(question))).alias("word")).distinct()
    df = texts.where(F.col(text).isNotNull()).select(F.explode(words(F.col(text))).alias("word")).join(q.select("word").distinct(), "word", "left_semi").groupBy("word").agg(F.count("*").alias("df"))
    w = Window.partitionBy(key).orderBy("df", "word")
    return q.join(df, "word", "left").na.fill(0, ["df"]).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select(key, "word", "rank")


def rule_extractor(text: str) -> str:
    """Capitalised names as entities and their neighbours as relations, in the delimited form."""
    names = list(dict.fromkeys(m for m in re.findall(r"\b[A-Z][a-z]{5,}\b", text or "")))
    out = [f"(entity<|#|>{n}<|#|>concept<|#|>{n} stands in the text)" for n in names]
    out += [f"(relation<|#|>{a}<|#|>{b}<|#|>near<|#|>{a} stands near {b})" for a, b in zip(names, names[1:], strict=False)]
    return "\n".join(out) + "\n<|COMPLETE|>"


def extract(chunks: DataFrame, cache: DataFrame | None = None, function=rule_extractor, most_tokens: int = 12_000, passes: int = 1) -> DataFrame:
    """(id, pass, reply) for chunks (id, content): replies of the cache (digest, pass, reply) are taken, others computed. Every text
    has its first pass; those beyond the token bound have no further ones."""
    x = chunks.where("content is not null").select("id", "content", F.md5("content").alias("digest")).withColumn("pass", F.explode(F.sequence(F.lit(1), F.lit(passes))))
    x = x.where((F.col("pass") == 1) | (F.length("content") <= most_tokens))
    known = x.join(cache, ["digest", "pass"]).select("id", "pass", "reply") if cache is not None else None
    todo = x.join(cache, ["digest", "pass"], "left_anti") if cache is not None else x

    @F.pandas_udf("string")
    def work(texts: pd.Series) -> pd.Series:
        return texts.map(function)

    fresh = todo.select("id", "pass", work("content").alias("reply"))
    return fresh if known is None else known.unionByName(fresh)
