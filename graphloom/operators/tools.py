"""Tools of an agent over the library: thin compositions of the operators, each a DataFrame.

find (labels), passages, search, related, topics and connect are the operators themselves; note enqueues a text like any document;
equations, tables and health look at the stored tables. Cases: null texts hold nothing; empty tables have zero rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import strip
from graphloom.operators import chunking, citation, graph, lifecycle

EQUATION = r"(?s)\\begin\{equation\}(.*?)\\end\{equation\}"


def find(nodes: DataFrame, query: str, n: int = 20) -> DataFrame:
    return graph.search_labels(nodes, query, n)


def related(cites: DataFrame, coupled: DataFrame, authors: DataFrame, years: DataFrame, paper: int, n: int = 20) -> DataFrame:
    return citation.related(cites, coupled, authors, years, paper, n)


def connect(links: DataFrame, start: int, target: int, k: int = 3, hops: int = 6) -> DataFrame:
    return citation.cheapest_paths(links, start, target, k, hops)


def topics(tree: DataFrame, query: str) -> DataFrame:
    return citation.topic_search(tree, query)


def equations(chunks: DataFrame, key: str, text: str) -> DataFrame:
    """(key, item, formula): display formulas of texts in their order, from 1."""
    x = chunks.where(F.col(text).isNotNull()).select(key, F.posexplode(F.regexp_extract_all(text, F.lit(EQUATION), 1)).alias("i", "f"))
    return x.select(key, (F.col("i") + 1).alias("item"), strip(F.col("f")).alias("formula"))


def tables(chunks: DataFrame, key: str, text: str, budget: int = 2000) -> DataFrame:
    return chunking.table_context(chunks, key, text, budget)


def note(docs: DataFrame, text: str, title: str) -> DataFrame:
    """The documents with a note added, enqueued by the rules of every document."""
    spark = docs.sparkSession
    one = spark.createDataFrame([(text, f"{title}.md")], "content string, file_path string").select(
        F.concat(F.lit("doc-"), F.md5("content")).alias("id"), "file_path", F.md5("content").alias("content_hash"), F.current_timestamp().cast("timestamp_ntz").alias("created_at")
    )
    return lifecycle.enqueue(docs.select("id", "file_path", "content_hash", "created_at").unionByName(one))


def health(tables_: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(tbl, rows, keys, null_keys) of tables by name, each with its key."""
    whole = None
    for name, (df, key) in tables_.items():
        x = df.agg(F.count("*").alias("rows"), F.count_distinct(key).alias("keys"), F.coalesce(F.sum(F.col(key).isNull().cast("long")), F.lit(0)).alias("null_keys")).select(F.lit(name).alias("tbl"), "rows", "keys", "null_keys")
        whole = x if whole is None else whole.unionByName(x)
    return whole
