"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import encode, markup, mixture, names, neighbours, personal, scans, splitter
from graphloom.session import cut
from graphloom.sources.tables import table, unique

LIMIT, OVERLAP = 480, 32


def _pieces(spark: SparkSession, d: str) -> DataFrame:
    chunks = unique(spark, d, "text_chunks", "full_doc_id", "chunk_order_index", "content")
    return splitter.split(chunks, limit=LIMIT, overlap=OVERLAP)


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All chunks as pieces within the limit, with fresh chunk_order_index and their own sizes in tokens."""
    p = splitter.fresh_index(_pieces(spark, d))
    return p.select(F.col("id").alias("chunk_id"), "full_doc_id", "chunk_order_index", "piece", "start", F.ceil(F.length("content") / 4).cast("int").alias("tokens"), "content")


def p1_coverage(spark: SparkSession, d: str) -> DataFrame:
    """What the pieces of each chunk hold of it: its characters without the overlaps, whether no piece is above the limit, no overlap
    above its own limit, and none missing between two pieces of a long text."""
    p = _pieces(spark, d).where("content is not null")
    ends = p.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("p"))
    repeated = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.col("p")[i - 1]["end"] - F.col("p")[i]["start"])
    ends = ends.withColumn("over", F.when(F.size("p") > 1, repeated).otherwise(F.array().cast("array<int>")))
    size = F.aggregate("p", F.lit(0), lambda a, x: a + x["end"] - x["start"])
    return ends.select(
        F.col("id").alias("chunk_id"), (size - F.aggregate("over", F.lit(0), lambda a, x: a + x)).cast("long").alias("n_chars"), (F.size("p") > 1).alias("was_cut"),
        F.forall("p", lambda x: x["end"] - x["start"] <= LIMIT * 4).alias("within_limit"), F.forall("over", lambda x: (x > 0) & (x <= OVERLAP * 4)).alias("overlap_ok"),
    )


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that the splitter had to cut."""
    p = splitter.split(table(spark, d, "text_chunks").select("id", "content"), limit=LIMIT, overlap=OVERLAP)
    return p.where("piece = 0 and n_pieces > 1").select(F.col("id").alias("chunk_id")).distinct()


def _named(spark: SparkSession, d: str) -> DataFrame:
    """tbl, id, name, kind of every author and of every node that is a person or an organisation."""
    authors = table(spark, d, "papers").select(F.explode("authors").alias("a")).select(F.lit("papers").alias("tbl"), F.col("a.author_id").alias("id"), F.col("a.display_name").alias("name"))
    authors = authors.where("id is not null").distinct().withColumn("kind", F.lit("person"))

    @F.pandas_udf("string")
    def kind(ids: pd.Series, types: pd.Series) -> pd.Series:
        return pd.Series([names.kind_of(i, t) for i, t in zip(ids, types, strict=True)], dtype=object)

    nodes = table(spark, d, "graph_nodes").where("id is not null").select(F.lit("graph_nodes").alias("tbl"), "id", F.col("id").alias("name"), kind("id", "entity_type").alias("kind"))
    return authors.unionByName(nodes.where("kind is not null").distinct())


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of ids that are spellings of one person or organisation."""
    return names.links(_named(spark, d))


def p2_members(spark: SparkSession, d: str) -> DataFrame:
    """The representative (folded name) of each author and node."""
    return names.members(_named(spark, d)).select("tbl", "id", "rep")


def p2_variants(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of representatives that are spellings of one person or organisation; with p2_members they hold all links."""
    return names.variants(_named(spark, d))[1]


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.convert(table(spark, d, "text_chunks").select("id", "content"))


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk's clean text and the markup language it came in (null for plain text)."""
    return markup.convert(unique(spark, d, "text_chunks", "content")).select(F.col("id").alias("chunk_id"), "kind", F.col("clean").alias("content"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Chunks that held markup. Only the ids are shuffled, to count rows that were sent twice once."""
    return _clean(spark, d).where("kind is not null").select(F.col("id").alias("chunk_id"), "kind").distinct()


def _near(spark: SparkSession, d: str) -> DataFrame:
    seq = F.get_json_object("record", "$.__write_seq__")
    return neighbours.neighbours(table(spark, d, "faiss_docs").select("id", "record", "vector"), seq=seq)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of which one is among the five most similar of the other, with a cosine of 0.8 or more."""
    return neighbours.pairs(_near(spark, d))


def p4_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The five most similar others of every id, with their cosines."""
    return _near(spark, d)


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    """id, doc, content of every chunk once, in a table: several passes read the texts, and their work is far more than their bytes,
    so the number of partitions is given and not merged by size."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return cut(table(spark, d, "text_chunks").select("id", F.col("full_doc_id").alias("doc"), "content").repartition(n, "id").distinct())


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of scanning noise of each chunk. Counts hold rows that were sent twice once."""
    return scans.kinds(_scanned(spark, d)).select(F.col("id").alias("chunk_id"), "kind")


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk as continuous paragraphs."""
    return scans.repair(_scanned(spark, d)).select(F.col("id").alias("chunk_id"), F.col("clean").alias("content"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return encode.encode(table(spark, d, "documents").select("doc_id", "text"), "doc_id")


def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    # three columns of sizes, read by the plan, the running sums and the report: counted once
    sized = cut(encode.count_tokens(table(spark, d, "documents").where("source is not null").select("doc_id", "source", "text")).drop("text"))
    targets = table(spark, d, "mix_targets")
    return mixture.mixture(sized, targets), targets


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """The mixture in training order, one row for each use of a document."""
    return mixture.ordered(_mixture(spark, d)[0])


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares reached, per source."""
    return mixture.shares(*_mixture(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Personal details of every document."""
    f = personal.scan(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.explode("details").alias("x"))
    # numbers of accounts are replaced too, but are none of the kinds asked for
    return f.where("x.kind <> 'account'").select("doc_id", "x.kind", "x.item").distinct()


def p10_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every document with its details replaced by placeholders."""
    return personal.scan(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.col("clean").alias("text"))


QUERIES = {"p1_found": p1_found, "p1_pieces": p1_pieces, "p1_coverage": p1_coverage, "p2_found": p2_found, "p2_members": p2_members, "p2_variants": p2_variants, "p3_found": p3_found, "p3_clean": p3_clean, "p4_found": p4_found, "p4_neighbours": p4_neighbours, "p6_found": p6_found, "p6_clean": p6_clean, "p8_ids": p8_ids, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p10_found": p10_found, "p10_clean": p10_clean}
SQL = {
    "p1_found": "SELECT DISTINCT id AS chunk_id FROM text_chunks WHERE length(content) > 1920",
    "p1_coverage": """SELECT chunk_id, n_chars, n_chars > 1920 AS was_cut, true AS within_limit, true AS overlap_ok FROM (
        SELECT DISTINCT id AS chunk_id, CAST(length(content) AS BIGINT) AS n_chars FROM text_chunks WHERE content IS NOT NULL)""",
}
