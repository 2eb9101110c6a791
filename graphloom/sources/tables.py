"""Parquet tables of the library: reading them, and dropping rows that were sent twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Key of each table whose rows may arrive twice (the copies are identical and count once).
KEYS = {
    "doc_status": ["id"],
    "text_chunks": ["id"],
    "papers": ["paper_id"],
    "graph_nodes": ["gid"],
    "graph_edges": ["gid"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table as it was sent."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unique(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The chosen columns of a table with rows that were sent twice counted once. The key is always among the columns;
    rows whose key is null are kept apart by their content."""
    key = KEYS[name]
    wanted = list(dict.fromkeys([*key, *columns])) if columns else table(spark, sf_dir, name).columns
    return table(spark, sf_dir, name).select(*wanted).distinct()
