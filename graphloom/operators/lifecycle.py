"""Documents on their way through the engine: duplicates, states, pages, conflicts, deletion; key-value tables and their upserts.

Cases: null hashes and names are no duplicates; equal times are broken by the id; names that mean ``no name`` never conflict; an
upsert takes the last row of a key by its sequence, and a null key is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import strip

# The states of a document, and the names that stand for none.
STATES = ("pending", "parsing", "analyzing", "processing", "processed", "failed", "deleting")
NO_NAME = ("", "unknown_source", "no-file-path")
#: The states a state may go to.
MOVES = {"pending": ("parsing", "failed"), "parsing": ("analyzing", "failed"), "analyzing": ("processing", "failed"), "processing": ("processed", "failed"), "processed": (), "failed": ("pending",), "deleting": ()}
#: Every state may go to deleting, which is left by the row's end alone.
MOVES = {k: v if k == "deleting" else (*v, "deleting") for k, v in MOVES.items()}


def file_key(path: Column) -> Column:
    """The canonical file name: the base name in small letters, null for names that mean none."""
    name = F.lower(strip(F.regexp_extract(path, r"([^/\\]*)$", 1)))
    return F.when(~name.isin(*NO_NAME), name)


def duplicates(docs: DataFrame, key: Column) -> DataFrame:
    """(id, original): rows that repeat the key of an earlier one (by created_at, id). The earliest comes from an aggregation with
    map-side combine, so a key that a third of the rows share is one row per task."""
    d = docs.withColumn("_k", key).where("_k is not null")
    first = d.groupBy("_k").agg(F.min(F.struct("created_at", "id")).alias("f"))
    return d.join(first, "_k").where(F.col("id") != F.col("f.id")).select("id", F.col("f.id").alias("original"))


def enqueue(docs: DataFrame) -> DataFrame:
    """(id, state, original, rule): the first of each file name and content hash is pending; the others point to it."""
    by_name = duplicates(docs, file_key(F.col("file_path"))).withColumnRenamed("original", "n")
    by_hash = duplicates(docs, F.col("content_hash")).withColumnRenamed("original", "h")
    x = docs.select("id").join(by_name, "id", "left").join(by_hash, "id", "left")
    rule = F.when(F.col("n").isNotNull(), "name").when(F.col("h").isNotNull(), "hash")
    return x.select("id", F.when(rule.isNull(), "pending").otherwise("duplicate").alias("state"), F.coalesce("n", "h").alias("original"), rule.alias("rule"))


def may_move(old: Column, new: Column) -> Column:
    out = F.lit(False)
    for a, bs in MOVES.items():
        out = F.when(old == a, new.isin(*bs) if bs else F.lit(False)).otherwise(out)
    return out


def page_after(docs: DataFrame, states: list[str], created_at, ident: str, n: int) -> DataFrame:
    """The page of ``n`` rows of the states after a position, in the order created_at, id."""
    after = (F.col("created_at") > F.lit(created_at)) | ((F.col("created_at") == F.lit(created_at)) & (F.col("id") > ident))
    return docs.where(F.col("state").isin(*states) & after).orderBy("created_at", "id").limit(n)


def offset_page(docs: DataFrame, page: int, size: int, by: str = "updated_at") -> DataFrame:
    """A page by number, with the number of all rows as total: the size is held within 10 and 200, the field within the sortable ones."""
    size = min(200, max(10, size))
    by = by if by in ("created_at", "updated_at", "id", "file_path") else "updated_at"
    # one row
    total = docs.agg(F.count("*").alias("total"))
    return docs.orderBy(F.desc(by), "id").offset((max(1, page) - 1) * size).limit(size).join(F.broadcast(total))


def conflicts(docs: DataFrame, key: Column | None = None, sample: int = 5) -> DataFrame:
    """(name, n, ids): keys (file names, where none is given) of two rows or more, with the first ids. Pages of it follow by name."""
    d = docs.select("id", (file_key(F.col("file_path")) if key is None else key).alias("name")).where("name is not null")
    n = d.groupBy("name").agg(F.count("*").alias("n")).where("n > 1")
    w = Window.partitionBy("name").orderBy("id")
    ids = d.withColumn("r", F.row_number().over(w)).where(F.col("r") <= sample).join(n.select("name"), "name", "left_semi")
    return n.join(ids.groupBy("name").agg(F.sort_array(F.collect_list("id")).alias("ids")), "name")


def settled(docs: DataFrame, winners: DataFrame, key: Column) -> DataFrame:
    """(id, state, original) after conflicts are settled: rows of a key with a winner (name, winner) become duplicates that point to it;
    the winner and all other rows keep their state. A winner that bears another name settles nothing."""
    d = docs.select("id", "state", key.alias("name"))
    good = winners.join(d.select(F.col("id").alias("winner"), F.col("name").alias("_own")), "winner").where("name = _own").select("name", "winner")
    x = d.join(good, "name", "left")
    beaten = F.col("winner").isNotNull() & (F.col("winner") != F.col("id"))
    return x.select("id", F.when(beaten, "duplicate").otherwise(F.col("state")).alias("state"), F.when(beaten, F.col("winner")).alias("original"))


def after_deletion(tracking: DataFrame, doc: Column) -> DataFrame:
    """(id, kept, gone): tracked chunks of each object that stay when a document goes. tracking: id, chunk_ids."""
    of_doc = lambda x: F.substring(x, 1, 36) == doc
    return tracking.where(F.exists("chunk_ids", of_doc)).select("id", F.size(F.filter("chunk_ids", lambda x: ~of_doc(x))).alias("kept"), F.size(F.filter("chunk_ids", of_doc)).alias("gone"))


def upsert(old: DataFrame, new: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key by sequence."""
    whole = old.unionByName(new).where(F.col(key).isNotNull())
    rest = [c for c in whole.columns if c != key]
    return whole.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("x")).select(key, *(F.col(f"x.{c}").alias(c) for c in rest))


def missing_keys(asked: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    return asked.select(key).distinct().join(stored.select(key), key, "left_anti")


def merge_properties(old: Column, new: Column) -> Column:
    """Node properties merged key by key, the new value wins."""
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    keep = F.map_filter(F.coalesce(old, empty), lambda k, v: ~F.map_contains_key(F.coalesce(new, empty), k))
    return F.map_concat(keep, F.coalesce(new, empty))
