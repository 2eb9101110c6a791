"""Grouped merges of extraction records into entities and relations.

Every rule that speaks of a first or last record works on an explicit position, never on arrival order. Records of one name go
through one aggregation with map-side combine. Where a rule caps a list, only the capped part is ever collected: values are
deduplicated with their first position, the first N of a group are found as partial top-Ns before the shuffle, and those alone
become an array, so that a hub that holds a third of all records is N values a task. Long lists of descriptions are summarised
in batches of a bounded size, level by level.

Cases: null or blank names, types, sources and files are skipped; a name with no description gets ``Entity {name}``; equal
texts count once; ties go to the earlier position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import SEP, evidence, parts, strip
from graphloom.session import cut

SOURCE_CAP, FILE_CAP = 200, 75
#: A joined description list of fewer texts and tokens than these needs no summary.
SUMMARY_TEXTS, SUMMARY_TOKENS, BATCH_TOKENS = 8, 1200, 12_000


def gleaned(records: DataFrame, keys: list[str]) -> DataFrame:
    """Of the passes over one chunk, the one with the longer description; ties to the earlier pass."""
    rest = [c for c in records.columns if c not in keys]
    best = records.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.coalesce(F.length("description"), F.lit(0)), -F.col("pass"))).alias("x"))
    return best.select(*keys, *(F.col(f"x.{c}").alias(c) for c in rest))


def type_vote(records: DataFrame, name: str = "name", kind: str = "type", pos: str = "pos") -> DataFrame:
    """(name, type): the most frequent type, ties to the first seen."""
    votes = records.where(F.col(kind).isNotNull() & (strip(F.col(kind)) != "")).groupBy(name, kind).agg(F.count("*").alias("n"), F.min(pos).alias("first"))
    return votes.groupBy(name).agg(F.max_by(kind, F.struct("n", -F.col("first"))).alias(kind))


def ordered_distinct(df: DataFrame, keys: list[str], value: str, pos: str, out: str) -> DataFrame:
    """The distinct values of each group in the order of their first position, as an array."""
    first = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(pos).alias("_p"))
    return first.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_p", value))), lambda x: x[value]).alias(out))


def first_n(df: DataFrame, keys: list[str], value: str, pos: str, out: str, n: int, last: bool = False) -> DataFrame:
    """The first (or last) ``n`` distinct values of each group in the order of their first position, as an array, and their whole
    number as ``out`` with ``_n`` behind it. Spark cuts each group to n rows before the shuffle that gathers it."""
    first = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(pos).alias("_p"))
    order = [F.desc("_p"), F.desc(value)] if last else [F.asc("_p"), F.asc(value)]
    kept = first.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= n)
    lists = kept.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("_p", value))), lambda x: x[value]).alias(out))
    return lists.join(first.groupBy(*keys).agg(F.count("*").alias(f"{out}_n")), keys)


def source_ids(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """(keys, source_ids): the joined source lists of a group flattened, trimmed, blanks dropped, in first-seen order."""
    flat = df.select(*keys, pos, F.posexplode(parts(F.col("source_id"))).alias("_i", "_s")).withColumn("_o", F.struct(pos, "_i"))
    return ordered_distinct(flat, keys, "_s", "_o", "source_ids")


def capped(ids: Column, cap: int, keep: str = "KEEP") -> Column:
    """KEEP: the first ``cap``; FIFO: the last."""
    return F.slice(ids, 1, cap) if keep == "KEEP" else F.when(F.size(ids) > cap, F.slice(ids, -cap, cap)).otherwise(ids)


def capped_files(files: Column, cap: int = FILE_CAP, keep: str = "KEEP") -> Column:
    """Unique files in order, cut to the cap with a note of the rule that cut them."""
    note = "...truncated...(KEEP Old)" if keep == "KEEP" else "...truncated...(FIFO)"
    cut = F.concat(capped(files, cap, keep), F.array(F.lit(note)))
    return F.when(F.size(files) > cap, cut).otherwise(files)


def descriptions(df: DataFrame, keys: list[str], pos: str, time: str) -> DataFrame:
    """(keys, texts): distinct descriptions (first kept) in the order of time, longer first."""
    d = df.where(F.col("description").isNotNull() & (strip(F.col("description")) != ""))
    first = d.groupBy(*keys, "description").agg(F.min(F.struct(time, pos)).alias("_p"))
    order = F.struct(F.col(f"_p.{time}").alias("t"), (-F.length("description")).alias("l"), F.col(f"_p.{pos}").alias("p"), "description")
    return first.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(order)), lambda x: x["description"]).alias("texts"))


def summary(texts: Column, name: Column) -> tuple[Column, Column]:
    """(joined description, whether a summary function must shorten it)."""
    joined = F.array_join(texts, SEP)
    size = F.aggregate(texts, F.lit(0), lambda a, x: a + F.length(x))
    long_ = (F.size(texts) > 1) & ((F.size(texts) >= SUMMARY_TEXTS) | (size >= SUMMARY_TOKENS))
    return F.when(F.coalesce(F.size(texts), F.lit(0)) <= 0, F.concat(F.lit("Entity "), name)).otherwise(joined), F.coalesce(long_, F.lit(False))


def description_rows(df: DataFrame, keys: list[str], pos: str, time: str) -> DataFrame:
    """(keys, text, place): distinct descriptions (first kept), with a place in the order of time, longer first."""
    d = df.where(F.col("description").isNotNull() & (strip(F.col("description")) != ""))
    first = d.groupBy(*keys, F.col("description").alias("text")).agg(F.min(F.struct(time, pos)).alias("_p"))
    return first.select(*keys, "text", F.struct(F.col(f"_p.{time}").alias("t"), (-F.length("text")).alias("l"), F.col(f"_p.{pos}").alias("p")).alias("place"))


def longest(texts: Column) -> Column:
    """The summary of a batch where no function is given: its longest text, the first of equals. texts: array of (place, text)."""
    return F.array_max(F.transform(texts, lambda x, i: F.struct(F.length(x["text"]).alias("n"), (-i).alias("i"), x["text"].alias("text"))))["text"]


def batches(rows: DataFrame, keys: list[str], most: int = BATCH_TOKENS) -> DataFrame:
    """Adds batch to (keys, text, place): texts in order, two by two, fill batches of so many tokens; every batch has two texts at least, but
    for a last one that has no partner."""
    w = Window.partitionBy(*keys).orderBy("place")
    size = F.length("text")
    before = F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    second = (F.row_number().over(w) - 1) % 2
    return rows.withColumn("batch", F.floor((before - second * F.coalesce(F.lag(size).over(w), F.lit(0))) / most))


def summarised(rows: DataFrame, keys: list[str], summarise=longest, most: int = BATCH_TOKENS, rounds: int = 64) -> DataFrame:
    """(keys, summary) of descriptions (keys, text, place) by levels of batches: each level at least halves a group, and no batch holds
    more than ``most`` tokens and one text."""
    several = lambda r: (r.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > 1
    while rounds and several(rows):
        level = batches(rows, keys, most).groupBy(*keys, "batch").agg(F.sort_array(F.collect_list(F.struct("place", "text"))).alias("t"))
        rows = cut(level.select(*keys, F.when(F.size("t") == 1, F.col("t")[0]["text"]).otherwise(summarise(F.col("t"))).alias("text"), F.col("t")[0]["place"].alias("place")))
        rounds -= 1
    return rows.select(*keys, F.col("text").alias("summary"))


def entities(records: DataFrame, summarise=longest) -> DataFrame:
    """Entities of records (name, type, description, source_id, file_path, pos, time).

    Few and short descriptions are joined; those of SUMMARY_TEXTS texts or SUMMARY_TOKENS tokens and more are summarised in batches,
    and never stand in one row."""
    r = records.where(F.col("name").isNotNull() & (strip(F.col("name")) != ""))
    told = cut(description_rows(r, ["name"], "pos", "time"))
    # the other rules read four columns several times
    r = cut(r.select("name", "type", "source_id", "file_path", "pos"))
    size = told.groupBy("name").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    size = size.select("name", ((F.col("n") > 1) & ((F.col("n") >= SUMMARY_TEXTS) | (F.col("chars") >= SUMMARY_TOKENS))).alias("long"))
    short = told.join(size.where("not long"), "name", "left_semi").groupBy("name").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), SEP).alias("text"))
    long_ = summarised(told.join(size.where("long"), "name", "left_semi"), ["name"], summarise).withColumnRenamed("summary", "text")
    text = short.withColumn("long", F.lit(False)).unionByName(long_.withColumn("long", F.lit(True)))
    flat = lambda c: r.select("name", "pos", F.posexplode(parts(F.col(c))).alias("_i", "_v")).withColumn("_o", F.struct("pos", "_i"))
    ids = first_n(flat("source_id"), ["name"], "_v", "_o", "ids", SOURCE_CAP)
    files = first_n(flat("file_path"), ["name"], "_v", "_o", "files", FILE_CAP)
    out = r.select("name").distinct().join(type_vote(r), "name", "left").join(text, "name", "left").join(ids, "name", "left").join(files, "name", "left")
    empty = F.array().cast("array<string>")
    noted = F.when(F.col("files_n") > FILE_CAP, F.concat("files", F.array(F.lit("...truncated...(KEEP Old)")))).otherwise(F.coalesce("files", empty))
    return out.select("name", F.coalesce("type", F.lit("UNKNOWN")).alias("type"), F.coalesce("text", F.concat(F.lit("Entity "), "name")).alias("description"), F.coalesce("long", F.lit(False)).alias("needs_summary"), F.array_join(F.coalesce("ids", empty), SEP).alias("source_id"), F.array_join(noted, SEP).alias("file_path"), F.coalesce("ids_n", F.lit(0)).cast("long").alias("chunks"))


def keywords(df: DataFrame, keys: list[str], column: str = "keywords") -> DataFrame:
    """(keys, keywords): the union of comma-parted keywords, distinct, sorted, joined by a comma."""
    flat = df.select(*keys, F.explode(parts(F.translate(F.col(column), "，", ","), ",")).alias("_k"))
    return flat.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set("_k")), ",").alias("keywords"))


def relations(records: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Relations of records (src, tgt, weight, keywords, source_id): pairs in canonical order, with weight = the greater of the stored
    weight plus the new weights of sources the edge did not have, and its number of distinct real sources.

    stored: a, b, weight, source_id (one row a pair)."""
    r = records.where("src is not null and tgt is not null and src <> tgt").withColumn("a", F.least("src", "tgt")).withColumn("b", F.greatest("src", "tgt"))
    if stored is None:
        r = r.withColumn("_old", F.array().cast("array<string>")).withColumn("_w", F.lit(0.0))
    else:
        old = stored.select("a", "b", parts(F.col("source_id")).alias("_old"), F.col("weight").alias("_w"))
        r = r.join(old, ["a", "b"], "left").withColumn("_old", F.coalesce("_old", F.array().cast("array<string>"))).na.fill(0.0, ["_w"])
    ids = parts(F.col("source_id"))
    fresh = F.when(F.size(F.array_intersect(ids, F.col("_old"))) > 0, 0.0).otherwise(F.coalesce("weight", F.lit(1.0)))
    sums = r.groupBy("a", "b").agg(F.sum(fresh).alias("_new"), F.max("_w").alias("_w"))
    all_ids = r.select("a", "b", F.explode(evidence(F.array_union(ids, F.col("_old")))).alias("_s")).groupBy("a", "b").agg(F.count_distinct("_s").alias("evidence"))
    out = sums.join(all_ids, ["a", "b"], "left").na.fill(0, ["evidence"])
    return out.select("a", "b", F.greatest(F.col("_w") + F.col("_new"), F.col("evidence").cast("double")).alias("weight"), "evidence")


def endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, type, source_ids) of ends without a node: type UNKNOWN, with the sources of their edges in order. edges: gid, src_id,
    tgt_id, source_id."""
    ends = edges.select("gid", "source_id", F.explode(F.array("src_id", "tgt_id")).alias("id")).where("id is not null")
    lost = ends.join(nodes.select("id"), "id", "left_anti")
    return source_ids(lost, ["id"], "gid").withColumn("type", F.lit("UNKNOWN"))


def refreshed(edges: DataFrame, nodes: DataFrame, cap: int = SOURCE_CAP) -> DataFrame:
    """(id, source_ids, tracked): sources of nodes that are ends of edges: their own first, then their edges' in order, cut to the cap;
    tracked is the whole number. edges: gid, src_id, tgt_id, source_id; nodes: id, source_id."""
    own = nodes.select("id", F.lit(-1).cast("long").alias("_g"), "source_id")
    ends = edges.select(F.explode(F.array("src_id", "tgt_id")).alias("id"), F.col("gid").alias("_g"), "source_id").where("id is not null")
    there = ends.join(nodes.select("id"), "id", "left_semi")
    both = own.join(there.select("id").distinct(), "id", "left_semi").unionByName(there)
    flat = both.select("id", "_g", F.posexplode(parts(F.col("source_id"))).alias("_i", "_v")).withColumn("_o", F.struct("_g", "_i"))
    return first_n(flat, ["id"], "_v", "_o", "source_ids", cap).withColumnRenamed("source_ids_n", "tracked")


def kept_in_cap(records: DataFrame, capped_ids: DataFrame, keys: list[str]) -> DataFrame:
    """KEEP mode: records whose source is among the capped ids (keys, source_ids)."""
    flat = records.withColumn("_s", F.explode(parts(F.col("source_id"))))
    return flat.join(capped_ids.select(*keys, F.explode("source_ids").alias("_s")), [*keys, "_s"], "left_semi").drop("_s").distinct()


def document_candidates(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(doc_id, names): every name that a document's chunks mention, as a node or as the end of an edge."""
    doc = lambda df, name: df.select(F.explode(parts(F.col("source_id"))).alias("s"), F.col(name).alias("name")).select(F.regexp_extract("s", "^(doc-[0-9a-f]{32})-chunk-", 1).alias("doc_id"), "name")
    every = doc(nodes, "id").unionByName(doc(edges, "src_id")).unionByName(doc(edges, "tgt_id")).where("doc_id <> '' and name is not null")
    return every.groupBy("doc_id").agg(F.count_distinct("name").alias("names"))


def rebuilt(records: DataFrame, live: DataFrame) -> DataFrame:
    """Relations rebuilt from records whose chunk is still there: (a, b, weight, evidence, keywords, description). Weights are those of
    the surviving records alone; descriptions keep the order of their records."""
    flat = records.where("src is not null and tgt is not null and src <> tgt").withColumn("_s", F.explode(parts(F.col("source_id"))))
    alive = flat.join(live.select(F.col("id").alias("_s")), "_s", "left_semi").withColumn("a", F.least("src", "tgt")).withColumn("b", F.greatest("src", "tgt"))
    one = alive.groupBy("a", "b", "gid").agg(F.max(F.coalesce("weight", F.lit(1.0))).alias("w"), F.first("keywords", True).alias("keywords"), F.first("description", True).alias("description"))
    text = ordered_distinct(one.where(strip(F.col("description")) != ""), ["a", "b"], "description", "gid", "texts")
    out = one.groupBy("a", "b").agg(F.sum("w").alias("w")).join(alive.groupBy("a", "b").agg(F.count_distinct("_s").alias("evidence")), ["a", "b"])
    out = out.join(keywords(one, ["a", "b"]), ["a", "b"], "left").join(text, ["a", "b"], "left")
    return out.select("a", "b", F.greatest("w", F.col("evidence").cast("double")).alias("weight"), "evidence", F.coalesce("keywords", F.lit("")).alias("keywords"), F.coalesce(F.array_join("texts", SEP), F.lit("")).alias("description"))


def rebuilt_entities(records: DataFrame, live: DataFrame, edges: DataFrame, cap: int = SOURCE_CAP, file_cap: int = FILE_CAP) -> DataFrame:
    """Entities rebuilt from records (name, type, description, source_id, file_path, pos) whose chunk is still there: the sources'
    first ``cap``, and of the records those of these sources alone; the type by their vote, descriptions in their order, files with
    a note of how many there were. A name without a surviving record keeps its type and takes the descriptions of its edges (name,
    description, pos); ``survived`` tells which."""
    r = records.where(F.col("name").isNotNull() & (strip(F.col("name")) != ""))
    flat = r.select("*", F.posexplode(parts(F.col("source_id"))).alias("_i", "_s")).withColumn("_o", F.struct("pos", "_i"))
    alive = flat.join(live.select(F.col("id").alias("_s")), "_s", "left_semi")
    ids = first_n(alive, ["name"], "_s", "_o", "ids", cap)
    kept = alive.join(ids.select("name", F.explode("ids").alias("_s")), ["name", "_s"], "left_semi")
    of_edges = edges.join(kept.select("name"), "name", "left_anti").select("name", "description", "pos")
    text = kept.select("name", "description", "pos").unionByName(of_edges).where(F.col("description").isNotNull() & (strip(F.col("description")) != ""))
    files = kept.select("name", F.posexplode(parts(F.col("file_path"))).alias("_i", "_f"), "pos").withColumn("_o", F.struct("pos", "_i"))
    out = r.select("name").distinct().join(type_vote(kept), "name", "left").join(type_vote(r).withColumnRenamed("type", "_old"), "name", "left")
    out = out.join(ordered_distinct(text, ["name"], "description", "pos", "texts"), "name", "left").join(ids, "name", "left").join(first_n(files, ["name"], "_f", "_o", "files", file_cap), "name", "left")
    note = F.array(F.concat(F.lit("...truncated...(KEEP "), F.lit(file_cap), F.lit("/"), "files_n", F.lit(")")))
    empty = F.array().cast("array<string>")
    return out.select(
        "name", F.coalesce("type", "_old", F.lit("UNKNOWN")).alias("type"), F.coalesce(F.array_join("texts", SEP), F.concat(F.lit("Entity "), "name")).alias("description"), F.array_join(F.coalesce("ids", empty), SEP).alias("source_id"),
        F.array_join(F.when(F.col("files_n") > file_cap, F.concat("files", note)).otherwise(F.coalesce("files", empty)), SEP).alias("file_path"), F.col("ids").isNotNull().alias("survived"),
    )


def merge_fields(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The field strategies side by side: concatenate, keep_first, keep_last, join_unique, join_unique_comma, max. Positions are unique in
    a group; nothing is sorted but the values that a strategy keeps."""
    at = F.when(F.col("value").isNotNull(), F.col(pos))
    out = df.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("value").isNotNull(), F.struct(pos, "value")))), lambda x: x["value"]), SEP).alias("concatenate"),
        F.min_by("value", at).alias("keep_first"),
        F.max_by("value", at).alias("keep_last"),
        F.array_join(F.array_sort(F.collect_set("value")), ",").alias("join_unique_comma"),
        F.max("value").alias("max"),
    )
    unique = ordered_distinct(df, keys, "value", pos, "_u")
    return out.join(unique, keys, "left").withColumn("join_unique", F.coalesce(F.array_join("_u", SEP), F.lit(""))).drop("_u")


def two_phases(entity_records: DataFrame, relation_records: DataFrame, write) -> dict[str, DataFrame]:
    """The merge of a batch in its order: anchors (what each document is about to write) first, so that a run that breaks off can be
    repeated or undone, then entities, then relations, and last the ends that no record named. ``write(name, df)`` commits one table
    and gives it back as it is stored; later phases read what was committed."""
    done = {"anchors": write("anchors", document_names(entity_records, relation_records))}
    done["entities"] = write("entities", entities(entity_records))
    done["relations"] = write("relations", relations(relation_records))
    ends = relation_records.select("gid", F.col("src").alias("src_id"), F.col("tgt").alias("tgt_id"), "source_id")
    done["created"] = write("created", endpoints(ends, done["entities"].select(F.col("name").alias("id"))))
    return done


def document_names(entity_records: DataFrame, relation_records: DataFrame) -> DataFrame:
    """(doc_id, name) that the records of each document will write: names and ends."""
    of = lambda df, c: df.select(F.explode(parts(F.col("source_id"))).alias("s"), F.col(c).alias("name"))
    every = of(entity_records, "name").unionByName(of(relation_records, "src")).unionByName(of(relation_records, "tgt"))
    return every.select(F.regexp_extract("s", "^(doc-[0-9a-f]{32})-chunk-", 1).alias("doc_id"), "name").where("doc_id <> '' and name is not null").distinct()


def score_documents(chunks: DataFrame) -> DataFrame:
    """Chunk scores as document scores: (doc, best, mean, first)."""
    return chunks.groupBy("doc").agg(F.max("score").alias("best"), F.avg("score").alias("mean"), F.min_by("score", "pos").alias("first"))
