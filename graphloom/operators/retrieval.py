"""Retrieval: exact vector search, the lexical leg, ranked-list algebra, chunk choice and token budgets.

A ranked list is a DataFrame with an explicit ``pos``; nothing depends on arrival order. Searches end in a bounded top-k, which
Spark runs as partial top-ks and one merge. Query-side tables (terms, hits) are bounded by k or by the query, so their
broadcasts are.

Cases: a zero or null vector has cosine 0 or no row; empty lists give empty results; k or a budget of 0 gives nothing; ties end
with the id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.quality import is_bibliography
from graphloom.session import cut

THRESHOLD = 0.2


def cosine(v: Column, query: list[float]) -> Column:
    """Cosine in double precision, 0 for vectors without direction."""
    q = F.array(*(F.lit(float(x)) for x in query))
    norm = math.sqrt(sum(float(x) * float(x) for x in query))
    dot = F.aggregate(F.zip_with(v, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    own = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when((own == 0) | F.lit(norm == 0), 0.0).otherwise(dot / (own * norm))


def search(vectors: DataFrame, query: list[float], k: int, threshold: float = THRESHOLD, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, score, pos) of the k best vectors (id, vector) at or above the threshold, with the columns to carry."""
    hits = vectors.select("id", *carry, cosine(F.col("vector"), query).alias("score")).where(F.col("score") >= threshold).orderBy(F.desc("score"), "id").limit(k)
    return ranked(hits, [F.desc("score"), F.asc("id")])


def held(bounded: DataFrame) -> DataFrame:
    """A list bounded by a parameter, computed once and held by the driver as a local table, for several readers."""
    return bounded.sparkSession.createDataFrame(bounded.toArrow(), schema=bounded.schema)


def ranked(bounded: DataFrame, order: list[Column]) -> DataFrame:
    """Adds pos from 0. Only for lists bounded by a parameter: they are numbered in one task."""
    return bounded.withColumn("pos", F.row_number().over(Window.orderBy(*order)) - 1)


#: The share of all chunks, in percent, and the least number, above which a term is common.
COMMON_PCT, COMMON_LEAST = 10, 500

# Words without weight in a question.
STOP = tuple("a an and are as at be by for from has in is it its of on or that the their this to was were what when where which who why with".split())


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), "[^a-z]+"), lambda t: F.length(t) > 1))


def question_terms(words: list[str]) -> list[str]:
    return sorted({w.lower() for w in words} - set(STOP))


def lexical(chunks: DataFrame, words: list[str], k: int, rarest: int = 3, cap: int | None = None) -> DataFrame:
    """(id, score, pos): chunks (id, content; rows sent twice count once) by the sum of ln(N / (df + 1)) of the question's terms they
    hold, stop words apart; candidates hold one of the rarest terms. A term of more than ``cap`` chunks (COMMON_PCT of all and
    COMMON_LEAST at least, if None) is common: it weighs the least weight and gives no candidates.

    Texts are read once, and only the terms they share with the question are kept (in the shared folder), so that no text is
    shuffled; the counts that come to the driver are one row."""
    words = question_terms(words)
    spark = chunks.sparkSession
    if not words or k <= 0:
        return spark.createDataFrame([], "id string, score double, pos int")
    held = cut(chunks.select("id", F.array_sort(F.array_intersect(terms_of(F.coalesce("content", F.lit(""))), F.array(*map(F.lit, words)))).alias("t")).distinct())
    counts = held.agg(F.count("*").alias("n"), *(F.count_if(F.array_contains("t", w)).alias(f"w{i}") for i, w in enumerate(words))).first()
    n, df = counts["n"], {w: counts[f"w{i}"] for i, w in enumerate(words) if counts[f"w{i}"]}
    most = max(COMMON_LEAST, COMMON_PCT * n / 100) if cap is None else cap
    common = {w for w in df if df[w] > most}
    floor = min((math.log(n / (c + 1)) for w, c in df.items() if w not in common), default=0.0)
    weight = {w: floor if w in common else math.log(n / (c + 1)) for w, c in df.items()}
    rare = [w for _, w in sorted((df[w], w) for w in df if w not in common)][:rarest]
    if not rare:
        return spark.createDataFrame([], "id string, score double, pos int")
    score = F.aggregate("t", F.lit(0.0), lambda s, w: s + F.element_at(F.create_map(*(F.lit(x) for p in weight.items() for x in p)), w))
    best = held.where(F.arrays_overlap("t", F.array(*map(F.lit, rare)))).select("id", F.round(score, 9).alias("score")).orderBy(F.desc("score"), "id").limit(k)
    return ranked(best, [F.desc("score"), F.asc("id")])


def with_rows(hits: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """Hits (id, ...; bounded by a parameter) with columns of their rows: the large side is filtered where it lies, and copies of a row
    count once."""
    return rows.select("id", *columns).join(F.broadcast(hits), "id").dropDuplicates(["id"])


def lexical_leg(chunks: DataFrame, words: list[str], k: int) -> DataFrame:
    """(id, score, pos): the lexical list without chunks that are bibliographies: three times as many are fetched, and the first k of
    the rest stay."""
    hits = with_rows(lexical(chunks, words, 3 * k), chunks, "content").where(~is_bibliography(F.coalesce("content", F.lit(""))))
    return ranked(hits.select("id", "score").orderBy(F.desc("score"), "id").limit(k), [F.desc("score"), F.asc("id")])


def per_work(hits: DataFrame, k: int, works: int) -> DataFrame:
    """(id, work, pos): of chunks (work, work_pos, id, place, score) of ranked works, each work's first chunk by place and its best
    other ones by score, ceil(k / works) each; works in order, the first chunk leading."""
    most = math.ceil(k / max(1, works))
    w = Window.partitionBy("work")
    x = hits.withColumn("_f", F.row_number().over(w.orderBy("place", "id"))).withColumn("_lead", F.col("_f") == 1)
    x = x.withColumn("_r", F.row_number().over(w.orderBy(F.desc("_lead"), F.desc("score"), "place", "id"))).where(F.col("_r") <= most)
    return ranked(x.select("id", "work", "work_pos", "_r"), [F.asc("work_pos"), F.asc("_r")]).select("id", "work", "pos")


def processed(chunks: DataFrame, words: list[str], top: int, budget: int, floor: float = 0.0, per_work_most: int = 0, pins: DataFrame | None = None, pin_most: int = 2) -> DataFrame:
    """(id, score, pinned, pos): the post-processing of a bounded chunk list (id, pos, work, content), in this order: bibliographies go;
    rerank by the share of the question's terms (ties in list order); scores below the floor go; pinned works' first chunks come to
    the front; at most so many chunks a work; ``top`` chunks; the prefix within the budget of characters. pins: work."""
    terms = question_terms(words)
    c = chunks.where(F.col("content").isNotNull() & ~is_bibliography(F.col("content")))
    share = F.size(F.array_intersect(terms_of(F.col("content")), F.array(*map(F.lit, terms)))) / max(1, len(terms)) if terms else F.lit(0.0)
    c = c.withColumn("score", F.round(share, 6)).where(F.col("score") >= floor)
    order = [F.desc("score"), F.asc("pos")]
    c = c.withColumn("pinned", F.lit(False))
    if pins is not None:
        c = c.drop("pinned").join(F.broadcast(pins.select("work", F.lit(True).alias("_pin"))), "work", "left")
        first = F.row_number().over(Window.partitionBy("work").orderBy(*order))
        c = c.withColumn("pinned", F.coalesce(F.col("_pin"), F.lit(False)) & (first <= pin_most)).drop("_pin")
    order = [F.desc("pinned"), *order]
    c = capped_per_work(c, "work", order, per_work_most).orderBy(*order).limit(top)
    c = within_budget(c, F.length("content"), order, budget)
    return c.select("id", "score", "pinned", (F.row_number().over(Window.orderBy(*order)) - 1).alias("pos"))


def interleave(lists: list[DataFrame]) -> DataFrame:
    """(id, leg, pos, rank): round-robin of ranked lists, first mention wins. Positions are those before duplicates go."""
    whole = None
    for leg, one in enumerate(lists):
        x = one.select("id", F.lit(leg).alias("leg"), F.col("pos").cast("int").alias("pos"))
        whole = x if whole is None else whole.unionByName(x)
    first = whole.groupBy("id").agg(F.min(F.struct("pos", "leg")).alias("x")).select("id", "x.leg", "x.pos")
    return first.withColumn("rank", F.row_number().over(Window.orderBy("pos", "leg")) - 1)


def prepend(lists: list[DataFrame]) -> DataFrame:
    """One list after the other, first mention wins."""
    whole = None
    for leg, one in enumerate(lists):
        x = one.select("id", F.lit(leg).alias("leg"), F.col("pos").cast("int").alias("pos"))
        whole = x if whole is None else whole.unionByName(x)
    first = whole.groupBy("id").agg(F.min(F.struct("leg", "pos")).alias("x")).select("id", "x.leg", "x.pos")
    return first.withColumn("rank", F.row_number().over(Window.orderBy("leg", "pos")) - 1)


def owned_chunks(groups: DataFrame) -> DataFrame:
    """Chunks of ranked groups (group_pos, chunk_id, pos): every mention counts, the first owns; in a group by count, then place.
    Adds occurrence and place."""
    w = Window.partitionBy("chunk_id")
    x = groups.withColumn("occurrence", F.count("*").over(w)).withColumn("_r", F.row_number().over(w.orderBy("group_pos", "pos")))
    x = x.where("_r = 1").drop("_r")
    return x.withColumn("place", F.row_number().over(Window.partitionBy("group_pos").orderBy(F.desc("occurrence"), "pos")))


def quotas(groups: DataFrame, most: int) -> DataFrame:
    """(group_pos, n, quota): a linear gradient from ``most`` to 1 over the groups by position, rounded half to even; what groups
    do not use goes to the earlier groups that have more. groups: group_pos, n (chunks there)."""
    w = Window.orderBy("group_pos")
    g = groups.withColumn("i", F.row_number().over(w) - 1).withColumn("m", F.count("*").over(Window.partitionBy(F.lit(1))))
    if most <= 0:
        return groups.withColumn("quota", F.lit(0))
    want = F.when(F.col("m") == 1, F.lit(float(most))).otherwise(F.bround(F.lit(float(most)) - F.col("i") / (F.col("m") - 1) * (most - 1), 0)).cast("int")
    g = g.withColumn("want", want).withColumn("base", F.least("want", "n")).withColumn("more", F.col("n") - F.col("base"))
    free = F.sum(F.col("want") - F.col("base")).over(Window.partitionBy(F.lit(1)))
    before = F.coalesce(F.sum("more").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return g.select("group_pos", "n", (F.col("base") + F.greatest(F.lit(0), F.least("more", free - before))).cast("int").alias("quota"))


def pick_by_weight(owned: DataFrame, most: int) -> DataFrame:
    """Chunks of owned groups within the groups' quotas, in group order."""
    q = quotas(owned.groupBy("group_pos").agg(F.count("*").cast("int").alias("n")), most)
    return owned.join(q.select("group_pos", "quota"), "group_pos").where("place <= quota").drop("quota")


def pick_by_vector(owned: DataFrame, vectors: DataFrame, query: list[float], most: int, groups: int) -> DataFrame:
    """The best owned chunks by cosine, ties in candidate order; the number of them is half the groups' most, at least one."""
    n = max(1, int(most * groups / 2))
    x = owned.join(vectors.select(F.col("id").alias("chunk_id"), cosine(F.col("vector"), query).alias("score")), "chunk_id")
    return x.orderBy(F.desc("score"), "group_pos", "place").limit(n)


def within_budget(df: DataFrame, size: Column, order: list[Column], budget: int) -> DataFrame:
    """The longest prefix in the order whose sizes sum to the budget or less. For lists bounded by a parameter."""
    total = F.sum(size).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("running", total).where(F.col("running") <= budget)


def capped_per_work(df: DataFrame, work: str, order: list[Column], most: int) -> DataFrame:
    """At most so many rows of each work in rank order; 0 is no cap."""
    if not most:
        return df
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(work).orderBy(*order))).where(F.col("_r") <= most).drop("_r")


def references(df: DataFrame, path: str = "file_path", pos: str = "pos") -> DataFrame:
    """(reference, file_path): files by frequency, ties by first place, numbered from 1."""
    f = df.groupBy(path).agg(F.count("*").alias("n"), F.min(pos).alias("first"))
    return f.withColumn("reference", F.row_number().over(Window.orderBy(F.desc("n"), "first"))).select("reference", path)


def fit_context(entities: DataFrame, relations: DataFrame, chunks: DataFrame, budget: int) -> DataFrame:
    """(kind, pos, tokens) of what fits a context: entities and relations in turn by rank up to the first that does not fit, then each
    list on its own, then chunks. All are lists of (pos, tokens) bounded by a parameter."""
    leg = lambda df, k, name: df.select(F.lit(k).alias("leg"), F.lit(name).alias("kind"), F.col("pos").cast("int").alias("pos"), F.col("tokens").cast("long").alias("tokens"))
    whole = leg(entities, 0, "entity").unionByName(leg(relations, 1, "relation"))
    both = within_budget(whole, F.col("tokens"), [F.asc("pos"), F.asc("leg")], budget).drop("running")
    rest = whole.join(both.select("leg", "pos"), ["leg", "pos"], "left_anti").unionByName(leg(chunks, 2, "chunk"))
    used = both.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("_used"))
    # what is left goes down the lists one after the other; the first that does not fit ends it
    more = within_budget(rest.join(F.broadcast(used)), F.col("tokens"), [F.asc("leg"), F.asc("pos")], 1 << 60).where(F.col("running") + F.col("_used") <= budget)
    return both.select("kind", "pos", "tokens").unionByName(more.select("kind", "pos", "tokens"))


def structured_result(entities: DataFrame, relations: DataFrame, chunks: DataFrame, mode: str, keywords: list[str]) -> dict:
    """The result of a query as tables, with its references and what it was asked."""
    return {"entities": entities, "relationships": relations, "chunks": chunks, "references": references(chunks), "metadata": {"mode": mode, "keywords": list(keywords)}}


def routed(mode: str, low: list[str], high: list[str]) -> tuple[list[str], list[str]]:
    """(words for the entity list, words for the relation list) of a mode; an empty own list borrows the other one, and a list that the
    mode does not ask is empty."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}; one of {', '.join(MODES)}")
    return (low or high if mode in ("local", "hybrid", "mix") else []), (high or low if mode in ("global", "hybrid", "mix") else [])


#: Modes of a query over the graph; naive asks no list of it, and bypass is no query.
MODES = ("local", "global", "hybrid", "mix", "naive")
