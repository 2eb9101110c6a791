"""Chunking of documents: token windows, separators, sections. The default tokenizer is one token a character.

Cases: null and empty texts give no chunk; an overlap below 0 or not below the size is an error; chunks that are blank after
trimming are kept with empty content by the window chunker (their span is real) and dropped by the separator chunker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import strip

# The separators tried in turn by the recursive splitter.
CASCADE = ("\n\n", "\n", "。", "！", "？", "；", "，", " ", "")


def check(size: int, overlap: int) -> None:
    if size < 1 or overlap < 0 or overlap >= size:
        raise ValueError("the overlap must be at least 0 and less than the size")


def windows(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """Windows of ``size`` tokens every ``size - overlap``: adds chunk_order_index, start, tokens and content. JVM-side."""
    check(size, overlap)
    n = F.length(text)
    rest = [c for c in df.columns if c != text]
    starts = df.where(n > 0).withColumn("start", F.explode(F.sequence(F.lit(0), n - 1, F.lit(size - overlap))))
    return starts.select(*rest, F.floor(F.col("start") / (size - overlap)).cast("int").alias("chunk_order_index"), "start", F.least(F.lit(size), n - F.col("start")).alias("tokens"), strip(F.substring(F.col(text), F.col("start") + 1, F.lit(size))).alias("content"))


def by_separator(df: DataFrame, key: str, text: str, separator: str, size: int, overlap: int, only: bool = False) -> DataFrame:
    """Pieces between a separator; those beyond the size are cut into windows, or refused with ``only``."""
    check(size, overlap)
    pieces = df.select(key, F.posexplode(F.split(text, re.escape(separator), -1)).alias("piece", "p")).where(strip(F.col("p")) != "")
    if only:
        return pieces.select(key, "piece", F.when(F.length("p") > size, F.raise_error(F.lit("a piece is larger than the size"))).otherwise(strip(F.col("p"))).alias("content"))
    w = windows(pieces, "p", size, overlap)
    return w.select(key, "piece", "start", "tokens", "content")


def chunk_ids(df: DataFrame, doc: str = "doc_id", order: str = "chunk_order_index", content: str = "content") -> DataFrame:
    """Adds id: ``{doc}-chunk-{order}`` with three digits, or a digest where a document has the same order twice."""
    seen = df.groupBy(doc, order).agg(F.count("*").alias("_n"))
    plain = F.format_string("%s-chunk-%03d", F.col(doc).cast("string"), F.col(order))
    digest = F.md5(F.concat_ws(":", F.col(doc).cast("string"), F.col(order).cast("string"), F.col(content)))
    return df.join(seen, [doc, order]).withColumn("id", F.when(F.col("_n") > 1, digest).otherwise(plain)).drop("_n")


def merge_pieces(parts: list[str], size: int, overlap: int, joint: str) -> list[str]:
    """Neighbouring pieces joined up to the size; each chunk begins with the last pieces of the one before, within the overlap."""
    out: list[str] = []
    held: list[str] = []
    total = 0
    for p in parts:
        n = len(p)
        if held and total + n + len(joint) > size:
            out.append(joint.join(held))
            while held and (total > overlap or total + n + len(joint) > size):
                total -= len(held[0]) + (len(joint) if len(held) > 1 else 0)
                held.pop(0)
        held.append(p)
        total += n + (len(joint) if len(held) > 1 else 0)
    if held:
        out.append(joint.join(held))
    return out


def recursive(text: str | None, size: int, overlap: int, cascade: tuple[str, ...] = CASCADE) -> list[str]:
    """The text cut at the first separator of the cascade it holds, pieces beyond the size at the next ones."""
    if not text or not text.strip():
        return []
    k = next((i for i, s in enumerate(cascade) if s == "" or s in text), len(cascade) - 1)
    sep, rest = cascade[k], cascade[k + 1 :]
    found = list(text) if sep == "" else [p for p in text.split(sep) if p]
    out: list[str] = []
    small: list[str] = []
    for p in found:
        if len(p) <= size:
            small.append(p)
            continue
        out += merge_pieces(small, size, overlap, sep)
        small = []
        out += recursive(p, size, overlap, rest) if rest else [p]
    return [c for c in (x.strip() for x in [*out, *merge_pieces(small, size, overlap, sep)]) if c]


_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+")


def break_threshold(far, method: str, amount: float | None = None):
    """(distances to compare, threshold) of a method: percentile, standard_deviation, interquartile, or gradient (a percentile of how
    fast the distance changes)."""
    import numpy as np

    if method == "percentile":
        return far, np.percentile(far, 95.0 if amount is None else amount)
    if method == "standard_deviation":
        return far, far.mean() + (3.0 if amount is None else amount) * far.std()
    if method == "interquartile":
        low, high = np.percentile(far, [25, 75])
        return far, far.mean() + (1.5 if amount is None else amount) * (high - low)
    if method == "gradient":
        slope = np.gradient(far) if len(far) > 1 else far
        return slope, np.percentile(slope, 95.0 if amount is None else amount)
    raise ValueError(f"unknown method {method}")


def semantic(text: str | None, vectors, method: str = "percentile", amount: float | None = 90.0, size: int = 400) -> list[str]:
    """Sentences grouped until the distance to the next one is beyond the threshold; groups beyond the size are cut by ``recursive``.
    ``vectors``: sentences -> matrix; without it the whole text is cut by ``recursive``, without an overlap."""
    import numpy as np

    if vectors is None:
        return recursive(text, size, 0)
    sentences = [s for s in _SENTENCE.split((text or "").strip()) if s]
    groups = [" ".join(sentences)] if sentences else []
    if len(sentences) >= 3:
        v = np.asarray(vectors(sentences), dtype=float)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        measure, most = break_threshold(1 - (v[:-1] * v[1:]).sum(1), method, amount)
        groups = [" ".join(part) for part in np.split(np.array(sentences, dtype=object), np.flatnonzero(measure > most) + 1)]
    return [c for g in groups for c in ([g] if len(g) <= size else recursive(g, size, 0))]


def hashed_vectors(sentences: list[str], dim: int = 64):
    """A deterministic stand-in for an embedding function: words hashed into buckets."""
    import zlib

    import numpy as np

    out = np.zeros((len(sentences), dim))
    for i, s in enumerate(sentences):
        for w in re.findall(r"\w+", s.lower()):
            out[i, zlib.crc32(w.encode()) % dim] += 1
    return out


#: Shares of the size: a merged chunk, the largest table that stays whole, a part of a larger one, the least last part, a small tail.
IDEAL, TABLE_MOST, TABLE_IDEAL, TABLE_LAST, SMALL_TAIL = 0.75, 0.625, 0.375, 0.32, 0.125
_HEADING = re.compile(r"(#{1,6})[ \t]+(.+?)[ \t]*#*[ \t]*\Z")
#: Lines inside a long paragraph at which it can be cut: bold or numbered titles, items, and short lines that end with a colon.
_ANCHOR = re.compile(r"(?:\*\*[^*]{1,80}\*\*|__[^_]{1,80}__|(?:\d+(?:\.\d+)*[.)]|[-*+•]|\([a-z0-9]{1,3}\))[ \t]+\S.*|[^.!?]{1,79}[:：])[ \t]*\Z")


def table_parts(rows: list[str], size: int) -> list[str]:
    """A table cut between rows into parts of the ideal share, each under the table's header; a last part below its least share is joined
    to the one before, if that does not pass the size."""
    head = rows[:2] if len(rows) > 2 and re.fullmatch(r"[\s|:-]+", rows[1]) else []
    body, used = rows[len(head) :], sum(len(r) + 1 for r in head)
    parts: list[list[str]] = [[]]
    for r in body:
        if parts[-1] and used + sum(len(x) + 1 for x in parts[-1]) + len(r) > TABLE_IDEAL * size:
            parts.append([])
        parts[-1].append(r)
    length = lambda p: used + sum(len(x) + 1 for x in p)
    if len(parts) > 1 and length(parts[-1]) < TABLE_LAST * TABLE_IDEAL * size and length(parts[-2]) + length(parts[-1]) - used <= size:
        parts[-2] += parts.pop()
    # a single row beyond the size is cut like text
    return [x for p in parts for t in ["\n".join([*head, *p])] for x in ([t] if len(t) <= size else recursive(t, size, 0))]


def anchored(text: str, size: int) -> list[str]:
    """A paragraph beyond the size cut before its anchor lines, parts joined up to the ideal share; what is still too long is cut by
    ``recursive``."""
    parts: list[list[str]] = [[]]
    for line in text.split("\n"):
        if parts[-1] and _ANCHOR.match(line):
            parts.append([])
        parts[-1].append(line)
    joined: list[str] = []
    for p in ("\n".join(x) for x in parts):
        if joined and len(joined[-1]) + 1 + len(p) <= IDEAL * size:
            joined[-1] += "\n" + p
        else:
            joined.append(p)
    return [x for p in joined for x in ([p] if len(p) <= size else recursive(p, size, 0))]


def structured(text: str | None, size: int) -> list[tuple[str, str]]:
    """(heading path, content) of a Markdown-like text, in four steps: tables beyond their share are cut between rows, long paragraphs at
    anchors; headings without a body of their own are glued to what follows; then neighbours are merged level by level, the deepest
    first, while they stand under one heading and stay within the ideal share; a small tail joins the chunk before."""
    blocks: list[tuple[tuple[str, ...], str]] = []
    path: tuple[str, ...] = ()
    waiting: list[str] = []
    for part in re.split(r"\n[ \t]*\n\s*", (text or "").strip()):
        lines = part.split("\n")
        while lines and (m := _HEADING.match(lines[0])):
            path = (*path[: len(m.group(1)) - 1], *[""] * (len(m.group(1)) - 1 - len(path)), m.group(2).strip())
            waiting.append(lines.pop(0))
        body = "\n".join(lines).strip()
        if not body:
            continue
        rows = body.split("\n")
        table = len(rows) > 1 and sum(r.count("|") >= 1 for r in rows) > len(rows) / 2
        room = size - sum(len(w) + 1 for w in waiting)
        if table and len(body) > TABLE_MOST * size:
            pieces = table_parts(rows, max(1, room))
        elif len(body) > room:
            pieces = anchored(body, max(1, room))
        else:
            pieces = [body]
        if waiting and pieces:
            pieces[0] = "\n".join([*waiting, pieces[0]])
            waiting = []
        blocks += [(path, x) for x in pieces]
    if waiting:
        blocks.append((path, "\n".join(waiting)))
    deepest = max((len(p) for p, _ in blocks), default=0)
    for level in range(deepest, -1, -1):
        merged: list[tuple[tuple[str, ...], str]] = []
        for p, c in blocks:
            if merged:
                q, d = merged[-1]
                # sections of the first level never share a chunk
                under_one = q == p if level == 0 else q[:level] == p[:level] and len(q) >= level and len(p) >= level
                whole = len(d) + 2 + len(c)
                if under_one and (whole <= IDEAL * size or len(c) < SMALL_TAIL * size and whole <= size):
                    common = tuple(a for a, b in zip(q, p) if a == b) if q != p else q
                    merged[-1] = (common[: max(level, len(common))], d + "\n\n" + c)
                    continue
            merged.append((p, c))
        blocks = merged
    return [(" → ".join(x for x in p if x), c) for p, c in blocks]


def apply(df: DataFrame, key: str, text: str, chunker, name: str = "content") -> DataFrame:
    """Any Python chunker (text -> list of strings, or of (heading, content)) over a table, in Arrow batches."""
    kind = df.schema[key].dataType.simpleString()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b[key], b[text], strict=True):
                for i, c in enumerate(chunker(t)):
                    rows.append((k, i, *(c if isinstance(c, tuple) else ("", c))))
            yield pd.DataFrame(rows, columns=[key, "chunk_order_index", "heading", name])

    return df.select(key, text).mapInPandas(work, f"`{key}` {kind}, chunk_order_index int, heading string, {name} string")


_REGISTERED: dict = {}


def register(name: str, chunker, replace: bool = False) -> None:
    """Adds a chunker: a function of a text (and of options with defaults) that gives a list of strings or of (heading, content)."""
    import inspect

    if not name or not callable(chunker):
        raise ValueError("a chunker needs a name and a function")
    if name in registry() and not replace:
        raise ValueError(f"there is a chunker named {name}")
    try:
        kinds = inspect.signature(chunker).parameters.values()
    except (TypeError, ValueError) as e:
        raise ValueError("the chunker's parameters cannot be read") from e
    needed = [p for p in kinds if p.default is p.empty and p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD)]
    keywords = [p.name for p in kinds if p.default is p.empty and p.kind is p.KEYWORD_ONLY]
    if keywords or len(needed) > 1 or not needed and not any(p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD, p.VAR_POSITIONAL) for p in kinds):
        raise ValueError("a chunker takes one text, and other parameters only with defaults")
    _REGISTERED[name] = chunker


def registry() -> dict:
    """Named chunkers: text -> chunks; the own ones and those that were registered."""
    return {
        "recursive": lambda t: recursive(t, 400, 50),
        "semantic": lambda t: semantic(t, hashed_vectors),
        "structured": lambda t: structured(t, 1200),
        **_REGISTERED,
    }


#: Signs of a file's options: which chunker a document asks for.
OPTION_CHUNKERS = {"F": "fixed", "R": "recursive", "V": "semantic", "P": "structured"}


def by_option(df: DataFrame, key: str, text: str, options: str, size: int, overlap: int) -> DataFrame:
    """(key, chunker, chunk_order_index, heading, content, skip_graph): each document cut by the chunker its options ask for (windows
    where they name none), with ``!`` for no extraction. Windows never leave the JVM; the others run in Arrow batches."""
    signs = F.upper(F.coalesce(F.col(options), F.lit("")))
    name = F.lit("fixed")
    for sign, chunker in reversed(OPTION_CHUNKERS.items()):
        name = F.when(signs.contains(sign), chunker).otherwise(name)
    x = df.select(key, text, name.alias("chunker"), signs.contains("!").alias("skip_graph"))
    out = windows(x.where("chunker = 'fixed'"), text, size, overlap).select(key, "chunker", "chunk_order_index", F.lit("").alias("heading"), "content", "skip_graph")
    for chunker in ("recursive", "semantic", "structured"):
        mine = x.where(F.col("chunker") == chunker)
        got = apply(mine, key, text, registry()[chunker]).join(mine.select(key, "skip_graph"), key)
        out = out.unionByName(got.select(key, F.lit(chunker).alias("chunker"), "chunk_order_index", "heading", "content", "skip_graph"))
    return out


def without_references(blocks: DataFrame, last: int | None = None) -> DataFrame:
    """Blocks (doc, pos, heading, content) without the sections of references; with ``last`` only among a document's last blocks."""
    from pyspark.sql import Window

    is_ref = F.lower(F.coalesce("heading", F.lit(""))).rlike(r"^\s*(?:\d+[.)]?\s*)?(references|bibliography|works cited|literatur|literaturverzeichnis|références|referencias)")
    if last is None:
        return blocks.where(~is_ref)
    place = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("pos")))
    return blocks.withColumn("_r", place).where(~(is_ref & (F.col("_r") <= last))).drop("_r")


def mentions_around(df: DataFrame, key: str, text: str, mark: str, budget: int) -> DataFrame:
    """(key, item, leading, trailing) of each place where the literal mark stands in a text, items from 1."""
    before = F.transform(F.split(text, rf"\Q{mark}\E", -1), F.length)
    # the parts between the marks, added up; the last part ends no mark
    none = F.array().cast("array<int>")
    ends = F.aggregate(F.slice(before, 1, F.size(before) - 1), F.struct(F.lit(-len(mark)).alias("at"), none.alias("all")), lambda a, n: F.struct((a["at"] + len(mark) + n).alias("at"), F.concat(a["all"], F.array(a["at"] + len(mark) + n)).alias("all")), lambda a: a["all"])
    x = df.where(F.col(text).isNotNull()).select(key, text, F.posexplode(ends).alias("i", "at"))
    return x.select(key, (F.col("i") + 1).alias("item"), surroundings(F.col(text), F.col("at"), budget).alias("s")).select(key, "item", "s.leading", "s.trailing")


def surroundings(text: Column, at: Column, budget: int) -> Column:
    """Leading and trailing text of a place, half the budget each."""
    half = budget // 2
    return F.struct(F.substring(text, F.greatest(F.lit(1), at - half + 1), F.least(F.lit(half), at)).alias("leading"), F.substring(text, at + 1, F.lit(half)).alias("trailing"))


def table_context(df: DataFrame, key: str, text: str, budget: int) -> DataFrame:
    """(key, item, rows, leading, trailing, table) of the tables of a text (two or more lines with cell bars): the number of their rows, the
    text before and after, half the budget each at sentence or line bounds, and the table's first rows within the budget. Items count
    from 1; a text without a table has no row. One narrow pass."""
    kind = df.schema[key].dataType.simpleString()
    half = budget // 2

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, t in zip(b[key], b[text], strict=True):
                item = 0
                for m in _TABLE.finditer(t or ""):
                    item += 1
                    before, after = t[max(0, m.start() - half) : m.start()], t[m.end() : m.end() + half]
                    if m.start() > half and (cut := re.search(r"[.!?]\s+|\n", before)):
                        before = before[cut.end() :]
                    if m.end() + half < len(t) and (cuts := list(re.finditer(r"[.!?](?=\s)|\n", after))):
                        after = after[: cuts[-1].end()]
                    lines, kept, used = m.group().strip("\n").split("\n"), [], 0
                    for line in lines:
                        if used + len(line) + 1 > budget:
                            break
                        kept.append(line)
                        used += len(line) + 1
                    rows.append((k, item, sum(not re.fullmatch(r"[\s|:-]+", x) for x in lines), before.strip(), after.strip(), "\n".join(kept)))
            yield pd.DataFrame(rows, columns=[key, "item", "rows", "leading", "trailing", "table"])

    return df.select(key, text).mapInPandas(work, f"`{key}` {kind}, item int, rows int, leading string, trailing string, table string")


_TABLE = re.compile(r"(?:^[^\n|]*\|[^\n]*(?:\n|\Z)){2,}", re.M)
