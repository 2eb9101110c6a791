"""Splitting oversized texts at natural boundaries.

Every place of a text has a boundary strength (paragraph, heading or line, sentence, clause, word, none). A sparse table over
the strengths answers range-maximum queries in constant time: from the start of a piece, the strongest cut among all permitted
lengths is taken, the rightmost of equals; the next piece steps back by the overlap to the first word that begins there, and
by the whole overlap where none does (long words, scripts without spaces).

A token is four code points, rounded up. Cases: null, empty and blank texts give one piece without change (null stays null);
a text within the limit is one piece; a text without any boundary is cut hard at the limit, but never between a letter and
its combining marks unless these alone fill the limit; the pieces without their overlaps are the text, sign by sign.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.prefix import running_total

CHARS_PER_TOKEN = 4
#: A piece is at least this share of the limit, so that the strongest cut is sought in the rest of its length.
LEAST = 0.5

NONE, WORD, CLAUSE, SENTENCE, LINE, PARAGRAPH = 0, 1, 2, 3, 4, 5
_SENTENCE_END = frozenset(".!?…。！？")
_CLAUSE_END = frozenset(",;:，；：、")
_CLOSING = frozenset("\"')]}»”’」』）")


def strengths(text: str) -> np.ndarray:
    """Strength of a cut before each place 0..len(text) (a cut follows the white space it stands at)."""
    n = len(text)
    out = np.zeros(n + 1, dtype=np.int8)
    codes = np.frombuffer(text.encode("utf-32-le", errors="surrogatepass"), dtype=np.uint32)
    space = np.fromiter((c.isspace() for c in text), dtype=bool, count=n)
    # the first sign after white space begins a word
    begins = np.flatnonzero(space[:-1] & ~space[1:]) + 1 if n > 1 else np.array([], dtype=int)
    for at in begins:
        k, lines = at - 1, 0
        while k >= 0 and space[k]:
            lines += text[k] == "\n"
            k -= 1
        if lines >= 2:
            out[at] = PARAGRAPH
        elif lines:
            out[at] = LINE
        else:
            while k >= 0 and text[k] in _CLOSING:
                k -= 1
            out[at] = SENTENCE if k >= 0 and text[k] in _SENTENCE_END else CLAUSE if k >= 0 and text[k] in _CLAUSE_END else WORD
        if lines == 1 and k >= 0 and text[k] not in _SENTENCE_END and text[at].islower():
            out[at] = WORD  # a wrapped line of running text is no boundary of its own
    # scripts without spaces end their sentences and clauses without one
    for at in np.flatnonzero(codes >= 0x3001) + 1:
        c = text[at - 1]
        if at < n and not out[at]:
            out[at] = SENTENCE if c in _SENTENCE_END else CLAUSE if c in _CLAUSE_END else NONE
    # never cut before a combining mark, a variation selector or a joiner
    for at in np.flatnonzero(codes >= 0x300):
        if at and (unicodedata.combining(text[at]) or text[at] in "‍︎️" or text[at - 1] == "‍"):
            out[at] = -1
    return out


class RangeMaximum:
    """Sparse table: the rightmost place of the greatest value in any range, in constant time after n log n."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        # a greater key is a greater value, then a place further right
        key = values.astype(np.int64) * (n + 1) + np.arange(n)
        self.n, self.rows = n, [key]
        step = 1
        while 2 * step <= n:
            last = self.rows[-1]
            self.rows.append(np.maximum(last[:-step], last[step:]))
            step *= 2

    def argmax(self, a: int, b: int) -> int:
        """Place of the maximum in a..b, both included."""
        k = int(b - a + 1).bit_length() - 1
        row = self.rows[k]
        return int(max(row[a], row[b - (1 << k) + 1]) % (self.n + 1))


def _step_back(s: np.ndarray, starts: np.ndarray, cut: int, least: int) -> int:
    """Where the piece after ``cut`` begins, at ``least`` or later: at the first word there, else at the first place that is not
    before a combining mark."""
    k = np.searchsorted(starts, least)
    if k < len(starts) and starts[k] < cut:
        return int(starts[k])
    while least < cut and s[least] < 0:
        least += 1
    return min(least, cut)


def pieces(text: str | None, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of each piece in code points."""
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("the overlap must be at least 0 and less than the limit")
    most, back = limit * CHARS_PER_TOKEN, overlap * CHARS_PER_TOKEN
    n = len(text or "")
    if n <= most:
        return [(0, n)]
    s = strengths(text)
    table = RangeMaximum(s)
    starts = np.flatnonzero(s[: n + 1] >= WORD)
    out, start, done = [], 0, 0
    while n - start > most:
        # a piece must go beyond the last cut, and beyond what the next one repeats
        first = max(start + int(most * LEAST), done + 1, start + back + 1)
        cut = table.argmax(min(first, start + most), start + most)
        if s[cut] <= NONE:
            cut = start + most
            while s[cut] < 0 and cut > first:
                cut -= 1
        out.append((start, cut))
        done = cut
        start = _step_back(s, starts, cut, max(cut - back, start + 1))
    return [*out, (start, n)]


def split(df: DataFrame, key: str = "id", text: str = "content", limit: int = 480, overlap: int = 32) -> DataFrame:
    """Replaces each row by its pieces: adds piece (from 0), n_pieces, start, end and replaces the text. One narrow pass."""
    if limit < 1 or not 0 <= overlap < limit:
        raise ValueError("the overlap must be at least 0 and less than the limit")

    @F.pandas_udf("array<struct<piece int, start int, end int, content string>>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([[(k, a, b, None if t is None else t[a:b]) for k, (a, b) in enumerate(pieces(t, limit, overlap))] for t in texts])

    rest = [c for c in df.columns if c != text]
    cutted = df.withColumn("_p", cut(F.col(text)))
    return cutted.select(*rest, F.size("_p").alias("n_pieces"), F.explode("_p").alias("_q")).select(*rest, "n_pieces", "_q.piece", "_q.start", "_q.end", F.col("_q.content").alias(text))


def fresh_index(df: DataFrame, doc: str = "full_doc_id", order: str = "chunk_order_index", key: str = "id") -> DataFrame:
    """A chunk_order_index from 0 without gaps in each document, by the old index (where null, the number in the id), the id and
    the piece. Documents of any number of chunks are cut into runs of 256 old places for it."""
    number = F.regexp_extract(key, r"-chunk-(\d{1,9})$", 1)
    place = F.coalesce(F.col(order).cast("long"), F.when(number != "", number.cast("long")), F.lit(0).cast("long"))
    df = df.withColumn("_place", place)
    ordered = running_total(df, [doc], [F.col("_place"), F.col(key), F.col("piece")], F.lit(1), F.floor(F.col("_place") / 256), "_n")
    return ordered.withColumn(order, F.col("_n").cast("int")).drop("_place", "_n")
