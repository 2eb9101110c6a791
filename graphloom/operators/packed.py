"""Several values packed in one field: choose each field's dialect by minimum description length, then parse it.

A dialect is a set of delimiters with a quote sign. Every field is parsed under each dialect whose delimiters it holds;
a parse costs the code lengths of its values and of its separators. A value that the corpus holds elsewhere costs
-log2 of its share of the code book (counted over the whole corpus by one distributed aggregation); any other value is
spelled out and costs more, most of all if it lacks the form of its field. The cheapest parse wins, ties to fewer values.
Fields whose outcome no code book can change (one kind of separator, no quotes, all values well-formed) are not priced.

Cases: a null field has no values; an empty or blank one has none either; values that are blank between two delimiters are
dropped and positions count the rest from 1; equal rows give equal values; quotes that never close are ordinary signs.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.session import cut

# The signs that part values in the library's tables, and the quotes.
SEPARATORS = ("<SEP>", ";", "；", ",", "，", "、", "|", "\n", "\t")
QUOTES = ('"', "'")

#: Bits of a spelled-out value: the announcement, each character, and the fine for a value without the form of its field.
NEW_BITS, CHAR_BITS, MALFORMED_BITS, SEPARATOR_BITS, DIALECT_BITS = 12.0, 0.25, 60.0, 1.0, 2.0
#: The fine for each comma in a keyword: it may hold one, but two keywords are likelier.
COMMA_BITS = 25.0
#: The least a value of the code book can cost, for ruling out parses before the code book is asked.
LEAST_BITS = 0.0

_REF = re.compile(r"doc-[0-9a-f]{32}-chunk-\d+\Z")
_SENTINEL = re.compile(r"[A-Za-z][A-Za-z_]*\Z")
_FILE = re.compile(r"[^\n\t]*\.[A-Za-z][A-Za-z0-9]{1,4}\Z")
_FILE_INSIDE = re.compile(r"\.[A-Za-z][A-Za-z0-9]{1,4}\s*(?:<SEP>|[;；,，、|\n\t\"'])", re.I)
_WORDS = re.compile(r"[^\W_][^;；，、|\n\t\"'\[\]<>]*\Z")
_SIGNS = re.compile(r"<sep>|[;；,，、|\n\t\"]", re.I)


def well_formed(kind: str, value: str) -> bool:
    """Whether a value has the form that values of its kind of field have."""
    if kind == "source_id":
        return bool(_REF.match(value) or _SENTINEL.match(value))
    if kind == "file_path":
        return bool((_FILE.match(value) and not _FILE_INSIDE.search(value) and value[:1] not in "\"'[") or _SENTINEL.match(value))
    return bool(_WORDS.match(value))


def unquote(value: str) -> str:
    """The value without surrounding white space and enclosing quotes; doubled or escaped quotes inside count once."""
    value = value.strip()
    while len(value) >= 2 and value[0] == value[-1] and value[0] in QUOTES:
        q = value[0]
        value = value[1:-1].replace(q + q, q).replace("\\" + q, q).strip()
    return value


_SEP = re.compile(r"<sep>", re.I)
_ANY = re.compile(r"<sep>|[;；,，、|\n\t]", re.I)
_QUOTED = re.compile(r"[\"'\[\]]")


def split(text: str, delimiters: tuple[str, ...], quote: str | None) -> list[str]:
    """Values between the delimiters. A quote opens only where a value begins and closes only where one ends, so that an
    apostrophe inside a word stays; a quote that never closes is an ordinary sign."""
    marks = "|".join("<[Ss][Ee][Pp]>" if d == "<SEP>" else re.escape(d) for d in delimiters)
    stop = re.compile(marks)
    out, at, n = [], 0, len(text)
    while at <= n:
        begin = at
        if quote:
            m = re.compile(r"\s*" + quote).match(text, at)
            if m:
                close = re.compile(quote + r"(?=[ \r]*(?:" + marks + r"|\Z))").search(text, m.end())
                if close:
                    at = close.end()
        m = stop.search(text, at)
        if not m:
            out.append(text[begin:])
            break
        out.append(text[begin : m.start()])
        at = m.end()
    return [v for v in (unquote(x) for x in out) if v]


def parses(text: str) -> list[list[str]]:
    """The different parses of a field, the one that takes it as a single value first."""
    whole = unquote(text)
    if not whole:
        return []
    body, out = text.strip(), [[whole]]
    if body[:1] == "[" and body[-1:] == "]":
        try:
            listed = json.loads(body)
            if isinstance(listed, list) and all(isinstance(x, str) for x in listed):
                return [[v for v in (unquote(x) for x in listed) if v]]
        except ValueError:
            pass
        body = body[1:-1]
    there = [d for d in SEPARATORS if (_SEP.search(body) if d == "<SEP>" else d in body)]
    if not there:
        return out
    quotes: list[str | None] = [None, *(q for q in QUOTES if q in body)]
    for n in range(1, len(there) + 1):
        for chosen in itertools.combinations(there, n):
            for q in quotes:
                items = split(body, chosen, q)
                if items and items not in out:
                    out.append(items)
    return out


def spelled(kind: str, value: str) -> float:
    """Code length in bits of a value that is not taken from the code book."""
    fine = COMMA_BITS * value.count(",") if kind == "properties" else 0.0
    return NEW_BITS + CHAR_BITS * len(value) + (fine if well_formed(kind, value) else MALFORMED_BITS * (1 + len(_SIGNS.findall(value))))


def evident(kind: str, text: str) -> list[str] | None:
    """The values of a field that needs no pricing: no quote or bracket, at most one kind of separator, and all values well-formed.
    Its only other parse leaves the field whole, with all its separators in one malformed value. Each of k separators then costs
    MALFORMED_BITS, against NEW_BITS and SEPARATOR_BITS for a further value, so the whole is dearer whatever the code book holds
    (``priced`` gives the same answer, which the tests compare)."""
    if _QUOTED.search(text):
        return None
    found = {m.lower() for m in _ANY.findall(text)}
    # a keyword may hold a comma, so commas between keywords are priced
    if len(found) > 1 or kind == "properties" and "," in found:
        return None
    items = [v for v in (x.strip() for x in (_ANY.split(text) if found else [text])) if v]
    # a single word among files is no evidence of a separator
    return items if items and all(well_formed(kind, v) and not (kind == "file_path" and found and _SENTINEL.match(v)) for v in items) else None


def candidates(kind: str, text: str | None) -> list[tuple[list[str], list[float]]]:
    """The parses that can still be the cheapest whatever the code book holds, each with its values' spelled-out costs."""
    if text is None:
        return []
    plain = evident(kind, text)
    return [(plain, [0.0] * len(plain))] if plain else priced(kind, text)


def priced(kind: str, text: str) -> list[tuple[list[str], list[float]]]:
    """``candidates`` of a field by the costs of all its parses."""
    found = []
    for items in parses(text):
        bits = [spelled(kind, v) for v in items]
        extra = SEPARATOR_BITS * (len(items) - 1) + DIALECT_BITS * (len(items) > 1)
        # only a well-formed value can be in the code book for a low price
        low = extra + sum(LEAST_BITS if b < MALFORMED_BITS else b for b in bits)
        found.append((low, extra + sum(bits), items, bits))
    best = min((high for _, high, _, _ in found), default=0.0)
    return [(items, bits) for low, high, items, bits in found if low <= best]


_PARSED = "tbl string, gid long, field string, k int, n int, likely boolean, items array<string>, bits array<double>"


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for tbl, gid, field, packed in zip(b["tbl"], b["gid"], b["field"], b["packed"], strict=True):
            c = candidates(field, packed)
            best = min(range(len(c)), key=lambda k: (sum(c[k][1]) + SEPARATOR_BITS * len(c[k][0]), len(c[k][0]), k), default=-1)
            rows += [(tbl, gid, field, k, len(c), k == best, items, bits) for k, (items, bits) in enumerate(c)]
        yield pd.DataFrame(rows, columns=["tbl", "gid", "field", "k", "n", "likely", "items", "bits"])


def keywords_of(properties: Column) -> Column:
    """The packed keywords member of a JSON properties string (null if there is none)."""
    return F.get_json_object(properties, "$.keywords")


def fields_of(df: DataFrame, tbl: str, only: tuple[str, ...] = ("source_id", "file_path", "properties")) -> DataFrame:
    """(tbl, gid, field, packed) of one table, one row for each packed field; a single narrow pass, no shuffle."""
    packed = {"source_id": F.col("source_id"), "file_path": F.col("file_path"), "properties": keywords_of(F.col("properties"))}
    stacked = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), packed[f].alias("packed")) for f in only)))
    return df.select(F.lit(tbl).alias("tbl"), "gid", stacked.alias("f")).select("tbl", "gid", "f.field", "f.packed").where("packed is not null")


def parse_packed(fields: DataFrame) -> DataFrame:
    """(tbl, gid, field, items): the chosen parse of every field. ``fields`` has tbl, gid, field, packed and one row per field.

    Texts are parsed once, into a table. The code book is one partially aggregated count of the values of all fields, of an ambiguous
    one by its parse that is cheapest without a code book; fields that only one parse can win never meet the book, so only the
    truly ambiguous ones are shuffled."""
    parsed = cut(fields.mapInPandas(_parse_batches, _PARSED))
    sure = parsed.where("n = 1").select("tbl", "gid", "field", "items")
    likely = parsed.where("likely")
    book = likely.select("field", F.explode("items").alias("value")).groupBy("field", "value").agg(F.count("*").alias("c")).where("c > 1")
    # one total for each kind of field: three rows, so their broadcast is bounded
    total = likely.groupBy("field").agg(F.sum(F.size("items")).alias("total"))
    book = book.join(F.broadcast(total), "field").select("field", "value", (-F.log2(F.col("c") / F.col("total"))).alias("code"))
    open_ = parsed.where("n > 1").select("tbl", "gid", "field", "k", F.posexplode(F.arrays_zip("items", "bits")).alias("pos", "x"))
    open_ = open_.select("tbl", "gid", "field", "k", "pos", F.col("x.items").alias("value"), F.col("x.bits").alias("spelled"))
    priced = open_.join(book, ["field", "value"], "left").groupBy("tbl", "gid", "field", "k").agg(
        (F.sum(F.least("spelled", F.coalesce("code", "spelled"))) + SEPARATOR_BITS * (F.count("*") - 1) + F.when(F.count("*") > 1, DIALECT_BITS).otherwise(0.0)).alias("cost"),
        F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("v"),
    )
    won = priced.groupBy("tbl", "gid", "field").agg(F.min_by("v", F.struct("cost", F.size("v"), "k")).alias("v"))
    return sure.unionByName(won.select("tbl", "gid", "field", F.col("v.value").alias("items")))


def values_of(parsed: DataFrame) -> DataFrame:
    """One row for each value: tbl, gid, field, pos (from 1), item, n_items."""
    return parsed.select("tbl", "gid", "field", F.size("items").alias("n_items"), F.posexplode("items").alias("p", "item")).select(
        "tbl", "gid", "field", (F.col("p") + 1).cast(T.IntegerType()).alias("pos"), "item", "n_items"
    )
