"""Variant spellings of names of people and organisations.

Names are folded (case, accents, titles, legal forms, spacing), and equal foldings become one representative. The tokens that
tell names apart go into a symmetric-delete index: a token and each of its deletions within the edit distance are keys, so that
two tokens within the distance share one; an equi-join on the keys gives all of them, and distances are verified. Representatives
whose telling tokens are near meet, and are compared by the optimal assignment of all their tokens (dynamic programming over
subsets for short lists, shortest augmenting paths for long ones; both exact), which permits initials, short forms of given names,
abbreviations and reordering.

Candidates of organisations are complete, however common their words are. Where two names agree word by word, every word of one has
a partner in the other, so one word of each name, the one whose partners stand in the fewest names, is looked up among all words of
all names. Where they agree as one string, they share a key of the string's own index.

The result is a membership (id to representative) and pairs of representatives, so a name that a third of all ids bear is one
representative with many members; only ``links`` expands both into pairs of ids.

Cases: null and blank names, and names without letters, link to nothing; ids with equal foldings are one name; several names of
one id are all compared; a family name alone links only to itself; names of any number of tokens are compared whole.
"""

from __future__ import annotations

import re
import unicodedata
from hashlib import blake2b
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.given_names import GIVEN, SHORT
from graphloom.session import cut

#: A word of organisations' names that stands in so many names or fewer is a key by itself, a commoner one only together with the
#: first letters of the name's other words.
RARE = 50
#: From so many words on, the number of the words stands for their first letters, and from so many letters on, pieces of a string for
#: its deletions: both are as complete, and do not grow with the square or the cube of a name's length.
MANY_WORDS, LONG = 13, 64
#: From these lengths on, one and two edits are permitted.
ONE_EDIT, TWO_EDITS = 5, 8

# What stands beside a person's name, words that name kinds of organisations, and words without weight in them.
TITLES = frozenset("dr prof professor mr mrs ms miss sir dame herr frau mme m phd md jr sr".split())
KINDS = frozenset("academy association bureau centre center college committee council department faculty foundation group institute laboratory library museum network observatory office school society station university".split())
WEIGHTLESS = frozenset("of for the and de der des du la le fur für et y e v ev gmbh inc ltd llc co".split())
_SPECIAL = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "þ": "th"})
_GIVEN = frozenset(g.lower() for g in GIVEN)


def fold(name: str) -> str:
    """Small letters without accents."""
    plain = unicodedata.normalize("NFKD", name.lower().translate(_SPECIAL))
    return "".join(c for c in plain if not unicodedata.combining(c))


def full_names(given: str) -> frozenset[str]:
    """The given name itself and the full names it can be short for."""
    return frozenset([given, *SHORT.get(given, "").split()])


def tokens(name: str | None, kind: str) -> list[str]:
    """Tokens of a name, the family name of a person first where a comma tells it."""
    text = fold(name or "")
    if kind == "person":
        # a hyphen inside a name is spelled as one word or not at all
        text = re.sub(r"(?<=\w)[-’'](?=\w)", "", text)
        initials = [m.lower() for m in re.findall(r"(?:^|[\s,])([A-ZÀ-Þ]{2,3})\.?(?=$|[\s,])", name or "")] if not (name or "").isupper() else []
        found = [t for t in re.findall(r"[^\W\d_]+", text) if t not in TITLES or len(t) == 1]
        out: list[str] = []
        for t in found:
            out += list(t) if t in initials and len(t) <= 3 else [t]
        return out
    text = re.sub(r"\be\. ?v\.", " ", text)
    # a short word with a full stop keeps it: it is an abbreviation, which tells no name apart
    return [t + "." * (dot != "" and len(t) <= 5) for t, dot in re.findall(r"([^\W_]+)(\.?)", text) if t not in WEIGHTLESS]


def kind_of(name: str | None, kind: str | None) -> str | None:
    """person or organization, by the entity type or, where that is missing, by the look of the name."""
    k = (kind or "").strip().lower()
    if k in ("person", "organization", "organisation"):
        return "person" if k == "person" else "organization"
    if k not in ("", "unknown"):
        return None
    words = re.findall(r"[^\W\d_]+", fold(name or ""))
    if any(w in KINDS for w in words) or any(1 < len(w) < len(k) and k.startswith(w) for w in words for k in KINDS if len(w) >= 3):
        return "organization"
    full = [w for w in words if w not in TITLES and len(w) > 1]
    capital = [w for w in re.findall(r"[^\W\d_]+", name or "") if w[0].isupper()]
    if 1 <= len(full) <= 3 and (any(w in _GIVEN or w in SHORT for w in full) or len(full) == 1 and len(words) > 1 and len(capital) == len(words)):
        return "person"
    return None


def folded(name: str | None, kind: str) -> str:
    return " ".join(tokens(name, kind))


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with neighbouring transpositions, or most + 1 if it is greater."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return last[-1]


def permitted(n: int) -> int:
    return 2 if n >= TWO_EDITS else 1 if n >= ONE_EDIT else 0


def deletions(token: str, edits: int) -> set[str]:
    """The token and everything that deleting up to so many letters leaves."""
    out, layer = {token}, {token}
    for _ in range(edits):
        layer = {t[:i] + t[i + 1 :] for t in layer for i in range(len(t))}
        out |= layer
    return out


NO = 99.0


def _given_cost(a: str, b: str) -> float:
    if a == b:
        return 0.0
    fa, fb = full_names(a), full_names(b)
    if len(a) == 1 or len(b) == 1:
        one, other = (a, fb) if len(a) == 1 else (b, fa)
        return 0.3 if any(f[0] == one for f in other) else NO
    if fa & fb:
        return 0.1
    d = min(distance(x, y, 2) for x in fa for y in fb)
    return 0.5 * d if d <= max(1, permitted(max(len(a), len(b)))) and min(len(a), len(b)) >= 3 and not (a in _GIVEN and b in _GIVEN) else NO


def _word_cost(a: str, b: str) -> float:
    if a == b:
        return 0.0
    short, long_ = sorted((a, b), key=len)
    if len(short) >= 2 and len(long_) - len(short) >= 2 and short[0] == long_[0]:
        at = 0
        for c in long_:
            at += at < len(short) and c == short[at]
        if at == len(short) and (long_.startswith(short) or len(short) <= 5):
            return 0.2
    d = distance(a, b, 2)
    return 0.5 * d if d <= permitted(len(short)) else NO


def _augmenting(cost: list[list[float]], left: list[float], right: list[float]) -> float:
    """``assignment`` by shortest augmenting paths with potentials, cubic in the number of tokens. The square matrix has a column
    for each row's being unpaired, and a row for each column's."""
    n, m = len(left), len(right)
    size, far = n + m, NO * (n + m + 1)

    def price(i: int, j: int) -> float:
        if i < n:
            return min(cost[i][j], far) if j < m else left[i]
        return right[j] if j < m else 0.0

    u, v, match = [0.0] * (size + 1), [0.0] * (size + 1), [0] * (size + 1)
    for i in range(1, size + 1):
        match[0], at = i, 0
        least, before, used = [float("inf")] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        while match[at]:
            used[at] = True
            row, step, to = match[at], float("inf"), 0
            for j in range(1, size + 1):
                if used[j]:
                    continue
                c = price(row - 1, j - 1) - u[row] - v[j]
                if c < least[j]:
                    least[j], before[j] = c, at
                if least[j] < step:
                    step, to = least[j], j
            for j in range(size + 1):
                if used[j]:
                    u[match[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            at = to
        while at:
            match[at] = match[before[at]]
            at = before[at]
    return sum(price(match[j] - 1, j - 1) for j in range(1, size + 1))


#: Longest list of tokens for which subsets are faster than augmenting paths.
SUBSETS = 8


def assignment(cost: list[list[float]], left: list[float], right: list[float]) -> float:
    """The least cost of pairing rows with columns, where unpaired ones cost ``left`` and ``right``; NO or more if there is none."""
    n, m = len(left), len(right)
    if max(n, m) > SUBSETS:
        return _augmenting(cost, left, right)
    best = {0: 0.0}
    for i in range(n):
        new: dict[int, float] = {}
        for mask, c in best.items():
            skip = c + left[i]
            if skip < new.get(mask, NO):
                new[mask] = skip
            for j in range(m):
                if not mask >> j & 1 and cost[i][j] < NO:
                    v = c + cost[i][j]
                    if v < new.get(mask | 1 << j, NO):
                        new[mask | 1 << j] = v
        best = new
    return min((c + sum(right[j] for j in range(m) if not mask >> j & 1) for mask, c in best.items()), default=NO)


def _families(t: list[str]) -> list[int]:
    """Places that can hold the family name: full words, those that are no given name if there are any."""
    full = [i for i, x in enumerate(t) if len(x) > 1]
    unknown = [i for i in full if t[i] not in _GIVEN and t[i] not in SHORT]
    return unknown or full


def same_person(a: list[str], b: list[str], more: int = 0) -> bool:
    """Whether two token lists can be spellings of one person's name. ``more``: edits of the family name beyond the permitted."""
    if len(a) < 2 or len(b) < 2:
        return a == b and bool(a)
    for i in _families(a):
        for j in _families(b):
            x, y = a[i], b[j]
            most = permitted(min(len(x), len(y))) + more
            d = 0 if x == y else distance(x, y, most)
            if d > most:
                continue
            d = max(0, d - more)
            ga, gb = a[:i] + a[i + 1 :], b[:j] + b[j + 1 :]
            # an unpaired initial is a middle name left out; an unpaired given name is another person
            cost = [[_given_cost(p, q) for q in gb] for p in ga]
            free = lambda g: [0.4 if len(p) == 1 else NO for p in g]
            c = assignment(cost, free(ga), free(gb))
            paired_initials = [p for p in ga if len(p) == 1] and [q for q in gb if len(q) == 1]
            full = any(len(p) > 1 for p in ga) and any(len(q) > 1 for q in gb)
            # two middle initials that do not pair are two people
            if paired_initials and c >= 0.8 and full and not set(ga) & set(gb):
                continue
            if c < 2.0 and (d < 2 or full or more) and c + 0.5 * d <= 2.0:
                return True
    return False


def same_organization(a: list[str], b: list[str]) -> bool:
    """Whether two token lists can be spellings of one organisation's name."""
    a, b = [t.rstrip(".") for t in a], [t.rstrip(".") for t in b]
    if not a or not b:
        return False
    x, y = "".join(sorted(a)), "".join(sorted(b))
    if abs(len(a) - len(b)) <= 1 and distance("".join(a), "".join(b), 2) <= 2 and (len(x) >= 8 or x == y):
        return True
    if len(a) != len(b):
        return False
    c = assignment([[_word_cost(p, q) for q in b] for p in a], [NO] * len(a), [NO] * len(b))
    return c <= 1.5


def others(word: str, first: list[str]) -> str:
    """First letters of a name's words other than one, sorted, as part of a key. first: those of all words."""
    if len(first) >= MANY_WORDS:
        return str(len(first))
    rest = sorted(first)
    rest.remove(word[0])
    return "".join(rest)


def initials(own: list[str], near: list[list[str]]) -> dict[str, int]:
    """First letters of words, sorted, and in how many places they were changed: the words' own, and with up to three words (edits
    that a match permits) under another letter that a word near them begins with."""
    out: dict[str, int] = {}
    places = [i for i, c in enumerate(own) if any(x != c for x in near[i])]
    for k in range(min(3, len(places)) + 1):
        for at in combinations(places, k):
            for other in product(*([c for c in near[i] if c != own[i]] for i in at)):
                letters = list(own)
                for i, c in zip(at, other, strict=True):
                    letters[i] = c
                out.setdefault("".join(sorted(letters)), k)
    return out


def longer(word: str) -> set[str]:
    """What ``shorter`` can be of the abbreviations of a word."""
    first, last = {c: i for i, c in reversed(list(enumerate(word[1:])))}, {c: i for i, c in enumerate(word[1:])}
    out = {word[0] + c for c in first} | {word[0] + c + e for c in first for e in last if first[c] < last[e]}
    return out | {word[:n] for n in range(6, len(word) - 1)}


def shorter(word: Column) -> Column:
    """The key of an abbreviation: its first two letters and the last one, or from six letters on, where it begins the word, all."""
    return F.when(F.length(word).between(3, 5), F.concat(F.substring(word, 1, 2), F.substring(word, -1, 1))).otherwise(word)


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)


def spellings(text: str) -> np.ndarray:
    """Numbers of which two texts share one if ``same_organization`` takes them for one string: they are within two edits, and below
    eight letters have the same letters. Up to LONG letters they stand for the text without any two of them (the text as a polynomial
    modulo 2 ** 64, so that a deletion is a subtraction and a shift); longer texts are cut in five, and as an edit touches two pieces
    at most, one of them stands whole in the other text, at most two letters from its place."""
    n, out = len(text), []

    def number(x: str) -> int:
        return int.from_bytes(blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")

    if n < 8:
        out.append(np.array([number("letters " + "".join(sorted(text)))], dtype=np.uint64))
    if 6 <= n <= LONG + 2:
        power = np.cumprod(np.full(n, _BASE, dtype=np.uint64))
        upto = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(np.array([ord(c) for c in text], dtype=np.uint64) * power)])
        once, twice = (np.array([x % 2**64], dtype=np.uint64) for x in (_BACK, _BACK * _BACK))
        i, j = np.triu_indices(n, 1)
        out += [upto[-1:], upto[:-1] + (upto[-1:] - upto[1:]) * once, upto[i] + (upto[j] - upto[i + 1]) * once + (upto[-1:] - upto[j + 1]) * twice]
    if n > LONG:
        found = set()
        for size in range(n - 2, n + 3):
            ends = [size * k // 5 for k in range(6)]
            for k in range(5):
                for at in range(max(0, ends[k] - 2), ends[k] + 3):
                    piece = text[at : at + ends[k + 1] - ends[k]]
                    if len(piece) == ends[k + 1] - ends[k]:
                        found.add(number(f"{size} {k} {piece}"))
        out.append(np.array(sorted(found), dtype=np.uint64))
    return np.unique(np.concatenate(out)).view(np.int64)


def members(named: DataFrame) -> DataFrame:
    """(tbl, id, kind, rep): the representative of each id's names. named: tbl, id, name, kind (person or organization)."""

    @F.pandas_udf("string")
    def fold_all(names: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series([folded(n, k) for n, k in zip(names, kinds, strict=True)], dtype=object)

    return named.where("name is not null").select("tbl", "id", "kind", fold_all("name", "kind").alias("rep")).where("rep <> ''").distinct()


def variants(named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): tbl, id, kind, rep, and tbl, kind, rep_a, rep_b of representatives that are spellings of one name."""
    reps = cut(members(named))
    return reps, matched(reps.select("tbl", "kind", "rep").distinct())


def links(named: DataFrame) -> DataFrame:
    """(tbl, id_a, id_b) of each two ids with variants of one name: the pairs and memberships of ``variants``, expanded."""
    reps, pairs = variants(named)
    a = reps.select("tbl", "kind", F.col("rep").alias("rep_a"), F.col("id").alias("x"))
    b = reps.select("tbl", "kind", F.col("rep").alias("rep_b"), F.col("id").alias("y"))
    near = pairs.join(a, ["tbl", "kind", "rep_a"]).join(b, ["tbl", "kind", "rep_b"])
    equal = a.withColumnRenamed("rep_a", "rep").join(b.withColumnRenamed("rep_b", "rep"), ["tbl", "kind", "rep"])
    both = near.select("tbl", "x", "y").unionByName(equal.select("tbl", "x", "y")).where("x <> y")
    return both.select("tbl", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def matched(words: DataFrame) -> DataFrame:
    """(tbl, kind, rep_a, rep_b) of matching representatives, rep_a < rep_b. words: tbl, kind, rep (distinct)."""

    @F.pandas_udf("array<struct<token string, spot string>>")
    def telling(reps: pd.Series, kinds: pd.Series) -> pd.Series:
        """Tokens that can tell a person apart, each with the letters its other names can begin with (a long given name can have
        two edits among its first three letters), and all words of organisations, each with the first letters of the others."""
        out = []
        for rep, kind in zip(reps, kinds, strict=True):
            t = rep.split(" ")
            if kind == "person":
                rows = []
                for i in _families(t) or range(len(t)):
                    spots = {c for k, g in enumerate(t) if k != i for f in full_names(g) for c in f[: 3 if len(f) >= TWO_EDITS - 2 else 2]} or {""}
                    rows += [(t[i], s) for s in sorted(spots)]
                out.append(rows)
            else:
                t = [x.rstrip(".") for x in t]
                out.append([(x, others(x, [w[0] for w in t])) for x in dict.fromkeys(t)])
        return pd.Series(out)

    told = words.withColumn("id", F.monotonically_increasing_id()).select("tbl", "kind", "rep", "id", F.posexplode(telling("rep", "kind")).alias("at", "t"))
    told = cut(told.select("tbl", "kind", "rep", "id", "at", "t.token", "t.spot"))
    vocabulary = told.groupBy("tbl", "kind", "token").agg(F.count("*").alias("n"))

    @F.pandas_udf("array<string>")
    def keys(tokens_: pd.Series) -> pd.Series:
        return pd.Series([sorted(deletions(t, permitted(len(t) + permitted(len(t))))) for t in tokens_])

    @F.pandas_udf("array<string>")
    def long_forms(tokens_: pd.Series) -> pd.Series:
        return pd.Series([sorted(longer(t)) for t in tokens_])

    indexed = vocabulary.select("tbl", "kind", "token", F.explode(keys("token")).alias("key"))
    # the tables of keys are many times as large as their estimates, so none is broadcast
    met = indexed.join(indexed.withColumnRenamed("token", "other").hint("merge"), ["tbl", "kind", "key"]).where("token < other").select("tbl", "kind", "token", "other")
    institutions = vocabulary.where("kind = 'organization'").select("tbl", "kind", "token")
    short = institutions.where("length(token) >= 2").withColumn("key", shorter(F.col("token")))
    long_ = institutions.where("length(token) >= 4").select("tbl", "kind", F.col("token").alias("other"), F.explode(long_forms("token")).alias("key"))
    abbreviated = short.join(long_.hint("merge"), ["tbl", "kind", "key"]).where("length(token) + 2 <= length(other)").select("tbl", "kind", "token", "other")

    @F.pandas_udf("boolean")
    def near(kinds: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        person = lambda a, b: distance(a, b, 2) <= max(1, permitted(min(len(a), len(b))))
        return pd.Series([person(a, b) if k == "person" else _word_cost(a, b) < NO for k, a, b in zip(kinds, x, y, strict=True)], dtype=bool)

    same = vocabulary.select("tbl", "kind", "token", F.col("token").alias("other"))
    index = cut(met.unionByName(abbreviated).distinct().where(near("kind", "token", "other")).unionByName(same))
    # organisations: each word with all its partners, and in how many names they stand
    back = index.where("token <> other").select("tbl", "kind", F.col("other").alias("token"), F.col("token").alias("other"))
    partners = index.unionByName(back).where("kind = 'organization'").join(vocabulary.withColumnRenamed("token", "other"), ["tbl", "kind", "other"])
    partners = cut(partners.select("tbl", "kind", "token", "other", "n"))
    dear = partners.groupBy("tbl", "token").agg(F.sum("n").alias("n"))
    chosen = told.where("kind = 'organization'").join(dear, ["tbl", "token"]).groupBy("tbl", "rep").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    sought = chosen.join(partners, ["tbl", "token"])
    # the letters that the other words of names with common partners can begin with; abbreviations keep the first one
    letters = partners.where("left(token, 1) <> left(other, 1)").groupBy("tbl", "token").agg(F.collect_set(F.substring("other", 1, 1)).alias("near"))
    spread = sought.where(F.col("n") > RARE).select("tbl", "rep", F.col("token").alias("key")).distinct()
    spread = spread.select("tbl", "rep", "key", F.posexplode(F.split(F.translate("rep", ".", ""), " ")).alias("at", "token")).join(letters, ["tbl", "token"], "left")
    spread = spread.select("tbl", "rep", "key", F.struct("at", "token", F.coalesce("near", F.array().cast("array<string>")).alias("near")).alias("w"))
    spread = spread.groupBy("tbl", "rep", "key").agg(F.sort_array(F.collect_list("w")).alias("w"))

    @F.pandas_udf("array<struct<spot string, changed int>>")
    def by_letters(key: pd.Series, own: pd.Series, near: pd.Series) -> pd.Series:
        out = []
        for word, t, x in zip(key, own, near, strict=True):
            at = list(t).index(word)
            rest = [(w[0], sorted(c)) for i, (w, c) in enumerate(zip(t, x, strict=True)) if i != at]
            few = len(t) < MANY_WORDS
            out.append(sorted(initials([w for w, _ in rest], [c for _, c in rest]).items()) if few else [(others(word, [w[0] for w in t]), 0)])
        return pd.Series(out)

    spread = spread.select("tbl", "rep", F.col("key").alias("token"), F.explode(by_letters("key", F.col("w")["token"], F.col("w")["near"])).alias("s"))
    # three edits cost as much as a match permits: where the word itself is changed, two are left
    common = sought.where(F.col("n") > RARE).join(spread, ["tbl", "rep", "token"]).where("s.changed <= if(token = other, 3, 2)").select("tbl", "other", "s.spot", F.col("rep").alias("rep_a"))
    alone = sought.where(F.col("n") <= RARE).select("tbl", "other", F.lit("").alias("spot"), F.col("rep").alias("rep_a"))
    held = told.where("kind = 'organization'").join(vocabulary, ["tbl", "kind", "token"])
    held = held.select("tbl", F.col("token").alias("other"), F.when(F.col("n") <= RARE, "").otherwise(F.col("spot")).alias("spot"), F.col("rep").alias("rep_b"))
    by_word = alone.unionByName(common).join(held, ["tbl", "other", "spot"]).select("tbl", "rep_a", "rep_b")

    @F.pandas_udf("array<bigint>")
    def by_string(texts: pd.Series) -> pd.Series:
        return pd.Series([spellings(t) for t in texts])

    # a name has hundreds of keys, so they are shuffled with a number instead of the name
    once = told.where("kind = 'organization' and at = 0").select("tbl", "id", "rep")
    strings = once.select("id", F.explode(by_string(F.translate("rep", " .", ""))).alias("key"), "tbl").select("id", F.xxhash64("tbl", "key").alias("key"))
    ids = strings.join(strings.withColumnRenamed("id", "with").hint("merge"), "key").where("id < with").select("id", "with").distinct()
    by_spelling = ids.join(once.withColumnRenamed("rep", "rep_a"), "id").join(once.select("tbl", F.col("id").alias("with"), F.col("rep").alias("rep_b")), ["tbl", "with"]).select("tbl", "rep_a", "rep_b")
    persons = told.where("kind = 'person'")
    left = persons.select("tbl", "kind", "spot", "token", F.col("rep").alias("rep_a"))
    right = persons.select("tbl", "kind", "spot", F.col("token").alias("other"), F.col("rep").alias("rep_b"))
    pairs = left.join(index, ["tbl", "kind", "token"]).join(right, ["tbl", "kind", "other", "spot"]).select("tbl", "kind", "rep_a", "rep_b")
    pairs = pairs.unionByName(by_word.unionByName(by_spelling).withColumn("kind", F.lit("organization")))
    ordered = pairs.where("rep_a <> rep_b").select("tbl", "kind", F.least("rep_a", "rep_b").alias("rep_a"), F.greatest("rep_a", "rep_b").alias("rep_b")).distinct()
    # the comparison costs far more than the rows weigh, so its tasks are not merged by size
    ordered = ordered.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rep_a", "rep_b")

    @F.pandas_udf("boolean")
    def agree(kinds: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        test = {"person": same_person, "organization": same_organization}
        return pd.Series([test[k](a.split(" "), b.split(" ")) for k, a, b in zip(kinds, x, y, strict=True)], dtype=bool)

    # a deterministic filter would go below the exchange and the distinct, to the joins' few tasks and repeated pairs
    direct = cut(ordered.where(agree.asNondeterministic()("kind", "rep_a", "rep_b")))
    # two misspellings of one person can be further apart than each is from the name between them
    people = direct.where("kind = 'person'")
    ways = people.select("tbl", F.col("rep_a").alias("rep"), F.col("rep_b").alias("via")).unionByName(people.select("tbl", F.col("rep_b").alias("rep"), F.col("rep_a").alias("via")))
    two = ways.join(ways.withColumnRenamed("rep", "end"), ["tbl", "via"]).where("rep < end").select("tbl", F.lit("person").alias("kind"), F.col("rep").alias("rep_a"), F.col("end").alias("rep_b")).distinct()
    two = two.join(people, ["tbl", "kind", "rep_a", "rep_b"], "left_anti")

    @F.pandas_udf("boolean")
    def close(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([same_person(a.split(" "), b.split(" "), 2) for a, b in zip(x, y, strict=True)], dtype=bool)

    return direct.unionByName(two.where(close("rep_a", "rep_b")))
