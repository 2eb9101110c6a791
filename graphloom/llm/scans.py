"""Repair of text read from scanned pages: page furniture, words cut over two lines, and misread words.

Furniture is found line by line: printed page numbers, and running titles. Series with volume, proceedings and letter-spaced
titles are running titles by their form. Forms that headings share (chapter, capitals, ``Name: subject``) need evidence of the page
besides: a page number on or beside the line, a sentence that goes on across it, an edge of a page of wrapped or misread lines; and
any title-like line is one if it comes back in another chunk of the same file. Other headings stay. Half words are joined over line
ends, also across furniture, unless the corpus writes the compound with its hyphen.
Tokens meet a trie of the known words that can begin like them: a bit-parallel Levenshtein automaton walks the trie and returns
every known word in reach; those whose differences are all confusions of similar shapes are candidates, and the preceding word (by
pair counts of the corpus), then frequency, ranks them.

Cases: null, empty and blank texts come back as they are, with no kind; a page that is only furniture becomes an empty text;
repeated rows give equal results; words never meet a candidate that is rarer than themselves; very long lines are no titles.
"""

from __future__ import annotations

import bisect
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.session import cut

#: A word can be a candidate from this many occurrences, and must be so many times as frequent as the misreading.
KNOWN, RATIO = 5, 8
#: How many times as often as its confusion's rate a word may stand and still be a misreading.
SLACK = 6.0
#: The share of its occurrences that must stand where its candidate also stands.
SAME_PLACE = 0.7
#: Standard deviations that chance may add to the expected number, and take from that share.
CHANCE = 3.0
#: Known words in one shard of the vocabulary's trie, and tokens in one block that asks it, each over all first letters.
SHARD_WORDS, ASKED_ROWS = 100_000, 200_000
#: Bits of the filter of misread tokens (half a megabyte at most): only tokens that pass it leave a text's scan.
FILTER_BITS = 1 << 22

# Characters that scanners read for others (read -> meant).
CONFUSIONS = {
    "0": "o", "1": "li", "!": "il", "|": "li", "@": "a", "5": "s", "6": "b", "9": "g", "8": "b", "c": "e", "e": "c", "b": "h", "h": "b", "u": "n",
    "n": "u", "l": "i", "i": "l", "I": "l", "t": "f", "f": "t", "q": "g", "y": "v", "v": "y", "rn": "m", "m": "rn", "vv": "w", "li": "h", "ii": "u",
    "cl": "d", "nn": "m", "ri": "n", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st",
}
#: Meant strings of each read string; single-character entries list alternatives, digraph targets are one string.
_MEANT = {k: ([v] if len(k) > 1 or k in "mﬀﬁﬂﬃﬄﬅﬆ" else list(v)) for k, v in CONFUSIONS.items()}
_NOISE = "01!|@5698"
_TOKEN = re.compile(r"[\w!|@\u0300-\u036f]+")
_COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
_HYPHENS = "-‐­¬"

_NUMBER = r"\d{1,4}|[ivxlcdm]{1,9}"
_ROMAN = re.compile(r"m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})\Z")
_PAGE = re.compile(rf"(?:[-–—~]\s*(?P<a>{_NUMBER})\s*[-–—~]|(?P<b>\d{{1,4}})\s*/\s*\d{{1,4}}|\[(?P<c>\d{{1,4}})\]|(?:page|seite|página|p\.|pp\.|s\.)\s*(?P<d>{_NUMBER})(?:\s*(?:of|von|de)\s*\d+)?|(?P<e>{_NUMBER}))\Z", re.I)
_EDGE = re.compile(r"^(\d{1,4})(?: {2,}|\t+)(?=\S*[^\W\d])|(?<=\S)(?: {2,}|\t+)(\d{1,4})$")
_CLEAR = str.maketrans({"0": "o", "1": "l", "!": "i", "|": "l", "@": "a", "5": "s", "6": "b", "9": "g"})
_SERIES = re.compile(r"[^.!?]{3,70}, (?:vol|no|nr|bd|issue)(?:\. ?| )\w{1,6}\Z", re.I)
_PROCEEDINGS = re.compile(r"(?:proc(?:eedings)?|trans(?:actions)?|bull(?:etin)?)\b\.? .{3,80}[^.!?,;:]\Z", re.I)
_CHAPTER = re.compile(r"(?:chapter|section|kapitel|chapitre|capítulo|appendix)\s+[\divxl]{1,5}[.:]?\s+[^\W\d].{1,70}[^.!?,;:]\Z", re.I)
_SPACED = re.compile(r"(?:[^\W_] ){4,}[^\W_](?: ?[·•|:–-] ?\S+(?: \S+){0,3})?\Z")
_NAMED = re.compile(r"[A-Z]\w{2,}: [A-Z0-9]\w+(?: \w+){1,4}\Z")
_MARKED = re.compile(r"[<>{}\\#*`\[\]=_]| \| |^\||\|$")
_SIGN_INSIDE = re.compile(r"(?<=[^\W\d])[01!|@569]|[01!|@569](?=[^\W\d])")
_MISREAD_SIGN = re.compile(r"[a-zß-ÿ][01!|@5698][a-zß-ÿ]")
_STOPS = ".!?,;:"

#: What the form of a line says: nothing, a title that headings share, a running title.
PLAIN, SHARED, SURE = 0, 1, 2


def furniture(line: str) -> tuple[int, bool, str]:
    """(form of a title, has a page number, the line without the number) of one line."""
    s = line.strip()
    if not s or len(s) > 110:
        return PLAIN, False, s
    m = _PAGE.match(s) if len(s) <= 24 else None
    if m:
        value = next(v for v in m.groups() if v)
        if value.isdigit() or (_ROMAN.match(value.lower()) and (len(value) > 1 or m.group("a") or m.group("d")) and value.islower()):
            return PLAIN, True, ""
        return PLAIN, False, s
    number = _EDGE.search(s) if "  " in s or "\t" in s else None
    title = _EDGE.sub("", s).strip() if number else s
    # no form ends like a sentence
    if not title or title[-1] in _STOPS or _MARKED.search(title):
        return PLAIN, False, s
    clear = _SIGN_INSIDE.sub(lambda x: x.group().translate(_CLEAR), title)
    if ", " in clear and _SERIES.match(clear) or _PROCEEDINGS.match(clear) or _SPACED.match(title):
        return SURE, bool(number), title
    upper = sum(map(str.isupper, title))
    caps = upper >= 9 and " " in title and upper >= 0.85 * max(10, sum(map(str.isalpha, title)))
    if caps or _CHAPTER.match(clear) or _NAMED.match(clear):
        return SHARED, bool(number), title
    return PLAIN, False, title


def title_like(title: str) -> bool:
    """Whether a line could be a running title if it came back: mostly capital initials, no end of a sentence, no marks."""
    words = title.split()
    return 2 <= len(words) <= 9 and len(title) <= 70 and title[-1] not in ".!?,;:" and not _MARKED.search(title) and sum(w[0].isupper() for w in words) >= 0.7 * len(words) and not title[-1] in _HYPHENS


def skeleton(title: str) -> str:
    """A title without digits and with similar shapes made one, so that its misread copies meet."""
    return re.sub(r"[^a-z]", "", title.lower().translate(_CLEAR).replace("i", "l").replace("c", "e").replace("u", "n").replace("h", "b"))


def _joins(a: str, b: str) -> bool:
    """Whether a sentence goes on from one line to the next."""
    end = a.rstrip()[-1:]
    return bool(end) and (end.isalnum() or end in _HYPHENS + ",") and b.lstrip()[:1].islower()


def page(text: str) -> list[tuple[str, str, str]]:
    """(line, what it is, its title) of every line: ``header``, ``pageno``, ``both`` on one line, ``maybe`` (a title if it comes back)
    or nothing.

    A number of four digits is a page number at an edge of the text or beside a title only, for it can be a year, and numbers in a
    column are none."""
    lines = [(line, *furniture(line)) for line in text.split("\n")]
    full = [i for i, x in enumerate(lines) if x[0].strip()]
    alone = [lines[i][2] and not lines[i][3] for i in full]
    bare = [a and lines[i][0].strip().isdigit() for a, i in zip(alone, full, strict=True)]
    for k, i in enumerate(full):
        beside = [x for x in (k - 1, k + 1) if 0 <= x < len(full)]
        if bare[k] and (any(bare[x] for x in beside) or len(lines[i][0].strip()) > 3 and len(beside) == 2 and not any(lines[full[x]][1] for x in beside)):
            alone[k] = False
    body = [k for k in range(len(full)) if not alone[k] and not lines[full[k]][1]]
    wrapped = misread = None
    kinds = [""] * len(lines)
    for k, i in enumerate(full):
        line, form, number, title = lines[i]
        if alone[k]:
            kinds[i] = "pageno"
        elif form == PLAIN:
            kinds[i] = "maybe" if title and title_like(title) else ""
        else:
            sure = form == SURE or number or any(alone[x] for x in (k - 1, k + 1) if 0 <= x < len(full))
            if not sure:
                at = bisect.bisect(body, k)
                before, after = body[at - 1] if at else None, body[at] if at < len(body) else None
                sure = before is not None and after is not None and _joins(lines[full[before]][0], lines[full[after]][0])
                if not sure and (before is None or after is None):
                    if wrapped is None:
                        wrapped = sum(_joins(lines[full[a]][0], lines[full[b]][0]) for a, b in zip(body, body[1:])) >= 2
                        misread = bool(_MISREAD_SIGN.search(text))
                    sure = wrapped or misread
            kinds[i] = ("both" if number else "header") if sure else "maybe"
    return [(x[0], kind, x[3]) for x, kind in zip(lines, kinds, strict=True)]


_LAST_LETTERS, _FIRST_LETTERS = re.compile(r"[^\W\d_]+\Z"), re.compile(r"[ \t]*([^\W\d_]+)")


def joined(lines: list[str]) -> Iterator[tuple[str, str, int, int]]:
    """(first half, second half, line, next line) of each word cut over two of the lines."""
    last = None
    for i, line in enumerate(lines):
        if not line.strip():
            continue
        if last is not None:
            head = lines[last].rstrip(" \t")
            if head[-1:] in _HYPHENS:
                a, b = _LAST_LETTERS.search(head, 0, len(head) - 1), _FIRST_LETTERS.match(line)
                if a and b and b.group(1)[0].islower():
                    yield a.group(), b.group(1), last, i
        last = i


def suspicious(token: str) -> bool:
    """Whether a token that is unknown may be a misread word at all: three letters or more, and any digits within small
    letters, so that codes and formulas (H2O, B0) are none."""
    letters = sum(c.isalpha() for c in token)
    if len(token) < 3 or letters < 2:
        return False
    if any(c in _NOISE for c in token):
        return not any(c.isupper() for c in token[1:]) and sum(c in _NOISE for c in token) <= letters
    return token[1:].islower()


_SCAN = "id string, doc string, kind string, a string, b string"


def _scan(passing: Callable[[str], bool]):
    """Facts of each text: kind header (a: skeleton), maybe (a: skeleton of a line that is a title if it comes back), pageno, hyphen
    (a, b: halves) and token (a: token of the body that passes a filter by its small letters)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, asked = [], {}
            for key, doc, text in zip(batch["id"], batch["doc"], batch["content"], strict=True):
                if not text or text.isspace():
                    continue
                seen, body = set(), []
                for line, kind, title in page(text):
                    if kind in ("header", "both"):
                        seen.add(("header", skeleton(title), None))
                    if kind in ("pageno", "both"):
                        seen.add(("pageno", None, None))
                    if kind == "maybe":
                        seen.add(("maybe", skeleton(title), None))
                    if kind in ("", "maybe"):
                        body.append(line)
                halves = list(joined(body))
                seen.update(("hyphen", a, b) for a, b, _, _ in halves)
                for a, b, i, j in halves:  # the halves are no words
                    body[i] = body[i].rstrip()[: -len(a) - 1]
                    body[j] = body[j].replace(b, a + b, 1)
                for w in set(_TOKEN.findall("\n".join(body))):
                    wanted = asked.get(w)
                    if wanted is None:
                        wanted = asked[w] = passing(w.lower()) and suspicious(w)
                    if wanted:
                        seen.add(("token", w, None))
                out += [(key, doc, *x) for x in seen]
            yield pd.DataFrame(out, columns=["id", "doc", "kind", "a", "b"])

    return work


def token_filter(tokens: DataFrame) -> Callable[[str], bool]:
    """A filter that every token of a one-column table passes, as few bits of checksums: at most FILTER_BITS bits come to the driver,
    however many tokens there are."""
    bit = F.pmod(F.crc32(F.encode(F.col(tokens.columns[0]), "UTF-8")), F.lit(FILTER_BITS))
    rows = tokens.select(F.bitmap_bucket_number(bit + 1).alias("at"), F.bitmap_bit_position(bit + 1).alias("bit")).groupBy("at").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    flags = np.zeros(FILTER_BITS, dtype=np.uint8)
    for r in rows:
        part = np.unpackbits(np.frombuffer(bytes(r["bits"]), dtype=np.uint8), bitorder="little")
        first = (r["at"] - 1) * len(part)
        flags[first : first + len(part)] = part
    packed = tokens.sparkSession.sparkContext.broadcast(np.packbits(flags, bitorder="little").tobytes())

    def passing(word: str) -> bool:
        bit = zlib.crc32(word.encode()) % FILTER_BITS
        return bool(packed.value[bit >> 3] >> (bit & 7) & 1)

    return passing


class Trie:
    """Known words as nested dicts; the key "" holds the word that ends there."""

    def __init__(self, known: list[str]):
        self.root: dict = {}
        for w in known:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def within(self, word: str, distance: int) -> list[str]:
        """Every known word within the edit distance: the automaton's states are bits, one mask for each number of edits, and
        each edge of the trie moves them all at once."""
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | 1 << i
        end, found = 1 << len(word), []
        states = [(1 << (k + 1)) - 1 for k in range(distance + 1)]
        stack = [(self.root, states)]
        while stack:
            node, r = stack.pop()
            if "" in node and any(x & end for x in r):
                found.append(node[""])
            for c, child in node.items():
                if not c:
                    continue
                mask, new, before = masks.get(c, 0), [], 0
                for k in range(distance + 1):
                    x = (r[k] & mask) << 1
                    if k:
                        x |= r[k - 1] | r[k - 1] << 1 | before << 1
                    new.append(x)
                    before = x
                if new[-1]:
                    stack.append((child, new))
        return found


def explains(read: str, meant: str) -> tuple[str, ...] | None:
    """The fewest confusions (read>meant) that make ``meant`` of ``read``, or None if other edits are needed."""
    n, m = len(read), len(meant)
    best: dict[tuple[int, int], tuple[str, ...]] = {(0, 0): ()}

    def reach(i: int, j: int, how: tuple[str, ...]) -> None:
        if (i, j) not in best or len(how) < len(best[i, j]):
            best[i, j] = how

    for i in range(n + 1):
        for j in range(m + 1):
            how = best.get((i, j))
            if how is None:
                continue
            if i < n and j < m and read[i] == meant[j]:
                reach(i + 1, j + 1, how)
            for k in (1, 2):
                for to in _MEANT.get(read[i : i + k], ()) if i + k <= n else ():
                    if meant.startswith(to, j):
                        reach(i + k, j + len(to), (*how, f"{read[i : i + k]}>{to}"))
    return best.get((n, m))


_DIGRAPH = re.compile("rn|vv|li|ii|cl|nn|ri|[ﬀ-ﬆ]|m")


_FOUND = pa.schema([("token", pa.string()), ("seen", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("edits", pa.int32()), ("first", pa.string())])


def beginnings(read: str) -> list[str]:
    """First letters that the word meant by a token can have: its own, and those of what its first signs are read for."""
    return sorted({read[:1], *(to[0] for k in (1, 2) if len(read) >= k for to in _MEANT.get(read[:k], ()))})


def _match(known_rows: pa.Table, asked_rows: pa.Table) -> pa.Table:
    out = []
    if known_rows.num_rows and asked_rows.num_rows:
        known, asked = known_rows.to_pydict(), asked_rows.to_pydict()
        trie, count = Trie(known["word"]), dict(zip(known["word"], known["n"], strict=True))
        for token, n in zip(asked["token"], asked["n"], strict=True):
            noise = sum(c in _NOISE for c in token)
            reach = min(3, max(1, noise, 2 if _DIGRAPH.search(token) else 1, 3 if re.search("[ﬃﬄ]", token) else 1))
            for w in trie.within(token, reach):
                if w == token or count[w] < RATIO * n:
                    continue
                how = explains(token, w)
                if how and (len(how) == 1 or len(how) <= max(1, len(w) // 4) or noise and len(how) <= 2):
                    out.append((token, n, w, count[w], len(how), how[0]))
    return pa.table({name: [x[i] for x in out] for i, name in enumerate(_FOUND.names)}, schema=_FOUND)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        count: Counter[str] = Counter()
        for text in b.column(0).to_pylist():
            low = (text or "").lower()
            count.update(_TOKEN.findall(low))
            if "-" in low:
                count.update(_COMPOUND.findall(low))
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["word", "n"])


def vocabulary(df: DataFrame, text: str = "content") -> DataFrame:
    """(word, n): tokens in small letters, and compounds with an inner hyphen; counted in the batches, then before the shuffle."""
    return df.select(text).mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def candidates(suspects: DataFrame, known: DataFrame) -> DataFrame:
    """(token, seen, word, n, edits, first): all candidates of each suspicious token (token, n).

    The vocabulary lies in shards by first letter and hash, the tokens in blocks, both of a bounded size, and a token goes only to the
    shards of letters that its word can begin with. A token that is too frequent for any word is not asked."""

    @F.pandas_udf("array<string>")
    def begins(tokens_: pd.Series) -> pd.Series:
        return pd.Series([beginnings(t) if suspicious(t) else [] for t in tokens_])

    sizes = known.agg(F.count("*").alias("words"), F.coalesce(F.max("n"), F.lit(0)).alias("most")).first()
    suspects = suspects.where((F.col("n") * RATIO <= sizes["most"]) & (F.length("token") >= 3) & F.col("token").rlike(r"\p{L}.*\p{L}"))
    shards, blocks = max(1, -(-sizes["words"] // SHARD_WORDS)), max(1, -(-suspects.count() // ASKED_ROWS))
    # the tries are costly and their rows small, so the number of tasks is given and not merged by size
    tasks = max(int(suspects.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards * blocks)
    keys = ["letter", "shard", "block"]
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    own = lambda c, n, name: F.pmod(F.xxhash64(c), F.lit(n)).cast("int").alias(name)
    k = known.select("word", "n", F.substring("word", 1, 1).alias("letter"), own("word", shards, "shard"), every(blocks, "block")).repartition(tasks, *keys)
    s = suspects.select("token", "n", F.explode(begins("token")).alias("letter"), own("token", blocks, "block"))
    s = s.select("token", "n", "letter", every(shards, "shard"), "block").repartition(tasks, *keys)
    return k.groupBy(*keys).cogroup(s.groupBy(*keys)).applyInArrow(_match, "token string, seen long, word string, n long, edits int, first string")


_BEFORE = re.compile(r"(?:[^\W\d_]+|[^\w\s!|@])\Z")


def _pairs(passing: Callable[[str], bool]):
    """(before, word, pairs) of a batch of texts: how often a word that passes a filter follows white space after a word or a sign."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[str, tuple[str | None, str | None]] = {}
            count: Counter[tuple[str, str]] = Counter()
            for text in b.column(0).to_pylist():
                before = None
                for part in (text or "").lower().split():
                    it = seen.get(part)
                    if it is None:
                        end, first = _BEFORE.search(part), _TOKEN.match(part)
                        word = first.group() if first else None
                        it = seen[part] = end and end.group(), word if word and passing(word) else None
                    if before and it[1]:
                        count[before, it[1]] += 1
                    before = it[0]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in count], pa.string()), pa.array([w for _, w in count], pa.string()), pa.array(list(count.values()), pa.int64())], names=["before", "word", "pairs"])

    return work


def contexts(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """Adds to candidates (token, word, ...) how many of the token's occurrences follow a word or a sign (placed), how many of those
    follow one that also stands before the candidate twice or more in the corpus (same), and the share of these. Pairs are counted
    for the tokens and candidates alone, in the batches first."""
    asked = found.select(F.explode(F.array("token", "word")).alias("word")).distinct()
    pairs = chunks.select("content").mapInArrow(_pairs(token_filter(asked)), "before string, word string, pairs long")
    pairs = cut(pairs.join(asked, "word", "left_semi").groupBy("before", "word").agg(F.sum("pairs").alias("pairs")))
    own = pairs.select("before", F.col("word").alias("token"), F.col("pairs").alias("mine")).join(found.select("token", "word"), "token")
    same = F.sum(F.when(F.col("pairs") >= 2, F.col("mine")).otherwise(0))
    near = own.join(pairs, ["before", "word"], "left").groupBy("token", "word").agg(F.sum("mine").alias("placed"), same.alias("same"))
    return found.join(near, ["token", "word"], "left").na.fill(0, ["placed", "same"]).withColumn("share", F.col("same") / F.greatest("placed", F.lit(1)))


def misread(placed: DataFrame) -> DataFrame:
    """Of candidates with their places, those that are misreadings, whatever their counts. A confusion's rate is that of all its
    candidates (seen over the candidate's n) that stand where these stand. A token without signs of noise counts if its number is
    within SLACK times that rate and chance, and if its places are the candidate's, but for chance: a token that has no places has
    nothing against it. Of several confusions the first sets the limit, since they are no more frequent together."""
    there = F.col("same") >= SAME_PLACE * F.col("placed") - CHANCE * F.sqrt(SAME_PLACE * (1 - SAME_PLACE) * F.col("placed"))
    # one row a confusion
    rates = placed.where((F.col("edits") == 1) & there).groupBy("first").agg((F.sum("seen") / F.sum("n")).alias("rate"))
    expected = SLACK * F.coalesce("rate", F.lit(0.0)) * F.col("n")
    likely = F.col("seen") <= expected + CHANCE * F.sqrt(expected) + CHANCE
    return placed.join(F.broadcast(rates), "first", "left").where(F.col("token").rlike(f"[{_NOISE}]") | likely & there)


def corrections(chunks: DataFrame, counts: DataFrame) -> DataFrame:
    """(token, word, n, edits, share) of the tokens that are misread."""
    known = counts.where((F.col("n") >= KNOWN) & F.col("word").rlike(r"^\p{L}{3,}$"))
    found = cut(candidates(counts.where(~F.col("word").contains("-")).withColumnRenamed("word", "token"), known))
    return cut(misread(cut(contexts(chunks, found))).select("token", "word", "n", "edits", "share"))


def facts(chunks: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(facts, counts, corrections) of chunks (id, doc, content). The facts without correct words are small, and lie in the shared
    folder, because several branches read them."""
    counts = cut(vocabulary(chunks))
    found = corrections(chunks, counts)
    raw = cut(chunks.mapInPandas(_scan(token_filter(found.select("token"))), _SCAN))
    # what passes the filter is exact after this join; facts without a token take no part in it
    tokens = raw.where("kind = 'token'").withColumn("read", F.lower("a")).join(found.select(F.col("token").alias("read")).distinct(), "read", "left_semi")
    return raw.where("kind <> 'token'").withColumn("read", F.lit(None).cast("string")).unionByName(tokens), counts, found


def kinds(chunks: DataFrame) -> DataFrame:
    """(id, kind): hyphen, misread, header and pageno, once for each chunk that holds one. chunks: id, doc, content."""
    kept, counts, _ = facts(chunks)
    misread = kept.where("kind = 'token'").select("id", F.lit("misread").alias("kind"))
    halves = kept.where("kind = 'hyphen'").select("id", F.lower(F.concat("a", "b")).alias("whole"), F.lower(F.concat_ws("-", "a", "b")).alias("compound"))
    c = counts.where("n >= 2")
    halves = halves.join(c.select(F.col("word").alias("whole"), F.lit(True).alias("w")), "whole", "left").join(c.select(F.col("word").alias("compound"), F.lit(True).alias("c")), "compound", "left")
    hyphen = halves.where("w is not null or c is null").select("id", F.lit("hyphen").alias("kind"))
    titles = kept.where("kind in ('header', 'maybe')").select("id", "doc", "kind", F.col("a").alias("title"))
    again = titles.groupBy("doc", "title").agg(F.countDistinct("id").alias("n")).where("n > 1 and length(title) > 5").drop("n")
    header = titles.where("kind = 'header'").select("id", "kind").unionByName(titles.where("kind = 'maybe'").join(again, ["doc", "title"], "left_semi").select("id", F.lit("header").alias("kind")))
    return misread.unionByName(hyphen).unionByName(header).unionByName(kept.where("kind = 'pageno'").select("id", "kind")).distinct()


def mend(text: str | None, titles: list[str] | None, fixes: dict[str, str] | None, whole: set[str] | None) -> str | None:
    """A text without its furniture (lines by form, and those whose skeleton is in ``titles``), with the halves joined (keeping the
    hyphen of compounds in ``whole``), misread words put right, and lines reflowed into paragraphs. A text without any of the
    noise keeps its lines."""
    if not text or text.isspace():
        return text
    known, body, dropped = set(titles or ()), [], False
    for line, kind, title in page(text):
        if kind in ("header", "pageno", "both") or kind == "maybe" and skeleton(title) in known:
            dropped = True
        else:
            body.append(line)
    halves = list(joined(body))
    for a, b, i, j in reversed(halves):
        keep = f"{a}-{b}".lower() in (whole or ())
        head = body[i].rstrip()[: -len(a) - 1].rstrip("\n")
        rest = body[j].lstrip()[len(b) :]
        tail = re.match(r"\S*", rest).group()
        body[i], body[j] = f"{head}{a}{'-' if keep else ''}{b}{tail}", rest[len(tail) :].lstrip()
    out = "\n".join(body)
    if fixes:
        def right(m: re.Match) -> str:
            w = fixes.get(m.group())
            return m.group() if w is None else w.capitalize() if m.group()[:1].isupper() else w

        out = _TOKEN.sub(right, out)
    if not (dropped or halves or fixes):
        return text
    return "\n\n".join(re.sub(r"[ \t]*\n[ \t]*", " ", p).strip() for p in re.split(r"\n[ \t]*\n+", out) if p.strip())


def repair(chunks: DataFrame) -> DataFrame:
    """(id, clean): every chunk as continuous paragraphs. chunks: id, doc, content."""
    kept, counts, found = facts(chunks)
    best = found.withColumnRenamed("token", "read").groupBy("read").agg(F.min_by("word", F.struct(-F.col("share"), "edits", -F.col("n"), "word")).alias("word"))
    fixes = kept.where("kind = 'token'").join(best, "read").groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("a", "word"))).alias("fixes"))
    titles = kept.where("kind in ('header', 'maybe')").select("id", "doc", F.col("a").alias("title"))
    again = titles.groupBy("doc", "title").agg(F.countDistinct("id").alias("n")).where("n > 1 and length(title) > 5").drop("n")
    own = titles.join(again, ["doc", "title"], "left_semi").groupBy("id").agg(F.collect_set("title").alias("titles"))
    halves = kept.where("kind = 'hyphen'").select("id", F.lower(F.concat("a", "b")).alias("joined"), F.lower(F.concat_ws("-", "a", "b")).alias("word"))
    c = counts.where("n >= 2")
    compounds = halves.join(c, "word", "left_semi").join(c.select(F.col("word").alias("joined")), "joined", "left_anti").groupBy("id").agg(F.collect_set("word").alias("whole"))

    @F.pandas_udf("string")
    def work(text: pd.Series, titles: pd.Series, fixes: pd.Series, whole: pd.Series) -> pd.Series:
        one = lambda x: None if x is None else x
        return pd.Series([mend(t, one(a), dict(f) if f is not None else None, set(w) if w is not None else None) for t, a, f, w in zip(text, titles, fixes, whole, strict=True)], dtype=object)

    joined_ = chunks.join(own, "id", "left").join(fixes, "id", "left").join(compounds, "id", "left")
    return joined_.select("id", work("content", "titles", "fixes", "whole").alias("clean"))
