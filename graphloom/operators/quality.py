"""Quality of texts: garbled text, junk, repeated lines, bibliographies, empty and thin documents.

Cases: null texts have no verdict (null) and no rows in line operators; shares are over non-space characters; texts below the
least size are not judged.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import strip

LEAST_CHARS = 500


def share(text: Column, keep: str, whole: Column) -> Column:
    """Share of the characters of a class among ``whole``."""
    return F.length(F.regexp_replace(text, f"[^{keep}]", "")) / whole


def word_share(text: Column, whole: Column) -> Column:
    """Share of characters in words of three letters or more."""
    return F.length(F.array_join(F.regexp_extract_all(text, F.lit(r"([A-Za-z]{3,})"), 1), "")) / whole


def single_share(text: Column) -> Column:
    """Share of single characters among the tokens."""
    t = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    return F.when(F.size(t) > 0, F.size(F.filter(t, lambda x: F.length(x) == 1)) / F.size(t)).otherwise(0.0)


def garble(text: Column) -> Column:
    """The first kind of garbling that a text shows, or ``none``."""
    solid = F.regexp_replace(text, r"\s+", "")
    n = F.length(solid)
    word, digit = word_share(solid, n), share(solid, "0-9", n)
    verdict = (
        F.when(share(solid, r"\x{E000}-\x{F8FF}", n) >= 0.30, "private")
        .when(share(solid, r"\x{FFFD}", n) >= 0.05, "replacement")
        .when((share(solid, r"\x{00}-\x{1F}\x{7F}", n) >= 0.05) & (word < 0.25), "control")
        .when(share(solid, r"\x{80}-\x{FF}", n) >= 0.12, "latin1")
        .when((single_share(text) >= 0.35) & (word < 0.15) & (digit < 0.30), "single")
        .when((share(solid, "A-Za-z", n) >= 0.30) & (word < 0.03), "letters")
        .otherwise("none")
    )
    return F.when(n >= LEAST_CHARS, verdict)


def junk_ratio(text: Column) -> Column:
    """The share of a text that is base-64 runs or tags."""
    clean = F.regexp_replace(F.regexp_replace(text, "[A-Za-z0-9+/]{200,}={0,2}", ""), "<[^>]*>", "")
    return F.when(F.length(text) > 0, 1 - F.length(clean) / F.length(text)).otherwise(0.0)


#: The cleaning chain, in order: (pattern, replacement).
CLEANING = (
    (r"\x{0C}", "\n"),
    (r"[\x{00}-\x{08}\x{0B}\x{0E}-\x{1F}\x{7F}]", ""),
    (r"data:[a-z]+/[a-z0-9.+-]+;base64,[A-Za-z0-9+/=]+", ""),
    (r"[A-Za-z0-9+/]{200,}={0,2}", ""),
    (r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", ""),
    (r"(?i)<br[ ]*/?>", "\n"),
    (r"<[A-Za-z/!][^>]*>", ""),
    (r"[ \t]+\n", "\n"),
    (r"\n{3,}", "\n\n"),
)


def clean(text: Column) -> Column:
    for pattern, to in CLEANING:
        text = F.regexp_replace(text, pattern, to)
    return strip(text)


def repeated_lines(df: DataFrame, text: str, least_chars: int = 40, times: int = 5, most_loss: float = 0.25) -> DataFrame:
    """The table with lines that come back (the same but for digits and spacing) kept at their first place only. Marked lines (headings,
    table rows, items, fences) and short ones always stay, and a text that would lose more than the share stays whole.

    Each text is taken apart into arrays within its row, so the table is passed through once and nothing is shuffled: the lines'
    forms are sorted once, and a line goes if its form is among those that come back and stands further up."""
    line = F.split(F.col(text), "\n", -1)
    plain = F.transform(line, lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    counted = F.transform(plain, lambda x: F.when(~x.rlike(r"^(?:[#|-]|```)"), F.regexp_replace(x, "[0-9]+", "#")))
    counted = F.transform(counted, lambda x: F.when(F.length(x) >= least_chars, x))
    # equal forms stand together in the sorted array, so the one ``times - 1`` places on tells whether a form comes back often enough
    ordered = F.array_sort(F.array_compact(counted))
    often = F.array_distinct(F.filter(F.zip_with(ordered, F.slice(ordered, times, F.greatest(F.size(ordered), F.lit(1))), lambda a, b: F.when(a == b, a)), lambda x: x.isNotNull()))
    x = df.withColumn("_l", line).withColumn("_f", counted).withColumn("_o", often)
    stays = F.filter(F.arrays_zip(F.col("_l").alias("l"), F.col("_f").alias("f"), F.transform("_l", lambda v, i: i).alias("i")), lambda v: v["f"].isNull() | ~F.array_contains("_o", v["f"]) | (F.array_position("_f", v["f"]) == v["i"] + 1))
    new = F.array_join(F.transform(stays, lambda v: v["l"]), "\n")
    enough = F.length(new) >= (1 - most_loss) * F.length(text)
    return x.withColumn(text, F.when((F.size("_o") > 0) & enough, new).otherwise(F.col(text))).drop("_l", "_f", "_o")


#: An entry of a bibliography: a list mark, particles, a name before a comma, a year, and a cue or initials.
ENTRY = r"^\s*(?:\[?\d{1,3}[\].)]\s*|[-*•]\s*)?(?:(?:de|van|von|der|la|le|di)\s+){0,2}[A-Z][A-Za-z'’-]+,"
YEAR = r"(?:1[6-9]\d\d|20[0-3]\d)"
CUE = r"(?i:\bdoi\b|https?://|\bvol\.|\bpp?\.|\bjournal\b|\bproc|\bpress\b|\beds?\.)|,\s*[A-Z]\.(?:\s*[A-Z]\.)*"


def is_bibliography(text: Column) -> Column:
    """Five entry lines or more, or one packed line with three links and five years."""
    lines = F.split(text, "\n")
    entries = F.filter(lines, lambda x: x.rlike(ENTRY) & x.rlike(YEAR) & x.rlike(CUE))
    packed = F.exists(lines, lambda x: (F.length(x) > 600) & x.rlike(ENTRY) & (F.regexp_count(x, F.lit(r"(?i)doi|https?://")) >= 3) & (F.regexp_count(x, F.lit(YEAR)) >= 5))
    return (F.size(entries) >= 5) | packed


# What a heading of a reference section and of a back index can say.
REFERENCE_HEADINGS = "references|bibliography|works cited|literature cited|further reading|notes and references|literatur|literaturverzeichnis|quellenverzeichnis|références|bibliographie|referencias|bibliografía|riferimenti bibliografici|bibliografia"
INDEX_HEADINGS = "index|subject index|author index|general index|index of names|sachregister|register|personenregister"
_HEAD = r"^\s*(?:#{1,6}\s*)?(?:\*\*)?(?:(?:chapter|appendix|section)\s+)?(?:[0-9IVXivx]{1,4}(?:\.[0-9]+)*[.)]?\s*)?(?:%s)\s*:?\s*(?:\*\*)?\s*$"
#: What ends such a section: the next part of the text under a heading of its own.
_NEXT = r"^\s*(?:#{1,6}\s+\S|(?:appendix|acknowledg(?:e)?ments?|about the authors?|supplementary|supporting information|funding|conflict of interest|anhang|danksagung)\b)"
_INDEX_ENTRY = r"^\s*[^\s,].{0,70}?,\s*(?:see also\b.*|see\b.*|[0-9]+(?:[-–][0-9]+)?(?:,\s*[0-9]+(?:[-–][0-9]+)?)*)\s*$"
_NUMBERED = r"^\s*(?:\[[0-9]{1,3}\]|[0-9]{1,3}[.)])\s+\S"


def without_tail_references(df: DataFrame, text: str, last_share: float = 0.6, entries: float = 0.5) -> DataFrame:
    """Texts without their sections of references and their back index.

    A section begins at a heading that says so in the last ``last_share`` of the lines, or anywhere if what follows are entries, and
    ends at the next heading or at the end. It goes if at least the share ``entries`` of its lines are entries: author and year,
    numbered, or the continuation of one (indented, or in small letters); index entries end in page numbers. Other text stays, a
    section in the middle included. One narrow pass in Arrow batches; null and empty texts stay."""
    import re

    head, index = (re.compile(_HEAD % h, re.I) for h in (REFERENCE_HEADINGS, INDEX_HEADINGS))
    ends, entry, page, numbered, year = re.compile(_NEXT, re.I), re.compile(ENTRY), re.compile(_INDEX_ENTRY), re.compile(_NUMBERED), re.compile(YEAR)

    def is_entry(line: str, in_index: bool, before: bool) -> bool:
        if in_index:
            return bool(page.match(line)) or len(line.strip()) == 1
        return bool((entry.match(line) or numbered.match(line)) and (year.search(line) or numbered.match(line))) or before and (line[:1].isspace() or line.lstrip()[:1].islower())

    def one(t: str | None) -> str | None:
        if not t:
            return t
        lines, out, i = t.split("\n"), [], 0
        while i < len(lines):
            in_index = bool(index.match(lines[i]))
            if not (in_index or head.match(lines[i])):
                out.append(lines[i])
                i += 1
                continue
            j = i + 1
            while j < len(lines) and not ends.match(lines[j]) and not head.match(lines[j]) and not index.match(lines[j]):
                j += 1
            body, hits, before = [x for x in lines[i + 1 : j] if x.strip()], 0, False
            for x in body:
                before = is_entry(x, in_index, before)
                hits += before
            late = i >= (1 - last_share) * len(lines)
            if body and hits >= (entries if late else max(entries, 0.8)) * len(body):
                i = j
            else:
                out += lines[i:j]
                i = j
        new = "\n".join(out)
        return new.rstrip() if len(out) < len(lines) else t

    @F.pandas_udf("string")
    def work(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return df.withColumn(text, work(F.col(text)))


def is_empty(text: Column, least: int = 20) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", "")) < least


def thin_documents(sources: DataFrame, stored: DataFrame, gain: float = 2.0, floor: int = 1000, stub: int = 200) -> DataFrame:
    """(id, source_chars, stored_chars, why, day) of documents of which too little is stored: ``thin`` where the source has more than
    ``gain`` times the stored characters and more than the floor, ``stub`` where less than ``stub`` is stored of a source above the
    floor; day is that of the arrival. sources: id, chars, arrived; stored: id, chars."""
    x = sources.select("id", F.col("chars").alias("source_chars"), F.to_date("arrived").alias("day")).join(stored.select("id", F.col("chars").alias("stored_chars")), "id", "left").na.fill(0, ["stored_chars"])
    long_ = F.col("source_chars") > floor
    why = F.when(long_ & (F.col("stored_chars") < stub), "stub").when(long_ & (F.col("source_chars") > gain * F.col("stored_chars")), "thin")
    return x.withColumn("why", why).where("why is not null")


def base_name(path: Column) -> Column:
    """The file name without folders and without bracketed hints before its ending."""
    name = F.regexp_extract(F.regexp_replace(strip(path), r"\\", "/"), r"([^/]*)$", 1)
    return F.regexp_replace(name, r"\.?\[[^\]]*\](?=\.[A-Za-z0-9]+$)", "")
