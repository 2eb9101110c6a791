"""Extraction records: parsing, validation, normalisation, junk names and name folding.

Cases: a record with a missing, blank or extra field is dropped; null types and names are dropped; relations of a name with
itself are dropped; the tests of names look at the whole name, whatever its length.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import strip

FIELD, RECORD_END, COMPLETE = "<|#|>", "\n", "<|COMPLETE|>"
NAME_CHARS, NAME_BYTES = 256, 512

# Characters that no entity type may hold.
TYPE_SIGNS = "'()<>|/\\"


def parse_reply(df: DataFrame, key: str, reply: str) -> DataFrame:
    """(key, pos, fields): the records of a delimited reply; records that the field mark glued together are parted."""
    whole = F.replace(F.col(reply), F.lit(COMPLETE), F.lit("\n"))
    parted = F.regexp_replace(whole, r"(?i)<\|#\|>\s*\(?(entity|relation)<\|#\|>", "\n$1<|#|>")
    lines = df.select(key, F.posexplode(F.split(parted, "\n")).alias("pos", "line")).where(strip(F.col("line")) != "")
    clean = F.regexp_replace(strip(F.col("line")), r"^\(|\)$", "")
    return lines.select(key, "pos", F.transform(F.split(clean, r"<\|#\|>"), lambda x: strip(x)).alias("fields"))


def entity_records(parsed: DataFrame, key: str) -> DataFrame:
    """(key, pos, name, type, description) of valid entity records."""
    f = F.col("fields")
    kind = F.lower(F.regexp_replace(F.get(F.filter(F.transform(F.split(F.get(f, F.lit(2)), ","), lambda x: strip(x)), lambda x: x != ""), F.lit(0)), " ", ""))
    ok = (F.size(f) == 4) & (F.lower(F.get(f, F.lit(0))) == "entity") & (F.get(f, F.lit(1)) != "") & (F.get(f, F.lit(2)) != "") & (F.get(f, F.lit(3)) != "")
    good = parsed.where(ok).select(key, "pos", F.get(f, F.lit(1)).alias("name"), F.get(f, F.lit(2)).alias("_t"), kind.alias("type"), F.get(f, F.lit(3)).alias("description"))
    return good.where(~F.col("_t").rlike(r"['()<>|/\\]") & F.col("type").isNotNull()).drop("_t")


def relation_records(parsed: DataFrame, key: str) -> DataFrame:
    """(key, pos, src, tgt, keywords, description, weight) of valid relation records."""
    f = F.col("fields")
    ok = (F.size(f) == 5) & (F.lower(F.get(f, F.lit(0))) == "relation") & (F.get(f, F.lit(1)) != "") & (F.get(f, F.lit(2)) != "") & (F.get(f, F.lit(4)) != "") & (F.get(f, F.lit(1)) != F.get(f, F.lit(2)))
    return parsed.where(ok).select(key, "pos", F.get(f, F.lit(1)).alias("src"), F.get(f, F.lit(2)).alias("tgt"), F.translate(F.get(f, F.lit(3)), "，", ",").alias("keywords"), F.get(f, F.lit(4)).alias("description"), F.lit(1.0).alias("weight"))


def mended_json(text: str | None) -> str | None:
    """The first JSON object of a reply, whatever stands around it; one that breaks off is closed after its last whole value."""
    import json

    if not text:
        return None
    body = re.sub(r"```(?:json)?", "", text)
    start = body.find("{")
    if start < 0:
        return None
    body = body[start:]
    try:
        return json.dumps(json.JSONDecoder().raw_decode(body)[0], ensure_ascii=False)
    except ValueError:
        pass
    body = re.sub(r",\s*(?=[\]}])", "", body)
    open_, ends, quoted, escaped = [], [], False, False
    for i, c in enumerate(body):
        if quoted:
            escaped, quoted = c == "\\" and not escaped, not (c == '"' and not escaped)
        elif c == '"':
            quoted = True
        elif c in "{[":
            open_.append("}" if c == "{" else "]")
        elif c in "}]" and open_:
            open_.pop()
            # what is whole up to here, and what closes it
            ends.append((i + 1, "".join(reversed(open_))))
    for at, closing in reversed(ends):
        try:
            return json.dumps(json.loads(body[:at] + closing), ensure_ascii=False)
        except ValueError:
            continue
    return None


def json_records(df: DataFrame, key: str, reply: str) -> tuple[DataFrame, DataFrame]:
    """Entities and relations of a JSON reply. Replies that parse as they stand never leave the JVM; others are mended first, and one in
    which no object begins gives nothing. Names are capped, and a relation of a name with itself is looked for after that."""
    schema = "entities array<struct<name string, type string, description string>>, relationships array<struct<source string, target string, keywords string, description string>>"

    @F.pandas_udf("string")
    def mend(replies: pd.Series) -> pd.Series:
        return replies.map(mended_json)

    plain = F.regexp_replace(reply, r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", "")
    sound = F.try_parse_json(plain).isNotNull() & plain.rlike(r"^\s*\{")
    x = df.select(key, F.from_json(F.when(sound, plain).otherwise(mend(F.when(~F.coalesce(sound, F.lit(False)), F.col(reply)))), schema).alias("r"))
    name = lambda c: capped_name(strip(F.col(c)))
    e = x.select(key, F.posexplode("r.entities").alias("pos", "e")).select(key, "pos", name("e.name").alias("name"), F.lower(F.regexp_replace("e.type", " ", "")).alias("type"), strip(F.col("e.description")).alias("description"))
    r = x.select(key, F.posexplode("r.relationships").alias("pos", "e")).select(key, "pos", name("e.source").alias("src"), name("e.target").alias("tgt"), F.translate(F.coalesce("e.keywords", F.lit("")), "，", ",").alias("keywords"), strip(F.col("e.description")).alias("description"))
    full = lambda *c: [F.col(k).isNotNull() & (F.col(k) != "") for k in c]
    for test in full("name", "type", "description"):
        e = e.where(test)
    for test in full("src", "tgt", "description"):
        r = r.where(test)
    return e.where(~F.col("type").rlike(r"['()<>|/\\]")), r.where("src <> tgt")


WIDE = r"\x{2E80}-\x{9FFF}\x{AC00}-\x{D7AF}\x{F900}-\x{FAFF}"


def spaced(name: Column) -> Column:
    """A name without the white space between two wide characters, and between a wide one and a letter or digit."""
    out = F.regexp_replace(name, rf"(?<=[{WIDE}])\s+(?=[{WIDE}])", "")
    return F.regexp_replace(F.regexp_replace(out, rf"(?<=[{WIDE}])\s+(?=[A-Za-z0-9])", ""), rf"(?<=[A-Za-z0-9])\s+(?=[{WIDE}])", "")


def capped_name(name: Column) -> Column:
    """At most 256 characters and 512 bytes, cut before a character that would not fit, then ``spaced``. No Python: a character has four
    bytes at most, so the longest prefix that fits is among so many, and its length is found by the bytes of each character."""
    chars = F.substring(name, 1, NAME_CHARS)
    # bytes of each character, added up; the prefix is as long as there are sums within the cap
    sizes = F.transform(F.split(chars, ""), lambda c: F.octet_length(c))
    fit = F.aggregate(sizes, F.struct(F.lit(0).alias("bytes"), F.lit(0).alias("n")), lambda a, b: F.struct((a["bytes"] + b).alias("bytes"), (a["n"] + (a["bytes"] + b <= NAME_BYTES).cast("int")).alias("n")), lambda a: a["n"])
    short = (F.length(name) <= NAME_CHARS) & (F.octet_length(name) <= NAME_BYTES)
    return spaced(F.when(short, name).otherwise(F.rtrim(F.substring(chars, F.lit(1), fit))))


def symbolic(name: Column) -> Column:
    """Names of one character, and of two that are no letters and digits or only digits."""
    return (F.length(name) == 1) | ((F.length(name) == 2) & (~name.rlike(r"^[\p{L}\p{N}]+$") | name.rlike(r"^[0-9]+$")))


# Particles and honours of people's names.
_PARTICLE = "de|del|della|der|den|di|dos|du|la|le|ten|ter|van|von|zu|zur|bin|ibn|al"
_HONOUR = "Dr|Prof|Professor|Mr|Mrs|Ms|Miss|Sir|Dame|Herr|Frau|Mme|Monsieur|Rev|Hon"
_SURNAME = r"(?:(?:" + _PARTICLE + r") ){0,2}[A-Z][a-zà-ÿ]+(?:[-'’][A-Z]?[a-zà-ÿ]+)*"
#: Kinds of junk names and their patterns, in the order in which they are asked; the first that matches names the kind.
JUNK = (
    ("person", rf"^(?:(?:{_HONOUR})\.? )?(?:[A-Z]\.[ -]?){{1,4}}{_SURNAME}(?:,? (?:Jr|Sr|II|III)\.?)?$|^{_SURNAME}, ?(?:[A-Z]\.[ -]?){{1,4}}$|^(?:{_HONOUR})\.? [A-Z][a-zà-ÿ]+(?: (?:[A-Z]\. )?{_SURNAME})?$"),
    ("citation", r"^(?:see )?[A-Z][A-Za-z'’-]+(?:,| et al\.?,?| (?:and|&) [A-Z][A-Za-z'’-]+,?)? \(?(?:1[6-9]|20)[0-9]{2}[a-z]?\)?$|^[A-Z][A-Za-z'’-]+ et al\.?$|^\[[0-9]+(?:[,–-] ?[0-9]+)*\]$|^(?i:doi:|https?://|www\.)\S+$"),
    ("label", r"^(?i:(?:figures?|figs?\.?|tables?|tabs?\.?|sections?|sec\.?|chapters?|ch\.?|equations?|eqs?\.?|appendix|algorithm|pages?|pp?\.|lines?|steps?|volume|vol\.?|part|panel|plate|box|scheme|supplement(?:ary)? (?:figure|table)) ?(?:[0-9]+(?:[.-][0-9]+)*[a-z]?|[ivxlc]+|[a-z])(?: ?\([a-z]\))?)$"),
    ("generic", r"^(?i:(?:the |this |these |our |an? )?(?:present |current |previous |proposed |other )?(?:authors?|papers?|stud(?:y|ies)|methods?|approach(?:es)?|results?|data|models?|systems?|experiments?|introduction|conclusions?|abstract|references?|documents?|chunks?|texts?|analys[ie]s|examples?|sections?|works?|researchers?|participants?|others?))$"),
    ("numeric", r"^[0-9.,:;%/ +×x*^()±<>=~–-]+(?: ?(?:%|mm|cm|m|km|g|kg|s|ms|h|hz|°c|k|years?|days?))?$"),
)


def junk_kind(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(JUNK):
        out = F.when(name.rlike(pattern), kind).otherwise(out)
    return out


def without_junk(entities: DataFrame, relations: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Entities (key, name, type, ...) that are no junk, and relations (key, src, tgt, ...) that keep both ends. An entity is dropped if
    its name is junk under any type its chunk gives it (a person's initials are none of a person). An end is lost where its own
    chunk's record of it was dropped; one that its chunk does not list is lost if its name is junk."""
    kind = junk_kind(F.col("name"))
    drop = kind.isNotNull() & ~((kind == "person") & (F.col("type") == "person"))
    judged = entities.groupBy(key, "name").agg(F.max(drop).alias("_junk"))
    kept = entities.join(judged.where("_junk").select(key, "name"), [key, "name"], "left_anti")
    r = relations
    for end in ("src", "tgt"):
        r = r.join(judged.select(F.col(key), F.col("name").alias(end), F.col("_junk").alias(f"_{end}")), [key, end], "left")
    lost = lambda end: F.coalesce(F.col(f"_{end}"), junk_kind(F.col(end)).isNotNull())
    return kept, r.where(~lost("src") & ~lost("tgt")).drop("_src", "_tgt")


def allowed_types(entities: DataFrame, allowed: list[str]) -> DataFrame:
    """Types outside the list become ``other``."""
    return entities.withColumn("type", F.when(F.col("type").isin(*allowed), F.col("type")).otherwise("other"))


def listed_types(prompt: str) -> list[str]:
    """The types of ``- Type:`` lines of a prompt."""
    return [m.strip().lower() for m in re.findall(r"^- ([^:\n]+):", prompt, re.M)]


# Words whose plural has no rule, words that end in s in the singular, and endings of such words.
IRREGULAR = {"children": "child", "men": "man", "women": "woman", "people": "person", "mice": "mouse", "geese": "goose", "feet": "foot", "teeth": "tooth", "data": "datum", "criteria": "criterion", "phenomena": "phenomenon", "indices": "index", "matrices": "matrix", "vertices": "vertex", "analyses": "analysis", "hypotheses": "hypothesis", "theses": "thesis", "axes": "axis", "bases": "basis", "crises": "crisis", "leaves": "leaf", "lives": "life", "knives": "knife", "halves": "half", "wolves": "wolf", "shelves": "shelf"}
SINGULAR = frozenset("bus gas lens news series species physics mathematics economics statistics ethics genetics linguistics dynamics mechanics electronics corpus virus campus census chaos bias atlas canvas apparatus status alias kudos always perhaps".split())
_SINGULAR_ENDINGS = ("ss", "us", "is", "ics", "ous", "sis", "xis", "itis")


def singular(word: str) -> str:
    """The singular of an English word in small letters, by its ending."""
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 3 or word in SINGULAR or not word.endswith("s") or word.endswith(_SINGULAR_ENDINGS):
        return word
    if word.endswith("ies") and len(word) > 4:
        return word[:-3] + "y"
    if word.endswith(("sses", "shes", "ches", "xes", "zzes")):
        return word[:-2]
    if word.endswith("oes") and len(word) > 5:
        return word[:-2]
    return word[:-1]


def is_plural(name: str) -> bool:
    words = re.findall(r"[^\W_]+", unicodedata.normalize("NFKC", name).casefold())
    return bool(words) and singular(words[-1]) != words[-1]


def is_flawed(name: str) -> bool:
    """Whether a spelling shows a slip: white space at an end or doubled, signs at an end, a lone bracket or quote, or letters of another
    width than its compatibility form."""
    signs = name.strip()
    return name != re.sub(r"\s+", " ", signs) or bool(re.search(r"^[\W_]|[^\w)\]\"'’+#.%°]$", signs)) or signs.count("(") != signs.count(")") or signs.count('"') % 2 == 1 or unicodedata.normalize("NFKC", name) != name


def fold_name(name: str | None) -> str | None:
    """The key that spellings of one name share: letters and digits of the compatibility form in small letters, the last word in
    the singular; short names keep their case class (capitals, one capital, small), symbols are marked."""
    if name is None:
        return None
    plain = unicodedata.normalize("NFKC", name)
    words = re.findall(r"[^\W_]+", plain.casefold())
    if not words:
        return "§" + plain.strip()
    key = "".join([*words[:-1], singular(words[-1])])
    if len(key) < 4:
        return "§" + plain.strip()
    if len(key) <= 5:
        letters = [c for c in plain if c.isalpha()]
        key += ":" + ("U" if letters and all(c.isupper() for c in letters) else "m" if any(c.isupper() for c in letters[1:]) else "l")
    return key


def fold_keys(name: Column) -> Column:
    @F.pandas_udf("string")
    def key(names: pd.Series) -> pd.Series:
        return names.map(fold_name)

    return key(name)


def fold_map(names: DataFrame) -> DataFrame:
    """(name, canonical): of each fold key the name that is no junk, has no flaw, the greatest degree, is no plural, then the first.
    names: name, degree."""

    @F.pandas_udf("struct<key string, flawed boolean, plural boolean>")
    def look(names_: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"key": [fold_name(n) for n in names_], "flawed": [is_flawed(n) for n in names_], "plural": [is_plural(n) for n in names_]})

    k = names.where("name is not null").withColumn("_l", look("name")).select("name", "degree", "_l.*", junk_kind(F.col("name")).isNotNull().alias("junk"))
    best = k.groupBy("key").agg(F.min_by("name", F.struct("junk", "flawed", (-F.col("degree")).alias("d"), "plural", "name")).alias("canonical"))
    return k.join(best, "key").select("name", "canonical")


def apply_map(records: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """The column with each name replaced by its canonical one (name, canonical)."""
    m = names.select(F.col("name").alias(column), F.col("canonical").alias("_c"))
    return records.join(m, column, "left").withColumn(column, F.coalesce("_c", column)).drop("_c")


#: A contract of relation types where none is declared: type -> its inverse (null for symmetric ones).
CONTRACT = {"cites": "cited_by", "uses": "used_by", "part_of": "has_part", "causes": "caused_by", "author_of": "authored_by", "extends": None, "related_to": None}


def typed_relations(df: DataFrame, contract: dict[str, str | None] | None = None, fallback: str | None = "related_to") -> DataFrame:
    """Relations whose keywords are types of a declared contract (src, tgt, keywords, ...): inverses swap the ends; other words drop out,
    and where nothing stays the fallback is taken, or the relation is dropped if the contract has no such type."""
    declared = CONTRACT if contract is None else contract
    inverses = {v: k for k, v in declared.items() if v}
    words = F.filter(F.transform(F.split(F.coalesce("keywords", F.lit("")), r"[\n,;]+"), lambda x: F.regexp_replace(F.lower(strip(x)), r"[ -]+", "_")), lambda x: x != "")
    inverse = F.create_map(*(F.lit(x) for p in inverses.items() for x in p)) if inverses else F.create_map().cast("map<string,string>")
    d = df.withColumn("_w", words).withColumn("_swap", F.exists("_w", lambda x: x.isin(*inverses)) if inverses else F.lit(False))
    kept = F.array_distinct(F.filter(F.transform("_w", lambda x: F.coalesce(inverse[x], x)), lambda x: x.isin(*declared)))
    types = F.when(F.size(kept) > 0, F.array_join(kept, ",")).otherwise(F.lit(fallback if fallback in declared else None))
    d = d.withColumn("types", types).where("types is not null")
    return d.select(*(c for c in df.columns if c not in ("src", "tgt", "keywords")), F.when(F.col("_swap"), F.col("tgt")).otherwise(F.col("src")).alias("src"), F.when(F.col("_swap"), F.col("src")).otherwise(F.col("tgt")).alias("tgt"), "types")


def keyword_list(text: Column) -> Column:
    """Keywords of a reply: parted at commas, semicolons and line ends, trimmed, template placeholders dropped."""
    return F.filter(F.transform(F.split(text, r"[\n,;]+"), lambda x: strip(x)), lambda x: (x != "") & ~x.rlike(r"^[<\[{].*[>\]}]$"))


def query_weight(text: Column) -> Column:
    """Weight of a question without white space: wide characters count 2."""
    t = F.regexp_replace(text, r"\s+", "")
    return F.length(t) + F.length(F.regexp_replace(t, r"[^\x{2E80}-\x{9FFF}\x{AC00}-\x{D7AF}\x{F900}-\x{FAFF}]", ""))


def valid_query(text: Column) -> Column:
    return query_weight(text) >= 3


def heading_path(levels: Column, budget: int) -> Column:
    """Headings joined by an arrow: each on one line of at most 80 characters. Beyond the budget middle headings go from the second on,
    one after the other, until the rest fits or only the first and the last stay, with one mark for those that went."""
    short = F.transform(F.filter(levels, lambda x: x.isNotNull() & (strip(x) != "")), lambda x: F.substring(strip(F.regexp_replace(x, r"\s+", " ")), 1, 80))
    joined = F.array_join(short, " → ")
    n = F.size(short)
    # all shortened forms, the longest first: the first heading, the mark, and the last n - k headings
    forms = F.transform(F.sequence(F.lit(2), F.greatest(n - 1, F.lit(2))), lambda k: F.array_join(F.concat(F.slice(short, 1, 1), F.array(F.lit("…")), F.slice(short, k + 1, n)), " → "))
    fits = F.filter(forms, lambda x: F.length(x) <= budget)
    return F.when((F.length(joined) <= budget) | (n <= 2), joined).otherwise(F.coalesce(F.get(fits, F.lit(0)), F.element_at(forms, -1)))


def without_media_marks(text: Column) -> Column:
    """Text without the engine's own marks for drawings, tables and equations."""
    return F.regexp_replace(text, r"(?s)<(drawing|equation|table_ref)\b[^>]*/>|<(drawing|equation)\b[^>]*>.*?</\2>|\[\[(?:drawing|table|equation):[^\]]*\]\]", "")


def suspicious_name(name: Column) -> Column:
    """Why a name looks like a slip of an extractor, or null: ``variable`` (snake or camel case, a call, a path of members), ``markup``
    (marks or template signs), ``glued`` (two names run together), ``sentence`` (a whole sentence or more than twelve words)."""
    variable = name.rlike(r"^[a-z]+(?:_[a-z0-9]+)+$|^[a-z]+(?:[A-Z][a-z0-9]+)+$|^[A-Z]+(?:_[A-Z0-9]+)+$|^[A-Za-z_][\w.]*\(\)?$|^[a-z_]\w*(?:\.[a-z_]\w*)+$")
    markup = name.rlike(r"</?[a-zA-Z]|\{\{|\}\}|<\||\|>|\*\*|^[{\[<].*[}\]>]$")
    glued = name.rlike(r"[a-z]{3,}[A-Z][a-z]{3,}[A-Z]?") | name.rlike(r"[A-Za-z]{3,}[;|][A-Za-z]{3,}")
    sentence = name.rlike(r"[a-z]{2}[.!?] +[A-Z]|[a-z]{3}[.!?]$") | (F.size(F.split(F.trim(name), r"\s+")) > 12)
    return F.when(variable, "variable").when(markup, "markup").when(glued, "glued").when(sentence, "sentence")


def checked(entities: DataFrame, relations: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """A chunk's records (key, ...) after the check of its extraction: entities without slips, and relations whose ends have none and
    which name both ends in different words."""
    kept = entities.where(suspicious_name(F.col("name")).isNull())
    same = F.lower(F.regexp_replace("src", r"\W+", "")) == F.lower(F.regexp_replace("tgt", r"\W+", ""))
    return kept, relations.where(suspicious_name(F.col("src")).isNull() & suspicious_name(F.col("tgt")).isNull() & ~same)
