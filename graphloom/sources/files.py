"""Files as sources: which engine reads a file, Markdown and HTML as heading blocks, DOCX and plain files as text, block tables.

Every reader is ``binaryFile`` or ``text`` with one narrow Python pass, so files spread over the tasks. Cases: an unknown ending has no
engine; a broken file gives a row with its error and no text; empty files have no row (Spark lists none); undecodable bytes become replacement signs.
"""

from __future__ import annotations

import html
import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Endings and the engines that read them, in order of preference.
ENGINES = {
    "native": ("docx", "md", "markdown", "textpack"),
    "legacy": ("txt", "md", "html", "htm", "csv", "tsv", "json", "jsonl", "xml", "tex", "log", "py", "docx", "xlsx", "pptx", "pdf"),
    "mineru": ("pdf", "docx", "pptx", "xlsx", "png", "jpg", "jpeg"),
    "docling": ("pdf", "docx", "pptx", "xlsx", "html", "md", "png", "jpg", "jpeg", "tiff"),
}
#: Engines that read files here; the others are external, and count once a caller says that they are there.
OWN = ("native", "legacy")
#: Bytes beyond which a file is refused, as the budget of the plain readers.
MOST_BYTES = 64 * 1024 * 1024


def hint(path: Column) -> Column:
    """The engine named in brackets before the ending, or null."""
    return F.nullif(F.regexp_extract(path, r"\[([a-z]+)[^\]]*\]\.[A-Za-z0-9]+$", 1), F.lit(""))


def options(path: Column) -> Column:
    """The option signs of a hint after a hyphen: ``!`` skips extraction, F, R, V and P name chunkers."""
    return F.nullif(F.regexp_extract(path, r"\[[a-z]*-([!FRVP]+)\]\.[A-Za-z0-9]+$", 1), F.lit(""))


def rules_of(text: str) -> list[tuple[str, str]]:
    """(ending or *, engine) rules of a text such as ``pdf:mineru;*:legacy``, in order; an unknown engine is an error."""
    out = []
    for part in re.split(r"[;,\s]+", text.strip()):
        if part:
            ending, _, name = part.partition(":")
            if name not in ENGINES:
                raise ValueError(f"unknown engine {name}")
            out.append((ending.lower().lstrip("."), name))
    return out


def engine(path: Column, rules: str = "", available: tuple[str, ...] = OWN) -> Column:
    """The engine of a file: that of its hint if it is there and reads the ending, else that of the first rule for the ending whose engine
    is there and reads it, else the first engine that is there and reads it."""
    ending = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    there = [n for n in ENGINES if n in available]
    named, out = hint(path), F.lit(None).cast("string")
    for name in reversed(there):
        out = F.when(ending.isin(*ENGINES[name]), name).otherwise(out)
    for wanted, name in reversed(rules_of(rules)):
        if name in there:
            out = F.when((ending.isin(*ENGINES[name])) & (F.lit(wanted == "*") | (ending == wanted)), name).otherwise(out)
    for name in there:
        out = F.when((named == name) & ending.isin(*ENGINES[name]), name).otherwise(out)
    return out


def resolved_links(text: str) -> str:
    """Markdown with its reference-style links and images as inline ones; references without a definition stay."""
    found = {m.group(1).strip().lower(): m.group(2) for m in re.finditer(r"^ {0,3}\[([^\]\n]+)\]:\s*<?(\S+?)>?(?:\s+[\"'(].*[\"')])?\s*$", text, re.M)}
    if not found:
        return text

    def inline(m: re.Match) -> str:
        url = found.get((m.group(3) or m.group(2)).strip().lower())
        return f"{m.group(1)}[{m.group(2)}]({url})" if url else m.group()

    body = re.sub(r"^ {0,3}\[[^\]\n]+\]:\s*\S+.*\n?", "", text, flags=re.M)
    return re.sub(r"(!?)\[([^\]\n]+)\]\[([^\]\n]*)\]", inline, body)


def markdown_tables(text: str | None) -> list[dict]:
    """Tables of a Markdown text in order: heading they stand under, header cells, rows, and their own text."""
    out, heading = [], ""
    lines = (text or "").split("\n")
    cells = lambda line: [c.strip().replace("\\|", "|") for c in re.split(r"(?<!\\)\|", line.strip().strip("|"))]
    i = 0
    while i < len(lines):
        m = re.match(r" {0,3}#{1,6}\s+(.*?)\s*#*\s*$", lines[i])
        heading = m.group(1) if m else heading
        if "|" in lines[i] and i + 1 < len(lines) and re.fullmatch(r"\s*\|?(?:\s*:?-+:?\s*\|)*\s*:?-+:?\s*\|?\s*", lines[i + 1]) and "-" in lines[i + 1]:
            j = i + 2
            while j < len(lines) and "|" in lines[j] and lines[j].strip():
                j += 1
            out.append({"heading": heading, "header": cells(lines[i]), "rows": [cells(x) for x in lines[i + 2 : j]], "content": "\n".join(lines[i:j])})
            i = j
        else:
            i += 1
    return out


def markdown_blocks(text: str | None) -> list[tuple[int, str, list[str], str]]:
    """(level, heading, parents, content) of each section; code fences hide their hashes."""
    out, path, body, fenced = [], [], [], False

    def close() -> None:
        content = "\n".join(body).strip()
        if content or path:
            out.append((path[-1][0] if path else 0, path[-1][1] if path else "", [h for _, h in path[:-1]], content))
        body.clear()

    for line in (text or "").split("\n"):
        if line.lstrip().startswith(("```", "~~~")):
            fenced = not fenced
        m = None if fenced else re.match(r" {0,3}(#{1,6})\s+(.*?)\s*#*\s*$", line)
        if m:
            if body or path:
                close()
            level = len(m.group(1))
            while path and path[-1][0] >= level:
                path.pop()
            path.append((level, m.group(2)))
        else:
            body.append(line)
    close()
    return [b for b in out if b[3] or b[1]]


def html_text(text: str) -> str:
    """The visible text of a page, headings as Markdown ones."""
    t = re.sub(r"(?is)<(script|style|head)\b.*?</\1\s*>|<!--.*?-->", " ", text)
    t = re.sub(r"(?is)<h([1-6])\b[^>]*>(.*?)</h\1\s*>", lambda m: "\n\n" + "#" * int(m.group(1)) + " " + m.group(2) + "\n\n", t)
    t = re.sub(r"(?i)<br\s*/?>|</(?:p|div|li|tr|table|ul|ol)\s*>", "\n", t)
    return re.sub(r"\n{3,}", "\n\n", html.unescape(re.sub(r"<[^>]+>", "", t))).strip()


# Name spaces of office documents.
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_M = "{http://schemas.openxmlformats.org/officeDocument/2006/math}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def formula(e) -> str:
    """A formula of a document in linear form: fractions, scripts, roots, sums, matrices and brackets."""
    kids = lambda x: "".join(formula(c) for c in x)
    part = lambda name: "".join(kids(c) for c in e if c.tag == _M + name)
    tag = e.tag.removeprefix(_M)
    if tag == "t":
        return e.text or ""
    if tag == "f":
        return f"\\frac{{{part('num')}}}{{{part('den')}}}"
    if tag in ("sSup", "sSub", "sSubSup"):
        return part("e") + (f"_{{{part('sub')}}}" if tag != "sSup" else "") + (f"^{{{part('sup')}}}" if tag != "sSub" else "")
    if tag == "rad":
        return f"\\sqrt[{part('deg')}]{{{part('e')}}}" if part("deg") else f"\\sqrt{{{part('e')}}}"
    if tag == "nary":
        sign = e.find(f"{_M}naryPr/{_M}chr")
        return f"{sign.get(_M + 'val') if sign is not None else '∫'}" + (f"_{{{part('sub')}}}" if part("sub") else "") + (f"^{{{part('sup')}}}" if part("sup") else "") + part("e")
    if tag == "d":
        return "(" + ", ".join(kids(c) for c in e if c.tag == _M + "e") + ")"
    if tag == "m":
        return "[" + "; ".join(", ".join(kids(c) for c in r if c.tag == _M + "e") for r in e if r.tag == _M + "mr") + "]"
    return "" if tag.endswith("Pr") else kids(e)


class _Numbers:
    """Numbers of a document's lists: formats and counters of each list and level."""

    def __init__(self, xml: bytes | None):
        self.formats: dict[tuple[str, int], tuple[str, str, int]] = {}
        self.counts: dict[tuple[str, int], int] = {}
        if xml is None:
            return
        root = ElementTree.fromstring(xml)
        value = lambda e, path, default: (x.get(f"{_W}val", default) if (x := e.find(path)) is not None else default)
        abstract = {a.get(f"{_W}abstractNumId"): a for a in root.findall(f"{_W}abstractNum")}
        for n in root.findall(f"{_W}num"):
            a = abstract.get(value(n, f"{_W}abstractNumId", ""))
            for level in a.findall(f"{_W}lvl") if a is not None else ():
                self.formats[n.get(f"{_W}numId"), int(level.get(f"{_W}ilvl", "0"))] = (value(level, f"{_W}numFmt", "decimal"), value(level, f"{_W}lvlText", "%1."), int(value(level, f"{_W}start", "1")))

    def label(self, number: str, level: int) -> str:
        kind, text, start = self.formats.get((number, level), ("bullet", "", 1))
        self.counts[number, level] = self.counts.get((number, level), start - 1) + 1
        for key in [k for k in self.counts if k[0] == number and k[1] > level]:
            del self.counts[key]
        if kind == "bullet":
            return "-"
        return re.sub(r"%(\d)", lambda m: self._write(number, int(m.group(1)) - 1), text)

    def _write(self, number: str, level: int) -> str:
        kind, _, start = self.formats.get((number, level), ("decimal", "", 1))
        n = self.counts.get((number, level), start)
        if kind in ("lowerLetter", "upperLetter"):
            out = chr(97 + (n - 1) % 26) * ((n - 1) // 26 + 1)
        elif kind in ("lowerRoman", "upperRoman"):
            out = _roman(n)
        else:
            return str(n)
        return out.upper() if kind.startswith("upper") else out


def _roman(n: int) -> str:
    out = ""
    for v, sign in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out, n = out + sign * (n // v), n % v
    return out


def docx_text(data: bytes) -> str:
    """Paragraphs, lists with their numbers, table rows and formulas of a document. A heading is told by its style's name or outline level,
    or, where a document has no styled heading, by a short bold paragraph of its own with a number before it."""
    z = zipfile.ZipFile(io.BytesIO(data))
    part = lambda name: z.read(name) if name in z.namelist() else None
    body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    numbers, styles = _Numbers(part("word/numbering.xml")), {}
    for e in ElementTree.fromstring(part("word/styles.xml")).findall(f"{_W}style") if part("word/styles.xml") else ():
        name, outline = e.find(f"{_W}name"), e.find(f"{_W}pPr/{_W}outlineLvl")
        m = re.match(r"(?i)heading ?([1-9])", name.get(f"{_W}val", "") if name is not None else "")
        level = int(m.group(1)) if m else int(outline.get(f"{_W}val", "9")) + 1 if outline is not None else 0
        if 1 <= level <= 6:
            styles[e.get(f"{_W}styleId")] = level

    def text(e) -> str:
        out = []
        for x in e:
            if x.tag in (f"{_M}oMath", f"{_M}oMathPara"):
                out.append(f"${formula(x)}$")
            elif x.tag == f"{_W}t":
                out.append(x.text or "")
            elif x.tag in (f"{_W}tab", f"{_W}br"):
                out.append("\t" if x.tag.endswith("tab") else "\n")
            elif x.tag not in (f"{_W}pPr", f"{_W}rPr", f"{_W}del"):
                out.append(text(x))
        return "".join(out)

    found: list[tuple[str, int, bool]] = []
    for e in body if body is not None else ():
        if e.tag == f"{_W}p":
            t, style = text(e), e.find(f"{_W}pPr/{_W}pStyle")
            name = style.get(f"{_W}val", "") if style is not None else ""
            m = re.match(r"(?i)heading ?([1-6])", name)
            outline = e.find(f"{_W}pPr/{_W}outlineLvl")
            level = int(m.group(1)) if m else styles.get(name, int(outline.get(f"{_W}val", "9")) + 1 if outline is not None else 0)
            number = e.find(f"{_W}pPr/{_W}numPr/{_W}numId")
            runs = [r for r in e.iter(f"{_W}r") if "".join(x.text or "" for x in r.iter(f"{_W}t")).strip()]
            bold = bool(runs) and all(r.find(f"{_W}rPr/{_W}b") is not None for r in runs)
            if number is not None and number.get(f"{_W}val") != "0" and t.strip():
                at = e.find(f"{_W}pPr/{_W}numPr/{_W}ilvl")
                depth = int(at.get(f"{_W}val", "0")) if at is not None else 0
                t = f"{numbers.label(number.get(f'{_W}val'), depth)} {t}" if level else f"{'  ' * depth}{numbers.label(number.get(f'{_W}val'), depth)} {t}"
            found.append((t, level if 1 <= level <= 6 else 0, bold))
        elif e.tag == f"{_W}tbl":
            rows = [" | ".join(" ".join(text(c).split()) for c in r if c.tag == f"{_W}tc") for r in e if r.tag == f"{_W}tr"]
            found.append(("\n".join(rows), 0, False))
    if not any(level for _, level, _ in found):
        number = re.compile(r"(\d+(?:\.\d+){0,5})\.?\s+\S")
        found = [(t, m.group(1).count(".") + 1 if bold and len(t) <= 120 and "\n" not in t and (m := number.match(t)) else 0, bold) for t, _, bold in found]
    return "\n\n".join("#" * level + " " + t.strip() if level else t.rstrip() for t, level, _ in found if t.strip())


def xlsx_text(data: bytes) -> str:
    """Sheets in their order, each under its name, one line a row: shared and inline strings, numbers, truth values and dates."""
    import datetime as dt

    z = zipfile.ZipFile(io.BytesIO(data))
    part = lambda name: ElementTree.fromstring(z.read(name)) if name in z.namelist() else None
    shared_part, styles = part("xl/sharedStrings.xml"), part("xl/styles.xml")
    shared = ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in shared_part.findall(f"{_S}si")] if shared_part is not None else []
    dates: set[int] = set()
    if styles is not None:
        own = {int(f.get("numFmtId", "0")): f.get("formatCode", "") for f in styles.iter(f"{_S}numFmt")}
        for i, xf in enumerate(styles.findall(f"{_S}cellXfs/{_S}xf")):
            n = int(xf.get("numFmtId", "0"))
            if 14 <= n <= 22 or 45 <= n <= 47 or re.search(r"[ymdh]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(n, "").lower())):
                dates.add(i)
    links = part("xl/_rels/workbook.xml.rels")
    target = {r.get("Id"): r.get("Target", "") for r in links} if links is not None else {}
    book = part("xl/workbook.xml")
    sheets = [(x.get("name", ""), "xl/" + target.get(x.get(f"{_R}id"), "").removeprefix("/xl/")) for x in book.iter(f"{_S}sheet")] if book is not None else []
    if not sheets:
        number = lambda n: int(re.search(r"(\d+)\.xml$", n).group(1))
        sheets = [("", n) for n in sorted((n for n in z.namelist() if re.match(r"xl/worksheets/sheet\d+\.xml$", n)), key=number)]

    def value(c) -> str:
        kind, v = c.get("t", "n"), c.find(f"{_S}v")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter(f"{_S}t"))
        if v is None or v.text is None:
            return ""
        if kind == "s":
            return shared[int(v.text)] if int(v.text) < len(shared) else ""
        if kind == "b":
            return "TRUE" if v.text == "1" else "FALSE"
        if kind == "n" and int(c.get("s", "0")) in dates:
            at = dt.datetime(1899, 12, 30) + dt.timedelta(days=float(v.text))
            return at.strftime("%Y-%m-%d" if at.time() == dt.time() else "%Y-%m-%d %H:%M:%S")
        return v.text

    out = []
    for name, at in sheets:
        sheet = part(at)
        rows = []
        for r in sheet.iter(f"{_S}row") if sheet is not None else ():
            cells: list[str] = []
            for c in r.findall(f"{_S}c"):
                letters = re.match(r"[A-Z]+", c.get("r", ""))
                column = 0
                for x in letters.group() if letters else "":
                    column = column * 26 + ord(x) - 64
                cells += [""] * (column - 1 - len(cells))
                cells.append(value(c))
            if any(cells):
                rows.append(" | ".join(cells))
        if rows:
            out.append((f"## {name}\n\n" if name else "") + "\n".join(rows))
    return "\n\n".join(out)


def pptx_text(data: bytes) -> str:
    """Slides in their order, one paragraph a line."""
    z = zipfile.ZipFile(io.BytesIO(data))
    slides = sorted((int(m.group(1)), n) for n in z.namelist() if (m := re.match(r"ppt/slides/slide(\d+)\.xml$", n)))
    pages = []
    for _, n in slides:
        lines = ["".join(t.text or "" for t in p.iter() if t.tag.endswith("}t")) for p in ElementTree.fromstring(z.read(n)).iter() if p.tag.endswith("}p")]
        pages.append("\n".join(x for x in lines if x.strip()))
    return "\n\n".join(p for p in pages if p)


_PDF_STRING = rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>"
_PDF_TOKEN = re.compile(rb"(" + _PDF_STRING + rb")|\[((?:" + _PDF_STRING + rb"|[^\[\]()<>])*)\]|(/[^\s/\[\]()<>]+)|([-+.\d]+)|([A-Za-z'\"*]+)", re.S)


def pdf_text(data: bytes) -> str:
    """Text of a PDF whose streams are plain or deflated and whose fonts are single-byte or have a table of their characters; a file that is
    encrypted or holds none of these is an error, so that another extractor can be asked."""
    import zlib

    if not data.startswith(b"%PDF"):
        raise ValueError("no PDF")
    if re.search(rb"/Encrypt\b", data):
        raise ValueError("an encrypted PDF needs an injected extractor")
    streams = []
    for m in re.finditer(rb"<<(?P<d>(?:[^<>]|<[^<]|>[^>]|<<(?:[^<>]|<[^<]|>[^>])*>>)*)>>\s*stream\r?\n", data):
        end = data.find(b"endstream", m.end())
        raw = data[m.end() : end if end >= 0 else len(data)]
        if b"FlateDecode" in m.group("d"):
            try:
                raw = zlib.decompressobj().decompress(raw, MOST_BYTES)
            except zlib.error:
                continue
        elif b"/Filter" in m.group("d"):
            continue
        streams.append(raw)
    table: dict[int, str] = {}
    char = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    for raw in streams:
        for block in re.findall(rb"beginbfchar(.*?)endbfchar", raw, re.S):
            table.update({int(a, 16): char(b) for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block)})
        for block in re.findall(rb"beginbfrange(.*?)endbfrange", raw, re.S):
            for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
                first = char(c)
                table.update({int(a, 16) + i: first[:-1] + chr(ord(first[-1]) + i) for i in range(min(int(b, 16) - int(a, 16), 65_535) + 1)} if first else {})

    def read(s: bytes) -> str:
        if s[:1] == b"<":
            digits = re.sub(rb"\s", b"", s[1:-1])
            body = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
            if table and len(body) % 2 == 0:
                return "".join(table.get(int.from_bytes(body[i : i + 2], "big"), "") for i in range(0, len(body), 2))
        else:
            escape = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
            body = re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda m: bytes([int(m.group(1), 8) & 255]) if m.group(1)[:1].isdigit() else b"" if m.group(1) in (b"\n", b"\r\n") else escape.get(m.group(1), m.group(1)), s[1:-1], flags=re.S)
        return body.decode("cp1252", "replace")

    pages = []
    for raw in streams:
        if not re.search(rb"\bBT\b", raw):
            continue
        out, numbers, held = [], [], None
        for string, array, _, number, word in _PDF_TOKEN.findall(raw):
            if string:
                held = read(string)
            elif array:
                held = "".join(read(x) if x else " " if float(gap) < -180 else "" for x, gap in re.findall(rb"(" + _PDF_STRING + rb")|([-+]?[\d.]+)", array))
            elif number:
                try:
                    numbers.append(float(number))
                except ValueError:
                    numbers.append(0.0)
            elif word:
                if word in (b"'", b'"', b"T*"):
                    out.append("\n")
                elif word in (b"Td", b"TD") and len(numbers) >= 2:
                    out.append("\n" if numbers[-1] else " ")
                elif word in (b"Tm", b"ET"):
                    out.append("\n")
                if word in (b"Tj", b"TJ", b"'", b'"') and held is not None:
                    out.append(held)
                numbers, held = [], None
        page = re.sub(r"[ \t]*\n\s*", "\n", "".join(out)).strip()
        if page:
            pages.append(page)
    if not pages:
        raise ValueError("a PDF without readable text needs an injected extractor")
    return "\n\n".join(pages)


def extract(name: str, data: bytes) -> str:
    """Text of a file's bytes by its ending."""
    ending = name.rsplit(".", 1)[-1].lower()
    office = {"docx": docx_text, "xlsx": xlsx_text, "pptx": pptx_text, "pdf": pdf_text}
    if ending in office:
        return office[ending](data)
    if ending == "textpack":
        z = zipfile.ZipFile(io.BytesIO(data))
        body = next((n for n in z.namelist() if re.search(r"(^|/)text\.(?:md|markdown|txt)$", n)), None)
        if body is None:
            raise ValueError("a text pack without a text")
        return resolved_links(z.read(body).decode("utf-8-sig", errors="replace"))
    text = data.decode("utf-8-sig", errors="replace")
    if ending in ("md", "markdown"):
        return resolved_links(text)
    return html_text(text) if ending in ("html", "htm") else text


def read_texts(spark: SparkSession, path: str, extractor=extract, most: int = MOST_BYTES) -> DataFrame:
    """(path, text, error) of files under a path. The extractor (name, bytes) -> text is injectable; its failure is a row's error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = files.where(F.col("length") <= most).select("path", "content")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, data in zip(b["path"], b["content"], strict=True):
                try:
                    rows.append((p, extractor(p, bytes(data)), None))
                except Exception as e:  # noqa: BLE001 - any failure belongs to its file
                    rows.append((p, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(rows, columns=["path", "text", "error"])

    large = files.where(F.col("length") > most).select("path", F.lit(None).cast("string").alias("text"), F.lit("beyond the size budget").alias("error"))
    return small.mapInPandas(work, "path string, text string, error string").unionByName(large)


def blocks_of(df: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, pos, level, heading, parents, content): heading blocks of Markdown-like texts."""

    @F.pandas_udf("array<struct<level int, heading string, parents array<string>, content string>>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(markdown_blocks)

    x = df.select(key, F.posexplode(split(text)).alias("pos", "b"))
    return x.select(key, "pos", "b.level", "b.heading", "b.parents", "b.content")


BLOCKS = "type string, content string, heading string, level int, parent_headings array<string>, blockid string"


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Content rows of a block file (JSON lines); a broken line fails the read."""
    return spark.read.schema(BLOCKS).option("mode", "FAILFAST").json(path).where("type = 'content'")


def sidecar(df: DataFrame, key: str = "path", text: str = "text") -> dict[str, DataFrame]:
    """Blocks, tables, drawings and equations of Markdown-like texts as tables by name, each with its document, its own id, and the id of the
    block it stands in: blocks (doc, blockid, pos, level, heading, parent_headings, content), tables (heading, dimension, header, content),
    drawings (path, alt), equations (content). Parsed once each, in Arrow batches."""
    blocks = blocks_of(df, key, text).select(F.col(key).cast("string").alias("doc"), F.concat_ws("-b", F.col(key).cast("string"), "pos").alias("blockid"), "pos", "level", "heading", F.col("parents").alias("parent_headings"), "content")

    @F.pandas_udf("array<struct<kind string, a string, b string, content string, rows int, columns int>>")
    def parts(texts: pd.Series) -> pd.Series:
        def one(t: str) -> list[tuple]:
            out = [("table", json.dumps(x["header"], ensure_ascii=False), None, x["content"], len(x["rows"]), max(len(x["header"]), *map(len, x["rows"]), 0) if x["rows"] else len(x["header"])) for x in markdown_tables(t)]
            out += [("drawing", m.group(2), m.group(1), None, 0, 0) for m in re.finditer(r"!\[([^\]\n]*)\]\(([^)\s]+)[^)]*\)", t or "")]
            return out + [("equation", None, None, (m.group(1) or m.group(2) or m.group(3)).strip(), 0, 0) for m in re.finditer(r"\$\$(.+?)\$\$|\\begin\{equation\*?\}(.+?)\\end\{equation\*?\}|\\\[(.+?)\\\]", t or "", re.S)]

        return texts.map(one)

    found = blocks.select("doc", "blockid", "heading", F.posexplode(parts("content")).alias("i", "x"))
    ident = F.concat_ws("-", "blockid", F.substring("x.kind", 1, 2), "i").alias("id")
    of = lambda kind: found.where(F.col("x.kind") == kind)
    return {
        "blocks": blocks,
        "tables": of("table").select("doc", ident, "blockid", "heading", F.array("x.rows", "x.columns").alias("dimension"), F.lit("markdown").alias("format"), F.col("x.a").alias("table_header"), "x.content"),
        "drawings": of("drawing").select("doc", ident, "blockid", "heading", F.col("x.a").alias("path"), F.col("x.b").alias("alt")),
        "equations": of("equation").select("doc", ident, "blockid", "heading", "x.content"),
    }


def assets(spark: SparkSession, path: str, most: int = MOST_BYTES) -> DataFrame:
    """(pack, name, content) of the files beside the text in text packs under a path."""
    packs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.textpack").load(path).where(F.col("length") <= most).select("path", "content")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for p, data in zip(b["path"], b["content"], strict=True):
                z = zipfile.ZipFile(io.BytesIO(bytes(data)))
                rows += [(p, n, z.read(n)) for n in z.namelist() if "/assets/" in f"/{n}" and not n.endswith("/")]
            yield pd.DataFrame(rows, columns=["pack", "name", "content"])

    return packs.mapInPandas(work, "pack string, name string, content binary")


def write_sidecar(blocks: DataFrame | dict[str, DataFrame], path: str, doc: str = "doc") -> None:
    """Blocks, or all tables of ``sidecar``, as JSON lines, one folder a document."""
    if isinstance(blocks, DataFrame):
        blocks.write.mode("overwrite").partitionBy(doc).json(path)
        return
    for name, df in blocks.items():
        df.write.mode("overwrite").partitionBy(doc).json(f"{path}/{name}")


def table_rows(markup: str | None) -> list[list[str]]:
    """Rows of a table given as JSON or HTML; anything else has none."""
    t = (markup or "").strip()
    if t.startswith("["):
        try:
            rows = json.loads(t)
        except ValueError:
            return []
        return [["" if c is None else str(c) for c in r] for r in rows if isinstance(r, list)]
    rows = re.findall(r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</table|\Z)", t)
    return [[html.unescape(re.sub(r"<[^>]+>", "", c)).strip() for c in re.findall(r"(?is)<t[hd]\b[^>]*>(.*?)(?=<t[hd]\b|</t[hdr]|\Z)", r)] for r in rows]


def has_header(markup: str | None) -> bool:
    """Whether the first row is a header: marked as one, or the only row without numbers."""
    if re.search(r"(?i)<th\b", markup or ""):
        return True
    rows = table_rows(markup)
    number = lambda r: any(re.fullmatch(r"[\d.,%+-]+", c) for c in r)
    return len(rows) > 1 and not number(rows[0]) and all(map(number, rows[1:]))


def to_markup(rows: list[list[str]], kind: str = "html", header: bool = False) -> str:
    """Rows as a table in HTML, JSON or Markdown; ``table_rows`` reads the first two again."""
    if kind == "json":
        return json.dumps(rows, ensure_ascii=False)
    if kind == "md":
        width = max(map(len, rows), default=0)
        lines = ["| " + " | ".join(c.replace("|", "\\|").replace("\n", " ") for c in [*r, *[""] * (width - len(r))]) + " |" for r in rows]
        return "\n".join([*lines[:1], "|" + " --- |" * width, *lines[1:]] if lines else [])
    tag = lambda i: "th" if header and i == 0 else "td"
    return "<table>" + "".join("<tr>" + "".join(f"<{tag(i)}>{html.escape(c)}</{tag(i)}>" for c in r) + "</tr>" for i, r in enumerate(rows)) + "</table>"


def xlsx_bytes(columns: list[str], rows: list[tuple], sheet: str = "Sheet1") -> bytes:
    """A workbook of one sheet: numbers as numbers, all else as inline strings."""
    from xml.sax.saxutils import escape

    def cell(v) -> str:
        if isinstance(v, bool) or v is None or not isinstance(v, (int, float)):
            text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", "" if v is None else str(v))
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
        return f"<c><v>{v!r}</v></c>"

    body = "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in [tuple(columns), *rows])
    head, out = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>', io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", head + '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        link = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/{0}" Target="{1}"/></Relationships>'
        z.writestr("_rels/.rels", head + link.format("officeDocument", "xl/workbook.xml"))
        z.writestr("xl/_rels/workbook.xml.rels", head + link.format("worksheet", "worksheets/sheet1.xml"))
        z.writestr("xl/workbook.xml", head + f'<workbook xmlns="{_S[1:-1]}" xmlns:r="{_R[1:-1]}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", head + f'<worksheet xmlns="{_S[1:-1]}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def export_lines(df: DataFrame, kind: str) -> DataFrame:
    """The lines of a txt or Markdown export."""
    line = F.concat_ws(" | " if kind == "md" else "\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns))
    return df.select((F.concat(F.lit("| "), line, F.lit(" |")) if kind == "md" else line).alias("value"))


#: Rows of one exported workbook; a table of more becomes several.
SHEET_ROWS = 500_000


def export(df: DataFrame, path: str, kind: str = "csv") -> None:
    """Entities or relations as csv, json, txt, Markdown or xlsx files. Workbooks are written by the tasks, so their path must be a folder that
    all executors mount."""
    if kind in ("csv", "json"):
        w = df.write.mode("overwrite")
        (w.option("header", "true").csv(path) if kind == "csv" else w.json(path))
        return
    if kind == "xlsx":
        import os
        import uuid

        columns, folder = df.columns, path.removeprefix("file://")

        def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            os.makedirs(folder, exist_ok=True)
            held: list[tuple] = []

            def save(rows: list[tuple]) -> str:
                name = f"{folder}/part-{uuid.uuid4().hex}.xlsx"
                with open(f"{name}.tmp", "wb") as f:
                    f.write(xlsx_bytes(columns, rows))
                os.rename(f"{name}.tmp", name)
                return name

            for b in batches:
                held += list(b.astype(object).where(b.notna(), None).itertuples(index=False, name=None))
                while len(held) >= SHEET_ROWS:
                    yield pd.DataFrame({"file": [save(held[:SHEET_ROWS])]})
                    held = held[SHEET_ROWS:]
            if held:
                yield pd.DataFrame({"file": [save(held)]})

        df.mapInPandas(write, "file string").collect()
        return
    export_lines(df, kind).write.mode("overwrite").text(path)
