"""Markup residue in text: which of HTML, Markdown, wiki or LaTeX a text holds, and its clean text with the structure kept.

Marks are recognised by their grammar, never by single signs, so that comparisons, arrows, paths, prices and array literals in
plain text stay. The text becomes blocks (heading, paragraph, list item, code, table row, formula), each with its length, its
share of stop words and its share of link text. First pass: structural blocks and those dense in stop words are content, those
dense in links without stop words are boilerplate. Second pass: the short blocks left open take the label of the nearest
decided neighbour (the one before, of equals). Content is written as plain paragraphs, ``# `` headings, ``- `` items, fenced
code, ``a | b`` table rows and formulas between dollar signs.

Cases: null stays null; empty, blank and unmarked texts come back as they are; a mark that never closes is ordinary text but
is itself removed; very long texts take time in proportion to their length; a tie between languages goes to the first of
HTML, LaTeX, wiki, Markdown.
"""

from __future__ import annotations

import bisect
import html as html_lib
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names that make a mark of each language.
HTML_TAGS = (
    "a abbr article aside b blockquote body br button caption center cite code col dd del div dl dt em figcaption figure font footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark meta nav ol option p pre q s samp script"
    " section select small span strike strong style sub sup svg table tbody td textarea tfoot th thead title tr tt u ul var video"
).split()
HTML_ENTITIES = "amp apos bull cent copy deg euro gt hellip laquo ldquo lsquo lt mdash middot nbsp ndash para pound quot raquo rdquo reg rsquo sect shy times trade".split()
LATEX_COMMANDS = (
    "begin end documentclass usepackage title author maketitle chapter section subsection subsubsection paragraph label ref eqref cite citep"
    " citet footnote emph textbf textit texttt textsc underline item hline caption centering includegraphics frac sqrt sum int prod alpha beta"
    " gamma delta epsilon lambda mu sigma theta omega leq geq neq approx cdot times log left right mathbb mathbf mathrm url href"
).split()

_TAG = r"</?(?:" + "|".join(sorted(HTML_TAGS, key=len, reverse=True)) + r")(?:\s[^<>]*)?/?>"
_HTML = re.compile(_TAG + r"|<!--|<!doctype\b|&(?:" + "|".join(HTML_ENTITIES) + r"|#\d{1,6}|#x[0-9a-f]{1,6});", re.I)
_LATEX = re.compile(r"\\(?:" + "|".join(sorted(LATEX_COMMANDS, key=len, reverse=True)) + r")(?![a-zA-Z])\*?(?=[\s{\[\\$^_(),.&]|$)|\$[^$\n]*[\\_^][^$\n]*\$|\\\[|\\\(|~\\|(?:^|(?<=[^\d\s\\] ))%[ \t]+[a-zA-Z][^\n%]*$", re.M)
_WIKI = re.compile(r"\[\[[^\W\d_:][^\[\]\n]*\]\]|\{\{[^{}\n][^{}]*\}\}|'''?[^'\n]+'''?|^={2,6}[^=\n]+={2,6}[ \t]*$|^\{\|[ \w=\"]*$|\[https?://[^\s\]]+ [^\]\n]+\](?!\()|^\|-+[ \t]*$", re.M)
_MARKDOWN = re.compile(
    r"^ {0,3}#{1,6} +\S|^ {0,3}(?:```|~~~)|(?<![*\w])\*\*(?!\s)[^*\n]+\*\*|(?<!\w)__(?!\s)[^_\n]+__(?!\w)|!?\[[^\]\n]*\]+\([^)\s]+(?: \"[^\"]*\")?\)"
    r"|^ *\|?(?: *:?-{3,}:? *\|)+(?: *:?-{3,}:? *)?\|?[ \t]*$|(?<!`)`[^`\n]+`(?!`)|^[^\s#>|=-][^\n]*\n(?:={4,}|-{4,})[ \t]*$|^> +\S"
    r"|^[ \t]*[-+*] +\S[^\n]*\n[ \t]*[-+*] +\S",
    re.M,
)
# the wiki's double quotes alone also stand in plain text, so they count only as bold or around words
LANGUAGES = (("html", _HTML), ("latex", _LATEX), ("wiki", _WIKI), ("markdown", _MARKDOWN))

_FENCE = re.compile(r"^ {0,3}(```|~~~)[^\n]*\n(.*?)(?:^ {0,3}\1[ \t]*$|\Z)", re.M | re.S)
_GAP = re.compile(r"\n[ \t]*\n\s*")


@dataclass
class Block:
    kind: str  # heading, text, item, code, row, formula
    text: str
    links: int = 0  # characters of link text
    level: int = 0


# Stop words of the corpus's Latin-script languages.
STOP_WORDS = frozenset(
    "a an and are as at be been but by for from had has have he if in is it its not of on one or our over that the their there they this to"
    " was we were when which with du de la le les des et en est une un que qui dans por los las el se del una con der die das und ist ein eine"
    " zu von den dem mit für auf nicht wir".split()
)
_WORD = re.compile(r"\w+")


def _decided(first: list) -> list[tuple[int | None, int | None]]:
    """For each place the nearest decided places (that are not None) at or before it, and at or after it."""
    last, seen = [], None
    for i, x in enumerate(first):
        seen = i if x is not None else seen
        last.append(seen)
    after, seen = [None] * len(first), None
    for i in reversed(range(len(first))):
        seen = i if first[i] is not None else seen
        after[i] = seen
    return list(zip(last, after, strict=True))


def _nearest(i: int, near: tuple[int | None, int | None]) -> int | None:
    """The nearer of two decided places, the one before of equals."""
    a, b = near
    return a if b is None or a is not None and i - a <= b - i else b


def density(text: str) -> float:
    """The share of stop words."""
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def marks(text: str) -> list[tuple[str, dict[str, int]]]:
    """(block, marks of each language) of the blocks of a text between empty lines; the inside of a Markdown code fence is no mark of
    another language. A mark that runs over several blocks counts in its first."""
    outside = _FENCE.sub(lambda m: "```" + re.sub(r"[^\n]", " ", m.group()[3:-3]) + "```", text) if "```" in text or "~~~" in text else text
    starts = [0, *(m.end() for m in _GAP.finditer(outside))]
    blocks: list[tuple[str, dict[str, int]]] = [(outside[a:b], {}) for a, b in zip(starts, [*starts[1:], len(outside)], strict=True)]
    for name, pattern in LANGUAGES:
        for m in pattern.finditer(outside):
            found = blocks[bisect.bisect_right(starts, m.start()) - 1][1]
            found[name] = found.get(name, 0) + 1
    return blocks


def language(text: str | None) -> str | None:
    """The markup language of a text, or None for plain text, by its blocks in two passes. First: a block in which one language has
    the most marks is of that language. Second: blocks left open, with as many marks of several languages, take the language of the
    nearest decided block if it is one of theirs. The language of the most marks in blocks of its own is the text's; blocks that are
    dense in stop words lead of equals, for there marks are least likely to be somebody's code."""
    if not text or text.isspace():
        return None
    blocks = marks(text)
    if not any(found for _, found in blocks):
        return None
    first: list[str | None] = []
    for _, found in blocks:
        most = max(found.values(), default=0)
        best = [name for name, _ in LANGUAGES if found.get(name) == most] if most else []
        first.append(best[0] if len(best) == 1 else None)
    near = _decided(first)
    total: dict[str, float] = {}
    for i, (block, found) in enumerate(blocks):
        if found:
            at = _nearest(i, near[i])
            # a text without any decided block has ties only, which go to the first language
            label = first[at] if at is not None and first[at] in found else next(name for name, _ in LANGUAGES if name in found)
            total[label] = total.get(label, 0) + found[label]
    most = max(total.values())
    best = [name for name, _ in LANGUAGES if total.get(name) == most]
    if len(best) > 1:
        in_prose = {name: sum(found.get(name, 0) * density(block) for block, found in blocks) for name in best}
        best.sort(key=lambda name: -in_prose[name])
    return best[0]


def classify(blocks: list[Block]) -> list[bool]:
    """Whether each block is content."""
    first: list[bool | None] = []
    for b in blocks:
        dense = density(b.text)
        linked = b.links / max(1, len(b.text))
        if b.kind in ("heading", "code", "row", "formula"):
            first.append(True)
        elif linked > 0.6 and dense < 0.15:
            first.append(False)
        elif dense >= 0.2 and len(b.text) >= 25 or len(b.text) >= 120 and linked < 0.3:
            first.append(True)
        else:
            first.append(None)
    near = _decided(first)
    at = [_nearest(i, x) for i, x in enumerate(near)]
    return [True if k is None else bool(first[k]) for k in at]


def render(blocks: list[Block]) -> str:
    """Content blocks as text."""
    keep = [b for b, k in zip(blocks, classify(blocks), strict=True) if k and b.text.strip()]
    out: list[str] = []
    for i, b in enumerate(keep):
        t = b.text.strip("\n") if b.kind == "code" else re.sub(r"[ \t]*\n[ \t]*", "\n", re.sub(r"[ \t\xa0\u2000-\u200a]+", " ", b.text)).strip()
        if b.kind == "heading":
            t = "#" * max(1, b.level) + " " + t
        elif b.kind == "item":
            t = "- " + t
        elif b.kind == "code":
            t = f"```\n{t}\n```"
        elif b.kind == "formula":
            t = f"${t}$"
        joined = i and b.kind == keep[i - 1].kind and b.kind in ("item", "row")
        out.append(("\n" if joined else "\n\n" if i else "") + t)
    return "".join(out)


_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|(?P<tag>" + _TAG + r")|<!doctype[^>]*>", re.I | re.S)
_BLOCK_TAGS = frozenset("p div ul ol section article header footer main body table blockquote form figure nav aside dl dd dt title center hr".split())


def from_html(text: str) -> list[Block]:
    blocks: list[Block] = []
    buf: list[str] = []
    state = {"kind": "text", "level": 0, "links": 0, "in_link": False}
    row: list[str] | None = None

    def flush(kind: str = "text", level: int = 0) -> None:
        t = html_lib.unescape("".join(buf))
        buf.clear()
        if t.strip():
            if state["kind"] == "code":
                blocks.append(Block("code", t))
            else:
                for k, part in enumerate(re.split(r"\n\s*\n", t)):
                    if part.strip():
                        blocks.append(Block(state["kind"], part, state["links"] if not k else 0, state["level"]))
        state.update(kind=kind, level=level, links=0)

    at = 0
    for m in _TOKEN.finditer(text):
        piece = text[at : m.start()]
        if piece:
            buf.append(piece)
            if state["in_link"]:
                state["links"] += len(piece)
        at = m.end()
        tag = m.group("tag")
        if not tag:
            continue
        closing = tag.startswith("</")
        name = re.match(r"</?(\w+)", tag).group(1).lower()
        if name == "br":
            buf.append("\n")
        elif name == "a":
            state["in_link"] = not closing
        elif name in ("td", "th", "tr", "table", "caption"):
            if row is None and not (name == "table" and closing):
                flush()
                row = []
            if row is None:
                continue
            cell = html_lib.unescape("".join(buf)).strip()
            buf.clear()
            if cell:
                row.append(re.sub(r"\s+", " ", cell))
            if name in ("tr", "table") and row:
                blocks.append(Block("row", " | ".join(row)))
                row = []
            if name == "table":
                row = None if closing else []
        elif re.fullmatch(r"h[1-6]", name):
            flush("text" if closing else "heading", 0 if closing else int(name[1]))
        elif name == "li":
            flush("text" if closing else "item")
        elif name == "pre":
            flush("text" if closing else "code")
        elif name in _BLOCK_TAGS:
            flush()
    buf.append(text[at:])
    if row is not None:
        row += [c for c in [html_lib.unescape("".join(buf)).strip()] if c]
        buf.clear()
        if row:
            blocks.append(Block("row", " | ".join(row)))
    flush()
    return blocks


def _inline_markdown(t: str) -> tuple[str, int]:
    links = 0

    def link(m: re.Match) -> str:
        nonlocal links
        links += len(m.group(1))
        return m.group(1)

    t = re.sub(r"!\[([^\]\n]*)\]\([^)\s]+(?: \"[^\"]*\")?\)", r"\1", t)
    t = re.sub(r"\[((?:[^\[\]\n]|\[[^\]\n]*\])+)\]\([^)\s]+(?: \"[^\"]*\")?\)", link, t)
    t = re.sub(r"(?<![*\w])\*\*(?!\s)([^*\n]+)\*\*", r"\1", t)
    t = re.sub(r"(?<!\w)__(?!\s)([^_\n]+)__(?!\w)", r"\1", t)
    return re.sub(r"(?<!`)`([^`\n]+)`(?!`)", r"\1", t), links


def from_markdown(text: str) -> list[Block]:
    blocks: list[Block] = []
    para: list[str] = []

    def flush() -> None:
        if para:
            t, n = _inline_markdown("\n".join(para))
            blocks.append(Block("text", t, n))
            para.clear()

    lines, i = text.split("\n"), 0
    while i < len(lines):
        line = lines[i]
        fence = re.match(r" {0,3}(```|~~~)", line)
        head = re.match(r" {0,3}(#{1,6}) +(.*?)[ #]*$", line)
        item = re.match(r"[ \t]*(?:[-+*]|\d{1,3}[.)]) +(.*)", line)
        if fence:
            flush()
            code = []
            i += 1
            while i < len(lines) and not lines[i].lstrip().startswith(fence.group(1)):
                code.append(lines[i])
                i += 1
            blocks.append(Block("code", "\n".join(code)))
        elif head:
            flush()
            blocks.append(Block("heading", _inline_markdown(head.group(2))[0], level=len(head.group(1))))
        elif para and re.fullmatch(r"(={4,}|-{4,})[ \t]*", line):
            title = para.pop()
            flush()
            blocks.append(Block("heading", _inline_markdown(title)[0], level=1 if line[0] == "=" else 2))
        elif re.match(r" *\|.*\|[ \t]*$", line) or re.fullmatch(r" *\|?(?: *:?-{3,}:? *\|)+(?: *:?-{3,}:? *)?\|?[ \t]*", line):
            flush()
            if not re.fullmatch(r"[ |:-]+", line):
                blocks.append(Block("row", " | ".join(_inline_markdown(c.strip())[0] for c in line.strip().strip("|").split("|"))))
        elif item and not (item.group(0).lstrip()[0].isdigit() and para):
            flush()
            t, n = _inline_markdown(item.group(1))
            blocks.append(Block("item", t, n))
        elif not line.strip():
            flush()
        else:
            para.append(re.sub(r"^(?:> ?)+", "", line))
        i += 1
    flush()
    return blocks


def _inline_wiki(t: str) -> tuple[str, int]:
    t = re.sub(r"\{\{[^{}]*\}\}", "", t)
    t = re.sub(r"\[\[(?:File|Image|Category|Datei|Bild|Kategorie|Fichier|Catégorie):(?:[^\[\]]|\[\[[^\[\]]*\]\])*\]\]", "", t, flags=re.I)
    t = re.sub(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]+)\]\]", r"\1", t)
    links = sum(len(m.group(1)) for m in re.finditer(r"\[https?://\S+ ([^\]\n]+)\]", t))
    t = re.sub(r"\[https?://\S+ ([^\]\n]+)\]", r"\1", t)
    t = re.sub(r"<ref[^>/]*/>|<ref[^>]*>.*?</ref>", "", t, flags=re.S | re.I)
    return re.sub(r"'{2,5}([^'\n]+)'{2,5}", r"\1", t), links


def from_wiki(text: str) -> list[Block]:
    blocks: list[Block] = []
    para: list[str] = []
    row: list[str] | None = None

    def flush() -> None:
        if para:
            t, n = _inline_wiki("\n".join(para))
            blocks.append(Block("text", t, n))
            para.clear()

    for line in re.sub(r"\{\{[^{}]*\}\}", "", text).split("\n"):
        head = re.fullmatch(r"(={2,6})\s*([^=\n]+?)\s*={2,6}[ \t]*", line)
        item = re.match(r"[*#:;]+ *(\S.*)", line)
        if line.startswith("{|"):
            flush()
            row = []
        elif row is not None:
            if line.startswith(("|-", "|}")):
                if row:
                    blocks.append(Block("row", " | ".join(row)))
                row = None if line.startswith("|}") else []
            elif line.startswith(("!", "|")):
                row += [_inline_wiki(c.strip())[0] for c in re.split(r"\|\||!!", line[1:])]
            elif line.strip():
                row.append(_inline_wiki(line.strip())[0])
        elif head:
            flush()
            blocks.append(Block("heading", _inline_wiki(head.group(2))[0], level=len(head.group(1))))
        elif item:
            flush()
            t, n = _inline_wiki(item.group(1))
            blocks.append(Block("item", t, n))
        elif not line.strip():
            flush()
        else:
            para.append(line)
    if row:
        blocks.append(Block("row", " | ".join(row)))
    flush()
    return blocks


_LEVELS = {"chapter": 1, "section": 1, "subsection": 2, "subsubsection": 3, "paragraph": 4}
_ENV = re.compile(r"\\begin\{(equation|align|displaymath|gather|tabular|verbatim|lstlisting|itemize|enumerate|figure|table)\*?\}(.*?)(?:\\end\{\1\*?\}|\Z)", re.S)
_SECTION = re.compile(r"\\(chapter|section|subsection|subsubsection|paragraph)\*?\{([^{}]*)\}")


def _inline_latex(t: str) -> str:
    t = re.sub(r"(?<!\\)%[^\n]*", "", t)
    formulas: list[str] = []

    def hold(m: re.Match) -> str:
        formulas.append(m.group(0))
        return f"\x00{len(formulas) - 1}\x00"

    t = re.sub(r"\$[^$\n]+\$", hold, t)
    t = re.sub(r"~?\\(?:label|cite[a-z]*|ref|eqref|pageref|index|vspace|hspace|bibliography|usepackage|documentclass)\*?(?:\[[^\]]*\])*\{[^{}]*\}", "", t)
    for _ in range(4):  # marks within marks
        t, n = re.subn(r"\\footnote\{([^{}]*)\}", r" (\1)", t)
        t, k = re.subn(r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}", r"\1", t)
        if not n + k:
            break
    t = re.sub(r"\\(?:hline|centering|maketitle|noindent|item)(?![a-zA-Z])", "", t)
    t = re.sub(r"\\([%&#_{}$])", r"\1", t).replace("\\\\", "\n").replace("~", " ")
    return re.sub("\x00(\\d+)\x00", lambda m: formulas[int(m.group(1))], t)


def from_latex(text: str) -> list[Block]:
    blocks: list[Block] = []

    def plain(t: str) -> None:
        at = 0
        for m in _SECTION.finditer(t):
            paragraphs(t[at : m.start()])
            blocks.append(Block("heading", _inline_latex(m.group(2)), level=_LEVELS[m.group(1)]))
            at = m.end()
        paragraphs(t[at:])

    def paragraphs(t: str) -> None:
        for p in re.split(r"\n\s*\n", t):
            p = _inline_latex(re.sub(r"\\(?:begin|end)\{[^{}]*\}", "", p))
            if p.strip():
                blocks.append(Block("text", p))

    at = 0
    for m in _ENV.finditer(text):
        plain(text[at : m.start()])
        at, name, body = m.end(), m.group(1), m.group(2)
        if name == "tabular":
            for r in re.split(r"\\\\", re.sub(r"^\s*\{[^{}]*\}", "", body)):
                cells = [_inline_latex(c).strip() for c in re.split(r"(?<!\\)&", r)]
                if any(cells):
                    blocks.append(Block("row", " | ".join(cells)))
        elif name in ("verbatim", "lstlisting"):
            blocks.append(Block("code", body))
        elif name in ("itemize", "enumerate"):
            blocks.extend(Block("item", _inline_latex(x)) for x in re.split(r"\\item\b", body) if x.strip())
        elif name in ("figure", "table"):
            plain(body)
        else:
            blocks.append(Block("formula", re.sub(r"\\label\{[^{}]*\}", "", re.sub(r"\s+", " ", body)).strip()))
    plain(text[at:])
    return blocks


_READERS = {"html": from_html, "markdown": from_markdown, "wiki": from_wiki, "latex": from_latex}


def clean(text: str | None) -> tuple[str | None, str | None]:
    """(language, clean text); the text of no language comes back as it is."""
    kind = language(text)
    return (kind, render(_READERS[kind](text))) if kind else (None, text)


def convert(df: DataFrame, text: str = "content") -> DataFrame:
    """Adds kind (null for plain text) and clean to every row. One narrow pass."""

    @F.pandas_udf("struct<kind string, clean string>")
    def work(texts: pd.Series) -> pd.DataFrame:
        done = [clean(t) for t in texts]
        return pd.DataFrame({"kind": [k for k, _ in done], "clean": [c for _, c in done]}, dtype=object)

    return df.withColumn("_m", work(F.col(text))).select("*", "_m.kind", "_m.clean").drop("_m")
