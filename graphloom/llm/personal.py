"""Personal details in free text: found, and replaced by typed placeholders.

One Aho-Corasick automaton finds the anchors in a single pass (at-signs in their spellings, digits, labels of identity numbers,
account numbers, street words, given names, titles, initials, words that introduce a person, and endings of family names). At each
anchor a deterministic parser expands to the left and right as far as its grammar goes, which is counted in words and never in
characters, checks it and gives exact boundaries. Overlapping finds go to the earlier kind of KINDS, then to the longer one.

Cases: null, empty and blank texts have no details and come back as they are; a detail that stands twice is replaced twice and
reported once; texts of any length are read once; labels and titles stay in the text; a family name alone is no detail.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.given_names import GIVEN, SHORT

KINDS = ("email", "account", "address", "idnum", "phone", "name")

# Labels of identity numbers, titles, street words and words that begin sentences or fields.
ID_LABELS = (
    "ssn|social security|passport|passeport|pasaporte|reisepass|personal id|identity number|identity no|id number|tax identity|tax id|tax no|tax number|tin"
    "|dni|nie|nif|nino|national insurance|ausweisnummer|personalausweis|ausweis-nr|steuer-id|steuernummer|numéro fiscal|numéro d'identité|personnummer|cpr"
).split("|")
TITLES = "Dr Dr. Prof Prof. Professor Mr Mr. Mrs Mrs. Ms Ms. Miss Sir Herr Frau Madame Monsieur Mme M. Señor Señora Sr. Sra. Doctor".split()
STREET_AFTER = "Street St Lane Avenue Ave Road Rd Way Court Close Drive Crescent Terrace Place Square Gardens Grove Hill Row Walk Boulevard".split()
STREET_BEFORE = "rue avenue quai impasse boulevard place chemin allée cours square route Calle Plaza Avenida Paseo Camino Carrera Ronda Via Viale Piazza".split()
STREET_ENDINGS = "straße strasse weg allee gasse platz ufer ring damm".split()
STREET_GERMAN = ("Am", "An der", "An den", "Auf dem", "Im", "In der", "Zum", "Zur", "Unter den")
#: Words that begin sentences or fields, and no names.
NOT_FAMILY = frozenset(
    "A About After All Also Although An And Are As At Author Before Between Both But By Contact Der Die Das Each El For From He Her His How I If In It Its La Las Le Les Los"
    " Mobil My No Of On Or Our Passport Please See She So Tel Thanks That The Their Then There These They This Those To Two Une Un Was We What When Where Which While Who Why"
    " With You Your Kontakt Anschrift Address Best Kind Dear Regards Sincerely Yours"
    .split()
)
# What introduces a person, words that stand in names of bodies and places, particles of family names, family names
# that stand first, and endings of family names in several languages.
CUES = (
    "Author:|Authors:|Contact:|Name:|Nom:|Nombre:|Speaker:|Speaker was|Interviewed|Interviewer:|Interviewee:|Interview with|Entretien avec|Gesprächspartner:|Gesprächspartnerin:"
    "|Thanks to|thanks to|typed by|written by|signed by|prepared by|recorded by|reviewed by|chaired by|d'après|From:|To:|Cc:|Attn:|Dear|Liebe|Lieber|Cher|Chère|Estimado|Estimada"
    "|Regards,|regards|regards,|Best wishes,|Sincerely,|Yours,|MfG|Mit freundlichen Grüßen|Cordialement,|Saludos,|Atentamente,"
).split("|")
BODIES = frozenset(
    "Academy Archive Archives Association Bank Bay Board Bureau Centre Center City Club College Committee Company Council County Department Editor Faculty Foundation Fund Group"
    " Hall Hospital House Institute Island Lake Laboratory Library Ministry Mount Museum National North Northern Ocean Office Park Port Press Project Region River Royal School Sea"
    " Service Society South Southern East Eastern Station Survey Team Trust Union United University West Western"
    .split()
)
PARTICLES = "al bin da das de del della den der di dos du el ibn la le ten ter van von zu Al Bin Da De Del Den Der Di Du El La Le Thi Van Von".split()
FAMILY_FIRST = "Nguyen Nguyễn Tran Trần Pham Phạm Hoang Hoàng Huynh Huỳnh Phan Dang Đặng Bui Bùi Ngo Ngô".split()
FAMILY_ENDINGS = "adze akis ashvili chuk czyk cki eanu enko escu ević ewicz ewski gaard ić idis inski nejad ński oğlu opoulos ová ović owicz owski quist sson ström wicz zadeh ójcik".split()


def _letters(test: Callable[[str], bool]) -> str:
    """A character class of all letters of alphabets with capitals that pass a test."""
    there = [c for c in range(0x41, 0x590) if test(chr(c))] + [c for c in range(0x10A0, 0x10FF) if test(chr(c))] + [c for c in range(0x1E00, 0x2000) if test(chr(c))]
    runs: list[list[int]] = []
    for c in there:
        if runs and runs[-1][1] == c - 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[" + "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in runs) + "]"


_UP, _LO = _letters(str.isupper), _letters(str.islower)
# letters of alphabets that write mail addresses without spaces around them are no part of one
_MAIL_LETTER = "A-Za-z0-9À-ÖØ-öø-ɏͰ-ӿ"
_LOCAL = rf"[{_MAIL_LETTER}][{_MAIL_LETTER}._%+'-]{{0,63}}"
_DOT = r"(?:\.|[ ]?(?:\[dot\]|\(dot\)|\{dot\})[ ]?| DOT | dot )"
_LABEL = rf"[{_MAIL_LETTER}](?:[{_MAIL_LETTER}-]{{0,61}}[{_MAIL_LETTER}])?"
_AT = r"(?:@|[ ]@[ ]|[ ]?(?:\[at\]|\(at\)|\{at\})[ ]?|[ ]AT[ ])"
_MAIL_LEFT = re.compile(_LOCAL + r"\Z")
_MAIL_RIGHT = re.compile(_AT + rf"{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}(?:xn--[a-z0-9-]{{2,59}}|[A-Za-zÀ-ÖØ-öø-ɏͰ-ӿ]{{2,24}})(?![{_MAIL_LETTER}])", re.I)

_PHONE = re.compile(
    r"\+\d{1,3}[ .-]?\(0\)[ ]?\d{1,5}(?:[ /.-]\d{2,8}){1,4}"
    r"|(?:\+|00)\d{1,3}(?:[ .-]\(?\d{1,6}\)?){2,5}"
    r"|\+\d{9,14}"
    r"|\(\d{2,5}\)[ ]?\d{3,4}[ .-]\d{3,4}"
    r"|0\d{1,5}/\d{3,8}(?:[- ]\d{1,5})?"
    r"|0\d(?:([. -])\d\d)(?:\1\d\d){3}"
    r"|0\d{3,4} \d{5,7}(?: \d{3,4})?"
    r"|0\d{2,4} \d{3,4} \d{3,4}"
    r"|\d{3}[.-]\d{3}[.-]\d{4}"
    r"|\d{3}-\d{4}"
)
# The most digits of a national number after some country codes (others: 12), and after a single leading zero.
NATIONAL_DIGITS = {"1": 10, "33": 9, "34": 9, "39": 11, "41": 9, "43": 11, "44": 10, "49": 11, "61": 9, "81": 10, "86": 11, "91": 10}
LOCAL_DIGITS = 11
_PHONE_CUE = re.compile(r"(?:tel|tél|phone|mobil|mobile|call|cell|fon|fax|number|reached on|\(m\)|\(w\)|teléfono|móvil|handy|whatsapp)\W{0,4}\Z", re.I)
_ID = re.compile(
    r"\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}|\d{2} \d{3} \d{3} \d{3}|\d{6}-\d{4}|\d{8}-?[A-Z]|[A-Z]\d{7}[A-Z]?|[A-Z]{2} ?\d{3} ?\d{3}(?: ?[A-D])?|[A-Z]{2} \d{2} \d{2} \d{2} [A-Z]"
    r"|[A-Z]{1,2}\d{6,8}|\d{9,13}|\d{2,3}(?:[ .-]\d{2,4}){2,3}"
)
_ID_GAP = re.compile(r"(?:[ ]?(?:no\.?|nr\.?|number|num\.?|n°|card|code|is|was)\b)*[ :.,#=-]{0,4}", re.I)

_WORD = rf"{_UP}[\w'’-]+"
_POST = r"(?:[A-Z]{1,2}\d{1,2}[A-Z]? \d[A-Z]{2}|\d{5}(?:-\d{4})?)"
_TOWN = rf"{_WORD}(?:[ -]{_WORD})?"
_SEP = r"(?:,[ ]?\n?|[ ]?\n|,[ ]?\|?[ ])[ ]*"
_AFTER = "|".join(STREET_AFTER)
_BEFORE = "|".join(STREET_BEFORE)
_ADDRESSES = (
    # number and street, town, code: the flat first, the code behind the town or none
    re.compile(rf"(?:(?:Flat|Apt\.?|Unit|Apartment|Suite) \d+[A-Za-z]?,? )?\d{{1,4}}[A-Za-z]? (?:{_WORD} ){{1,3}}(?:{_AFTER})\b{_SEP}(?:(?:{_TOWN}{_SEP}){{0,2}}{_TOWN}(?: |{_SEP}){_POST}|{_WORD})(?![\w-])"),
    # number, street word, name; code and town
    re.compile(rf"\d{{1,4}}[A-Za-z]?(?: bis| ter)?,? (?:{_BEFORE}) (?:[\wà-ÿ'’-]+ ?){{1,5}}{_SEP}\d{{5}} {_WORD}(?:[ -]{_WORD})??(?![\w-])"),
    # street word, name, number; code and town
    re.compile(rf"(?:{_BEFORE}) (?:[\wà-ÿ'’-]+ ){{1,5}}\d{{1,4}}[A-Za-z]?{_SEP}\d{{5}} {_WORD}(?![\w-])"),
    # German street, number; code and town
    re.compile(rf"(?:(?:{'|'.join(STREET_GERMAN)}) (?:{_WORD} ){{1,3}}|{_UP}[\wà-ÿ-]*(?:{'|'.join(STREET_ENDINGS)}) )\d{{1,4}}[ ]?[a-z]?{_SEP}\d{{5}} {_WORD}(?![\w-])"),
)

_SHORT_PARTICLES = "|".join(p for p in PARTICLES if p.islower())
_CAPITAL = rf"(?:{_UP}{_LO}+(?:[-’']{_UP}?{_LO}+)*|{_UP}['’]{_UP}{_LO}+|{_UP}{{3,}}(?:-{_UP}{{2,}})?)"
_FAMILY = rf"(?:(?:{_SHORT_PARTICLES}) )*{_CAPITAL}"
_INITIALS = rf"(?:{_UP}\.[ ]?){{1,3}}"
_SET_OFF = r"(?=[ ]?(?:[\n,;|()]|\Z|\.(?:[ ]?\n|\Z)))"
#: A name after a cue: three words that stand alone, or a given name (or initials), middle initials or particles, and a family name.
_CUED = re.compile(
    rf"(?P<n>(?P<w>{_CAPITAL}) {_CAPITAL} (?P<f>{_CAPITAL})){_SET_OFF}"
    rf"|(?P<m>(?P<g>(?:{_SHORT_PARTICLES} )*{_CAPITAL}), (?:{_CAPITAL}(?: {_UP}\.?(?!\w))?|{_INITIALS}))(?![\w])"
    rf"|(?P<k>(?:(?P<v>{_CAPITAL})|{_UP}\.)(?: {_UP}\.)*(?: (?:{'|'.join(PARTICLES)}))* (?P<h>{_CAPITAL}))(?![\w])"
)
_CUE_GAP = re.compile(rf"[ ]?[:,]?\s{{1,3}}(?:(?:{'|'.join(map(re.escape, sorted(TITLES, key=len, reverse=True)))}) )*")
_FIRST_FAMILY = re.compile(rf"(?: (?:Van|Thi|Văn|Thị))?(?: (?P<f>{_CAPITAL})){{1,2}}?(?![\w])")
_AFTER_GIVEN = re.compile(rf"(?: {_UP}\.?(?!{_LO}))?(?: {_UP}\.)? (?P<f>{_FAMILY})(?![\w])")
_BEFORE_GIVEN = re.compile(rf"(?<![\w.])(?P<f>{_FAMILY}), \Z")
_AFTER_LAST = re.compile(rf"(?: {_UP}\.?(?![\w]))?")
_FROM_INITIALS = re.compile(rf"(?:{_UP}\.[ ]?){{1,3}}(?P<f>{_UP}{_LO}{{2,}}(?:-{_UP}{_LO}+)?|{_UP}{{3,}})(?![\w])")
_LAST_INITIALS = re.compile(rf"(?P<f>{_FAMILY}), {_INITIALS}")
_TITLED = re.compile(rf" (?P<n>(?:{_WORD}|{_UP}\.)(?: {_UP}\.)* (?P<f>{_FAMILY}))(?![\w])|  ?(?P<m>(?P<g>{_FAMILY}), (?:{_WORD}|{_INITIALS}))(?![\w])")


@functools.cache
def automaton():
    """Anchors of all kinds; one for each process."""
    import ahocorasick

    a = ahocorasick.Automaton()
    words: dict[str, set[tuple[str, int]]] = {}

    def add(word: str, kind: str) -> None:
        words.setdefault(word, set()).add((kind, len(word)))

    for at in ("@", "[at]", "(at)", "{at}", " AT "):
        add(at, "email")
    for digit in "0123456789":
        add(digit, "digit")
    for label in ID_LABELS:
        for form in {label, label.upper(), label.capitalize(), label.title(), label.replace(" id", " ID"), label.capitalize().replace(" id", " ID")}:
            add(form, "idnum")
    for word in STREET_AFTER:
        add(f" {word}", "street")
    for word in STREET_BEFORE:
        add(f"{word} ", "before")
    for word in STREET_ENDINGS:
        add(f"{word} ", "german")
    for word in STREET_GERMAN:
        add(f"{word} ", "german")
    for name in {*GIVEN, *(s.capitalize() for s in SHORT)}:
        add(name, "given")
        add(name.upper(), "given")
    for title in TITLES:
        add(f"{title} ", "title")
    for c in map(chr, range(0x41, 0x530)):
        if c.isupper():
            add(f"{c}.", "initial")
    for cue in CUES:
        add(cue, "cue")
    for name in FAMILY_FIRST:
        add(name, "first")
    for ending in FAMILY_ENDINGS:
        add(ending, "ending")
    for w, kinds in words.items():
        a.add_word(w, tuple(sorted(kinds)))
    a.make_automaton()
    return a


def _family(m: re.Match, group: str = "f") -> bool:
    f = m.group(group)
    return f not in NOT_FAMILY and f.capitalize() not in NOT_FAMILY


def _email(t: str, s: int, e: int) -> Iterator[tuple[str, int, int]]:
    # the spelling of the at-sign may take spaces on both sides
    for gap in (0, 1):
        begin = s - gap
        if gap and (begin < 0 or t[begin] != " "):
            continue
        left = _MAIL_LEFT.search(t[max(0, begin - 64) : begin])
        right = _MAIL_RIGHT.match(t, begin)
        if left and right:
            at = begin - (left.end() - left.start())
            yield "email", at, right.end()
            return


def _phone_end(phone: str) -> int:
    """Length of the phone number without groups that are too many for its country (a number that the text goes on with)."""
    digits = re.sub(r"\D", "", phone.replace("(0)", ""))
    most = LOCAL_DIGITS
    if phone[0] == "+" or digits.startswith("00"):
        body = digits[2:] if digits.startswith("00") and phone[0] != "+" else digits
        code = next((body[:k] for k in (1, 2) if body[:k] in NATIONAL_DIGITS), body[:2])
        most = NATIONAL_DIGITS.get(code, 12) + len(code) + len(digits) - len(body)
    end = len(phone)
    while True:
        part = phone[:end]
        last = re.search(r"[ .-]\(?\d+\)?\Z", part)
        if not last:
            return end
        have = sum(c.isdigit() for c in part.replace("(0)", ""))
        if have <= most and sum(c.isdigit() for c in last.group()) > 1:
            return end
        end = last.start()


# The form of an international account number, and that of a payment card.
_ACCOUNT = re.compile(r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_CARD = re.compile(r"\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?![\d])")


def _account(t: str, s: int) -> Iterator[tuple[str, int, int]]:
    """An account number whose check digits hold (remainder 1 by 97), or a card number whose digit sum does."""
    if s >= 2 and t[s - 2 : s].isalpha() and not t[s - 3 : s - 2].isalnum():
        m = _ACCOUNT.match(t, s - 2)
        while m:
            plain = m.group().replace(" ", "")
            if 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                yield "account", s - 2, m.end()
                return
            # a word of capitals after it is no part of it
            last = t.rfind(" ", s, m.end())
            m = _ACCOUNT.fullmatch(t, s - 2, last) if last > s else None
    elif not t[s - 1 : s].isalnum():
        m = _CARD.match(t, s)
        if m:
            d = [int(c) for c in m.group() if c.isdigit()]
            if sum(x if i % 2 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0:
                yield "account", s, m.end()


def _words_back(t: str, at: int, n: int) -> int:
    """Where the n-th word before a place begins; an empty line ends the walk."""
    while n and at > 0:
        while at > 0 and t[at - 1].isspace():
            if t[at - 1] == "\n" and t[at - 2 : at - 1] in ("", "\n"):
                return at
            at -= 1
        while at > 0 and not t[at - 1].isspace():
            at -= 1
        n -= 1
    return at


def _words_on(t: str, at: int, n: int) -> int:
    """Where the n-th word from a place on ends."""
    size = len(t)
    while n and at < size:
        while at < size and t[at].isspace():
            at += 1
        while at < size and not t[at].isspace():
            at += 1
        n -= 1
    return at


def _digits(t: str, s: int) -> Iterator[tuple[str, int, int]]:
    if s and (t[s - 1].isdigit() or t[s - 1].isalpha()):
        return
    start = s
    while start and t[start - 1] in "+(":
        start -= 1
    for at in sorted({start, s}):
        before = t[max(0, at - 24) : at]
        if before[-1:].isalnum() or re.search(r"[\d][-./:]\Z|[-/.:]\Z", before) and not _PHONE_CUE.search(before):
            continue
        m = _PHONE.match(t, at)
        if not m:
            continue
        e = _phone_end(m.group()) + at
        if t[e : e + 1].isalnum() or re.match(r"[-./:]\d", t[e : e + 2]):
            continue
        n = sum(c.isdigit() for c in t[at:e])
        if n < 7 or n > 15 or re.search(r"(?:ISBN|doi|grant|box|sample|release|accession|coordinates|pp\.|ratio)\W*\Z", before):
            continue
        yield "phone", at, e
        return


def _number(t: str, e: int) -> Iterator[tuple[str, int, int]]:
    gap = _ID_GAP.match(t, e)
    at = gap.end() if gap else e
    m = _ID.match(t, at)
    if m and not t[m.end() : m.end() + 1].isalnum() and not re.match(r"[-./]\d", t[m.end() : m.end() + 2]) and sum(c.isdigit() for c in m.group()) >= 6:
        yield "idnum", at, m.end()


#: The most words that the grammar of addresses has before its street word (flat, number, words of the street's name) and from it
#: on (the rest of the name, number, two localities, town, two parts of a code). A longer one would be no match either.
ADDRESS_BEFORE, ADDRESS_AFTER = 9, 14


def _address(t: str, s: int, e: int) -> Iterator[tuple[str, int, int]]:
    # an address begins at a number, a flat or a street word to the left of the anchor
    low, high = _words_back(t, s, ADDRESS_BEFORE), _words_on(t, s, ADDRESS_AFTER)
    for pattern in _ADDRESSES:
        for m in pattern.finditer(t, low, high):
            a, b = m.span()
            if a <= s + 1 and b >= e and not (a and t[a - 1].isalnum()):
                yield "address", a, b
                return


#: The most words of a family name with its particles.
FAMILY_WORDS = 5


def _name(t: str, s: int, e: int) -> Iterator[tuple[str, int, int]]:
    if s and (t[s - 1].isalnum() or t[s - 1] in "-@._+") or t[e : e + 1].isalnum() or t[e : e + 1] in tuple("@_"):
        return
    before = _BEFORE_GIVEN.search(t[_words_back(t, s, FAMILY_WORDS) : s])
    after = _AFTER_GIVEN.match(t, e)
    if before and _family(before):
        tail = _AFTER_LAST.match(t, e)
        yield "name", s - (before.end() - before.start()), tail.end() if tail else e
    elif after and _family(after):
        yield "name", s, after.end()


def _fit(*words: str | None) -> bool:
    """Whether none of the words begins a sentence or stands in the name of a body or a place."""
    return not any(w and (w in NOT_FAMILY or w.capitalize() in NOT_FAMILY or w.capitalize() in BODIES or w in STREET_AFTER or w in TITLES) for w in words)


def _cued(t: str, s: int, e: int) -> Iterator[tuple[str, int, int]]:
    """A name of any language after what introduces a person."""
    if s and (t[s - 1].isalnum() or t[s - 1] == "-"):
        return
    gap = _CUE_GAP.match(t, e)
    m = _CUED.match(t, gap.end()) if gap else None
    if m:
        g = next(x for x in "nmk" if m.group(x))
        words = [w for w in re.split(r"[ ,]+", m.group(g)) if w]
        if _fit(*words) and not (g == "k" and not m.group("v") and len(words) < 2):
            yield "name", m.start(g), m.end(g)


def _ended(t: str, e: int) -> Iterator[tuple[str, int, int]]:
    """A capital word and one with the ending of a family name."""
    if t[e : e + 1].isalnum() or t[e : e + 1] in tuple("@_-"):
        return
    low = _words_back(t, e, 3)
    m = re.search(rf"(?<![\w.@-])(?P<n>(?P<w>{_UP}{_LO}{{2,}}|{_UP}\.) (?:{_UP}\. )?(?P<f>{_UP}{_LO}{{2,}}(?:-{_UP}{_LO}+)?))\Z", t[low:e])
    if m and _fit(m.group("w"), m.group("f")):
        yield "name", low + m.start("n"), e


def _family_first(t: str, s: int, e: int) -> Iterator[tuple[str, int, int]]:
    if s and (t[s - 1].isalnum() or t[s - 1] in "-@._") or t[e : e + 1].isalnum():
        return
    m = _FIRST_FAMILY.match(t, e)
    if m and _fit(m.group("f")):
        yield "name", s, m.end()


def _initial(t: str, s: int) -> Iterator[tuple[str, int, int]]:
    if s and (t[s - 1].isalnum() or t[s - 1] in ".-@_"):
        return
    # initials before belong to the same name
    m = _FROM_INITIALS.match(t, s)
    before = _BEFORE_GIVEN.search(t[_words_back(t, s, FAMILY_WORDS) : s])
    if before and _family(before):
        tail = re.compile(_INITIALS).match(t, s)
        end = tail.end() - (1 if tail.group().endswith(" ") else 0)
        yield "name", s - (before.end() - before.start()), end
    elif m and _family(m) and not re.search(rf"{_UP}\. ?\Z", t[max(0, s - 4) : s]):
        yield "name", s, m.end()  # with a given name before, that anchor's longer find wins


def _titled(t: str, s: int, e: int) -> Iterator[tuple[str, int, int]]:
    if s and t[s - 1].isalnum():
        return
    m = _TITLED.match(t, e - 1)
    if m:
        g = "n" if m.group("n") else "m"
        f = "f" if g == "n" else "g"
        if _family(m, f) and m.group(g).split()[0].rstrip(",") not in NOT_FAMILY:
            yield "name", m.start(g), m.end(g)


def find(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each detail, in order, without overlaps."""
    if not text or text.isspace():
        return []
    found: set[tuple[str, int, int]] = set()
    for last, kinds in automaton().iter(text):
        for kind, n in kinds:
            s, e = last - n + 1, last + 1
            if kind == "email":
                found.update(_email(text, s, e))
            elif kind == "digit":
                found.update(_digits(text, s))
                found.update(_account(text, s))
            elif kind == "idnum":
                if not (s and text[s - 1].isalnum()):
                    found.update(_number(text, e))
            elif kind in ("street", "before", "german"):
                found.update(_address(text, s, e))
            elif kind == "given":
                found.update(_name(text, s, e))
            elif kind == "initial":
                found.update(_initial(text, s))
            elif kind == "cue":
                found.update(_cued(text, s, e))
            elif kind == "ending":
                found.update(_ended(text, e))
            elif kind == "first":
                found.update(_family_first(text, s, e))
            else:
                found.update(_titled(text, s, e))
    out: list[tuple[str, int, int]] = []
    taken = bytearray(len(text))
    for kind, s, e in sorted(found, key=lambda x: (KINDS.index(x[0]), -(x[2] - x[1]), x[1])):
        if not any(taken[s:e]):
            taken[s:e] = b"\x01" * (e - s)
            out.append((kind, s, e))
    return sorted(out, key=lambda x: x[1])


def item(text: str) -> str:
    """A detail in small letters with all but letters and digits removed."""
    return "".join(c for c in text.lower() if c.isalnum())


def redact(text: str | None, found: list[tuple[str, int, int]] | None = None) -> str | None:
    """The text with each detail replaced by [KIND]."""
    if not text:
        return text
    out, at = [], 0
    for kind, s, e in find(text) if found is None else found:
        out += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds details (array of kind and item, distinct) and clean (the text with placeholders). One narrow pass."""

    @F.pandas_udf("struct<details array<struct<kind string, item string>>, clean string>")
    def work(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            f = find(t)
            rows.append((list(dict.fromkeys((k, item(t[s:e])) for k, s, e in f)), redact(t, f)))
        return pd.DataFrame({"details": [d for d, _ in rows], "clean": [c for _, c in rows]}, dtype=object)

    return df.withColumn("_w", work(F.col(text))).select("*", "_w.details", "_w.clean").drop("_w")
