"""Personal data with offset-preserving deobfuscation.

Plain identifiers are found in the text as it is. Disguised ones are found in a normalised copy: a transducer reads the
text once and writes, for each stretch it knows a plainer form of, that form together with the stretch it stands for:
look-alike letters and digits, invisible characters, spelled digits in four languages (mixed with plain ones), and at/dot disguises: a literal,
bracketed or spelled at with dots of any of these forms (spelled ones before listed or two-letter last parts). The same
detectors run over the copy, and each identifier that touches a rewritten stretch is mapped back to source characters.
Such spans have the kinds ``hidden_email`` and so on; one that lies within a plain span is not added.

Defined cases: null and empty texts have no spans; texts without any disguise are not copied; the work grows with the
text's length, also for long runs of digits or blanks; repeated rows give repeated results; only id and text are read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from varsift.llm.arrow_jobs import report, strings
from varsift.llm.secret_ledger import joined_spans, masked

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Look-alikes of Latin letters in Cyrillic and Greek, and what they look like.
_LOOKALIKES = {pair[0]: pair[1] for pair in (
    "аa сc ԁd еe һh іi јj кk ӏl мm оo рp ԛq ѕs тt уy хx АA ВB СC ЕE НH ІI ЈJ КK МM ОO РP ЅS ТT ХX "
    "αa οo ρp νv ιi ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX").split()}
_LOOKALIKES |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)} | {"․": ".", "。": ".", "｡": ".", "﹫": "@"}
_LOOKALIKES |= {c: str(unicodedata.digit(c)) for c in map(chr, range(0x80, 0x20000)) if unicodedata.category(c) == "Nd"}
_INVISIBLE = "­​‌‍⁠﻿"
#: Digits as words (English, German, French, Spanish).
_SPELLED = [
    "zero oh one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve"]
_VALUES = [(0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9), range(10), (0, 1, 2, 3, 4, 5, 7, 8, 9), range(10)]
_DIGIT = {w: str(v) for words, values in zip(_SPELLED, _VALUES, strict=True) for w, v in zip(words.split(), values, strict=True)}
_NUMBER = "|".join(sorted(_DIGIT, key=len, reverse=True))
_RUN = re.compile(rf"(?<![0-9A-Za-z])(?:plus[\x20-]+|\+)?(?:double[\x20-]+)?(?:{_NUMBER}|[0-9]++)(?:[\x20,-]+(?:double[\x20-]+)?(?:{_NUMBER}|point|dot|[0-9]++)){{3,}}\b", re.I)
_PART = re.compile(rf"plus|\+|double|{_NUMBER}|point|dot|[0-9]+", re.I)
_AT = r"(?:\x20*[\(\[{<]\x20*(?:at|@|arroba|ät)\x20*[\)\]}>]\x20*)"
_DOT = r"(?:\x20*[\(\[{<]\x20*(?:dot|\.|punto|point|punkt)\x20*[\)\]}>]\x20*)"
_MARK = re.compile(rf"(?<=[A-Za-z0-9])(?:(?P<at>{_AT})|(?P<dot>{_DOT}))(?=[A-Za-z0-9])", re.I)
_SAID_DOT = r"(?:\x20+(?:dot|punto|point|punkt)\x20+)"
_LABEL = "[A-Za-z0-9-]++"
_AT_FORM = re.compile(rf"{_AT}|\x20+(?:at|arroba)\x20+|\x20?@\x20?", re.I)
_DOT_FORM = re.compile(rf"{_DOT}|{_SAID_DOT}|\.", re.I)
_CLOSE_DOMAIN = re.compile(rf"{_LABEL}(?:(?:\.|{_DOT}){_LABEL})+", re.I)
_ANY_DOMAIN = re.compile(rf"{_LABEL}(?:(?:\.|{_DOT}|{_SAID_DOT}){_LABEL})+", re.I)
_DOT_BEFORE = re.compile(rf"(?:{_DOT}|{_SAID_DOT})$", re.I)
#: Last parts of more than two letters that an address with spelled at and dot may have; of two letters any
#: may, but for words of running text ("the dot on the page" is no address).
_ENDS = frozenset("com org net edu gov mil int info biz name pro mobi museum travel jobs cat tel post asia coop aero app dev "
                  "online site website shop store tech blog cloud email live news space world xyz club digital agency "
                  "academy bank berlin paris london wien koeln hamburg nyc".split())
_WORDS = frozenset("on of or if up we an he oh ok go as by do to so is am my at be no us it in me de es la le un et ou du se "
                   "si el da zu im um so wo ob er the and for was are not you this that with from here there".split()) - frozenset(
                       "us de es it in".split())
#: Words that stand before "at" in running text ("look at example.com").
_BEFORE_AT = frozenset("look looks looking looked meet met me us you them it is are was were be been find found available visit "
                       "online website site page pages shop here there live works work working based hosted read see more "
                       "buy sold order arrive arrived stay stop start started stood sat aim aimed point pointed".split())
_ARTICLES = frozenset("the a an this that our your their his her its".split())


def _end_fits(end: str, spelled: bool) -> bool:
    """Whether the last part may end an address whose at or dots are disguised."""
    if not end.isalpha() or len(end) < 2 or end in _WORDS:
        return False
    return not spelled or len(end) == 2 or end in _ENDS


def addresses(text: str) -> list[tuple[int, int, str]]:
    """The disguised at and dots of addresses: every form of the one goes with every form of the other."""
    out = []
    for m in _AT_FORM.finditer(text):
        start = at = m.start()
        while start and text[start - 1] in _LOCAL:
            start -= 1
        if start == at:
            continue
        form = m[0].strip()
        said_at = form.isalpha()
        domain = _CLOSE_DOMAIN.match(text, m.end())
        ends = domain and re.split(r"[^A-Za-z0-9-]+", domain[0].rstrip(")]}> "))[-1].lower()
        if not domain or not _end_fits(ends, True):
            domain = _ANY_DOMAIN.match(text, m.end()) or domain
        if not domain:
            continue
        dots = list(_DOT_FORM.finditer(text, domain.start(), domain.end()))
        said_dot = any(d[0].strip().isalpha() for d in dots)
        literal = all(d[0] == "." for d in dots)
        end = text[dots[-1].end() : domain.end()].lower()
        if not _end_fits(end, said_at and (said_dot or literal)):
            continue
        if said_at and literal and text[start:at].lower() in _BEFORE_AT:
            continue
        if said_at and text[domain.start() : dots[0].start()].lower() in _ARTICLES:
            continue
        if m[0] != "@":
            out.append((at, m.end(), "@"))
        out += [(d.start(), d.end(), ".") for d in dots if d[0] != "."]
        while dot := _DOT_BEFORE.search(text, max(0, start - 24), start):  # spelled dots of the local part
            before = dot.start()
            while before and text[before - 1] in _LOCAL:
                before -= 1
            if before == dot.start():
                break
            out.append((dot.start(), dot.end(), "."))
            start = before
    return out


_ODD_SET = frozenset([*_LOOKALIKES, *_INVISIBLE])
_ODD = re.compile("[" + "".join(map(re.escape, sorted(_ODD_SET))) + "]")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def plain(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base identifiers."""
    out, till, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > till and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _EMAIL.match(text, start)):
            out.append((start, 0, m.end()))
            till = m.end()
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return out


def rewritten(text: str, lower: str) -> list[tuple[int, int, str]]:
    """(start, end, plainer form) of the disguised stretches, in order, not overlapping."""
    out: list[tuple[int, int, str]] = []
    if not text.isascii() and not _ODD_SET.isdisjoint(text):
        out += [(m.start(), m.end(), _LOOKALIKES.get(m[0], "")) for m in _ODD.finditer(text)]
    if "(" in text or "[" in text or "{" in text or "<" in text:
        out += [(m.start(), m.end(), "@" if m["at"] else ".") for m in _MARK.finditer(text)]
    if "@" in text or " at " in lower or "arroba" in lower or "(" in text or "[" in text or "{" in text or "<" in text:
        out += addresses(text)
    spoken = any(map(_DIGIT.__contains__, lower.replace(",", " ").replace("-", " ").split()))
    for m in _RUN.finditer(text) if spoken else ():
        if not any(c.isalpha() for c in m[0]):
            continue
        twice = False
        for p in _PART.finditer(m[0]):
            word = p[0].lower()
            if word == "double":
                twice = True
                value = ""
            else:
                value = {"plus": "+", "point": ".", "dot": "."}.get(word) or _DIGIT.get(word, word)
                value, twice = value * (1 + twice), False
            end = m.start() + p.end()
            while end < m.end() and text[end] in " ,-" and word != "+":  # the digits are written without a gap
                end += 1
            out.append((m.start() + p.start(), end, value))
    out.sort()
    kept, till = [], 0
    for a, b, form in out:
        if a >= till:
            kept.append((a, b, form))
            till = b
    return kept


def normalised(text: str, cuts: list[tuple[int, int, str]]) -> tuple[str, list[int], list[int], list[tuple[int, int]]]:
    """The copy; for each of its pieces where it begins in the copy and in the text; and the rewritten pieces' places."""
    parts, here, there, changed, at, size = [], [], [], [], 0, 0
    for a, b, form in cuts:
        for piece, source in ((text[at:a], at), (form, a)):
            here.append(size)
            there.append(source)
            parts.append(piece)
            size += len(piece)
        changed.append((size - len(form), size))
        at = b
    here.append(size)
    there.append(at)
    parts.append(text[at:])
    return "".join(parts), here, there, changed


def hidden(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Identifiers of the normalised copy that the text itself does not show."""
    cuts = rewritten(text, text.lower())
    if not cuts:
        return []
    copy, here, there, changed = normalised(text, cuts)
    begins = [a for a, _ in changed]
    spans = plain(copy)
    out, taken = [], [(a, b) for a, _, b in found]
    for a, kind, b in sorted(spans):
        k = bisect_left(begins, b)
        if not any(x < b and y > a or x == y and a < x < b for x, y in changed[max(0, bisect_left(begins, a) - 1) : k]):
            continue

        def back(place: int, end: bool) -> int:
            i = bisect_right(here, place) - 1
            if i % 2:  # inside a rewritten stretch: its begin or its end
                source = cuts[i // 2]
                return source[1] if end else source[0]
            return there[i] + place - here[i]

        start, last = back(a, False), back(b - 1, True) + (0 if (bisect_right(here, b - 1) - 1) % 2 else 1)
        while last > start and text[last - 1] in " ,-":
            last -= 1
        if not any(x <= start and last <= y for x, y in taken):
            out.append((start, len(KINDS) + kind, last))
    return out


def spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans, by start and kind; kinds from four on are hidden ones."""
    found = plain(text)
    return sorted(found + hidden(text, found))


def _scorer():
    names = [*KINDS, *(f"hidden_{k}" for k in KINDS)]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def score(data: np.ndarray, at: np.ndarray) -> list:
        return [pa.array([[{"kind": names[k], "start": a, "end": b} for a, k, b in spans(t)] for t in strings(data, at)], kind)]

    return score


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``spans`` (kind, start, end in code points of the text)."""
    return report(docs, _scorer, "spans array<struct<kind:string,start:int,end:int>>", id_col, text_col)


def redacted(text: str, mask: str = "[personal]") -> str:
    """The text with every span replaced."""
    return masked(text, [(a, b) for a, _, b in spans(text)], mask)


def contract(docs: DataFrame) -> DataFrame:
    """The columns of op10."""
    return joined_spans(personal_data(docs), KINDS)
