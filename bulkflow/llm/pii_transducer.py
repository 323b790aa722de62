"""Personal data in texts, also behind disguises, with spans in the source text.

Base detectors find e-mail addresses, IP addresses, card and phone numbers as written.  Then a
chain of transducers rewrites disguises: zero-width characters go, look-alike characters become
the plain ones, bracketed or spelled "at" and "dot" become signs, and spelled digits become digits.
Each transducer keeps, for every character that it writes, the source characters it stands for.
The detectors run on the rewritten text too, and their spans are mapped back, so every span can be
cut out of the source.  Base spans always stay; the rewritten text only adds spans.

Defined results: a null text is an empty one and has no spans.  Repeated rows get equal results.
Offsets are code points, the end is exclusive.  Texts of any length are read whole; work is linear in
their length, also for long runs of blanks, dots, signs and digit words.  An empty table has no rows.
Columns that are not asked for are left behind before anything else, so their names cannot clash.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import ids_and_texts, ship, text_slices

# Kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGITS = re.compile("[^0-9]")

# Letters of other scripts that look like Latin ones, in pairs.
LOOKALIKES = (
    "аa еe оo рp сc уy хx іi јj ѕs ԁd һh ԛq ԝw АA ВB ЕE КK МM НH ОO РP СC ТT ХX ІI ЈJ ЅS "
    "αa οo νv ρp ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ıi ɡg ⅼl․. 。. ．. ＠@ ﹫@ ＋+ ‐- ‑- ‒- –- −-"
)
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿"
# Digits as spelled in English, German, French and Spanish.
SPELLED = {
    "0": "zero oh null zéro cero", "1": "one eins un uno", "2": "two zwei deux dos", "3": "three drei trois tres",
    "4": "four vier quatre cuatro", "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete",
    "8": "eight acht huit ocho", "9": "nine neun neuf nueve",
}
#: Runs with fewer digits than this stay as they are.
SPELLED_RUN = 4

_DIGIT = {w: d for d, words in SPELLED.items() for w in words.split()}
_DIGIT_WORD = "|".join(sorted(_DIGIT, key=len, reverse=True))
_SPELLED = re.compile(
    rf"(?<!\w)(?:plus[\s-]+)?(?:{_DIGIT_WORD})(?:[\s,-]+(?:(?:dot|point)[\s-]+)?(?:{_DIGIT_WORD}|[0-9])){{{SPELLED_RUN - 1},}}(?!\w)", re.I
)
_SPELLED_PART = re.compile(rf"plus|dot|point|{_DIGIT_WORD}|[0-9]", re.I)
_IN_BRACKETS = re.compile(r"[\[({<]\s*(at|dot|punkt|point|punto|arroba|@|\.)\s*[\])}>]", re.I)
# Separators are looked for behind a character that is no blank, so a run of blanks is read once.
_AT = re.compile(r"(?<!\s)(?:\s+at(?=\s)|@)", re.I)
_SPOKEN_DOT = re.compile(r"\s+dot\s+", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_BEFORE_LOCAL = re.compile(r"[\w.%+-]")
_SPOKEN_PART = re.compile(r"(?<!\s)\s+(at|dot)(?:\s+|$)", re.I)


def _plain_forms() -> dict[str, str]:
    """Look-alikes, and every character whose compatibility form is one ASCII letter, digit or sign."""
    forms = {p[0]: p[1] for p in LOOKALIKES.split() if len(p) == 2}
    for code in (*range(0x0660, 0x0D70), *range(0x2460, 0x2474), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)):
        c = chr(code)
        plain = unicodedata.normalize("NFKC", c)
        digit = unicodedata.digit(c, None)
        if len(plain) == 1 and plain.isascii() and plain.isprintable():
            forms.setdefault(c, plain)
        elif digit is not None:
            forms.setdefault(c, str(digit))
    return forms


_PLAIN = _plain_forms()
_ODD_SET = frozenset(_PLAIN) | frozenset(INVISIBLE)
_ODD_LATIN = [c for c in _ODD_SET if ord(c) < 256]
_ODD = re.compile("[" + "".join(map(re.escape, (*_PLAIN, *INVISIBLE))) + "]")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int

    def order(self) -> tuple[int, int, int]:
        return self.start, KINDS.index(self.kind), self.end


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        found = _DOMAIN.match(text, at)
        start = at
        while found and start > free and _is_local(text[start - 1]):
            start -= 1
        if found and start < at:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


_PART_SET = _LOCAL_SET - {"."}


def _is_local(c: str) -> bool:
    return c in _LOCAL_SET


def _ip_fits(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def _luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _card_fits(found: str) -> bool:
    digits = _NOT_DIGITS.sub("", found)
    return 14 <= len(digits) <= 19 and _luhn(digits)


def _phone_fits(found: str) -> bool:
    return 10 <= len(_NOT_DIGITS.sub("", found)) <= 15


def base_spans(text: str) -> list[Span]:
    """What is personal as written: leftmost matches of each kind that do not overlap, checked."""
    out = [Span("email", *s) for s in emails(text)] if "@" in text else []
    for kind, pattern, fits in (("ip", _IP, _ip_fits), ("card", _CARD, _card_fits), ("phone", _PHONE, _phone_fits)):
        out += [Span(kind, *m.span()) for m in pattern.finditer(text) if fits(m.group())]
    return sorted(out, key=Span.order)


class Rewritten:
    """A rewritten text and, for stretches of it, where they come from in the source.

    ``marks`` holds (start, source start, source end, exact): an exact stretch maps character by
    character, any other stands as a whole for its source stretch.
    """

    def __init__(self, text: str) -> None:
        self.text = text
        self.marks = [(0, 0, len(text), True)]
        self._starts = [0]

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self._of(start)[0], self._of(end - 1)[1]

    def _of(self, at: int) -> tuple[int, int]:
        begin, a, b, exact = self.marks[bisect_right(self._starts, at) - 1]
        return (a + at - begin, a + at - begin + 1) if exact else (a, b)

    def apply(self, edits: Iterator[tuple[int, int, str]]) -> None:
        """Replace stretches (in order, not overlapping) and carry the sources along."""
        parts, marks, at, size = [], [], 0, 0

        def keep(start: int, end: int) -> None:
            nonlocal size
            n = bisect_right(self._starts, start) - 1
            while start < end:
                begin, a, b, exact = self.marks[n]
                stop = min(end, self._starts[n + 1] if n + 1 < len(self._starts) else len(self.text))
                marks.append((size, a + start - begin, a + stop - begin, True) if exact else (size, a, b, False))
                parts.append(self.text[start:stop])
                size += stop - start
                start, n = stop, n + 1

        for start, end, new in edits:
            keep(at, start)
            if new:
                a, b = self.source(start, end)
                marks.append((size, a, b, False))
                parts.append(new)
                size += len(new)
            at = end
        keep(at, len(self.text))
        self.text, self.marks = "".join(parts), marks or [(0, 0, 0, True)]
        self._starts = [m[0] for m in self.marks]


def _plain_characters(text: str) -> Iterator[tuple[int, int, str]]:
    return ((m.start(), m.end(), _PLAIN.get(m.group(), "")) for m in _ODD.finditer(text))


def _signs_in_brackets(text: str) -> Iterator[tuple[int, int, str]]:
    """A sign in brackets goes with the blanks around it."""
    free = 0
    for m in _IN_BRACKETS.finditer(text):
        start, end = m.span()
        while start > free and text[start - 1].isspace():
            start -= 1
        while end < len(text) and text[end].isspace():
            end += 1
        free = end
        yield start, end, "@" if m.group(1).lower() in ("at", "arroba", "@") else "."


def _addresses(text: str, spoken: bool) -> Iterator[tuple[int, int, int]]:
    """(start, domain start, end) of addresses with spelled signs, from left to right.

    With ``spoken`` the domain's last dot is spelled; without, the "at" is spelled and the last dot is
    written.  Every address is found from its "at" outwards, so no stretch is read again and again.
    """
    free = 0
    for m in _AT.finditer(text):
        sign = text[m.start()] == "@"
        if m.start() < free or (sign and not spoken):
            continue
        domain = m.end()
        while not sign and text[domain].isspace():
            domain += 1
            if domain == len(text):
                return
        end = _domain_end(text, domain, spoken)
        if end and (start := _local_start(text, m.start(), free)) < m.start():
            yield start, domain, end
            free = end


def _domain_end(text: str, start: int, spoken: bool) -> int:
    """The end of the domain that begins here, behind its last spelled (or else written) dot; 0 if it has none."""
    at, end = start, 0
    dot = False
    while label := _LABEL.match(text, at):
        if dot:
            end = label.end()
        if text.startswith(".", label.end()):
            at, dot = label.end() + 1, not spoken
        elif between := _SPOKEN_DOT.match(text, label.end()):
            at, dot = between.end(), spoken
        else:
            break
    return end


def _local_start(text: str, end: int, free: int) -> int:
    """The start of the parts that end here, from the leftmost one with nothing joined to it; ``end`` without any."""
    found = at = end
    while True:
        start = at
        while start > free and text[start - 1] in _PART_SET:
            start -= 1
        if start == at:
            return found
        if start == 0 or not _BEFORE_LOCAL.match(text[start - 1]):
            found = start
        if start > free and text[start - 1] == ".":
            at = start - 1
            continue
        dot = start
        while dot > free and text[dot - 1].isspace():
            dot -= 1
        if dot == start or dot - 3 <= free or text[dot - 3 : dot].lower() != "dot" or not text[dot - 4].isspace():
            return found
        at = dot - 3
        while at > free and text[at - 1].isspace():
            at -= 1


def _signs(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    for part in _SPOKEN_PART.finditer(text, start, end):
        yield part.start(), part.end(), "@" if part.group(1).lower() == "at" else "."


def _spoken_signs(text: str) -> Iterator[tuple[int, int, str]]:
    for start, _, end in _addresses(text, spoken=True):
        yield from _signs(text, start, end)


def _spelled_digits(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _SPELLED.finditer(text):
        end = m.start()
        for part in _SPELLED_PART.finditer(text, m.start(), m.end()):
            word = part.group().lower()
            yield end, part.end(), "+" if word == "plus" else "." if word in ("dot", "point") else _DIGIT.get(word, word)
            end = part.end()


def _has_odd_characters(text: str) -> bool:
    """Most texts are settled by their encoding, without a look at single characters."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not _ODD_SET.isdisjoint(text)
    return any(c in text for c in _ODD_LATIN)


def _at_before_dots(source: str, now: Rewritten) -> Iterator[tuple[int, int, str]]:
    """A spoken "at" whose domain has a dot that stood in brackets in the source."""
    for start, domain, end in _addresses(now.text, spoken=False):
        dots = (n for n in range(domain, end) if now.text[n] == ".")
        if any(_IN_BRACKETS.search(source, *now.source(n, n + 1)) for n in dots):
            yield from _signs(now.text, start, end)


#: The chain, each with a cheap test of whether it has anything to do.
TRANSDUCERS = (
    (_has_odd_characters, _plain_characters),
    (_IN_BRACKETS.search, _signs_in_brackets),
    (lambda t: "dot" in t.lower(), _spoken_signs),
    (_SPELLED.search, _spelled_digits),
)


def rewrite(text: str) -> Rewritten | None:
    """The text without disguises, or None where it has none."""
    out = None
    for has_work, transducer in TRANSDUCERS:
        now = out.text if out else text
        if has_work(now):
            out = out or Rewritten(text)
            out.apply(transducer(now))
    if out and " at " in out.text.lower().replace("\n", " ").replace("\t", " "):
        out.apply(_at_before_dots(text, out))
    return out


def find(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, further spans), both by start, then kind."""
    base = base_spans(text)
    plain = rewrite(text)
    if plain is None:
        return base, []
    known = set(base)
    added = {Span(s.kind, *plain.source(s.start, s.end)) for s in base_spans(plain.text)} - known
    return base, sorted(added, key=Span.order)


def redact(text: str, mask: str = "[{}]") -> str:
    """The text with every span replaced by its kind; spans that overlap become one."""
    spans = sorted((s for part in find(text) for s in part), key=Span.order)
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], mask.format(s.kind.upper())]
        at = max(at, s.end)
    return "".join(out) + text[at:] if spans else text


_SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find_column(text: Column) -> Column:
    """All spans of a text by start, then kind; ``base`` tells those found as written."""

    @F.arrow_udf(_SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for batch in batches:
            rows = []
            for part in text_slices(batch):
                for t in part:
                    base, added = find(t)
                    both = [(s, True) for s in base] + [(s, False) for s in added]
                    both.sort(key=lambda x: x[0].order())
                    rows.append([{"kind": s.kind, "start": s.start, "end": s.end, "base": b} for s, b in both])
            yield pa.array(rows, kind)

    return spans(F.coalesce(text, F.lit("")))


def redact_column(text: Column) -> Column:
    """The text with personal data masked; a null text stays null."""

    @F.arrow_udf("string")
    def redacted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([redact(t) for part in text_slices(batch) for t in part], pa.string())

    return F.when(text.isNotNull(), redacted(F.coalesce(text, F.lit(""))))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for every row."""
    ship(docs.sparkSession)
    texts = ids_and_texts(docs, id_col, text_col)
    return texts.select("doc_id", find_column(F.col("text")).alias("spans"))
