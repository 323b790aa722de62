import random
import re
import time

import pytest
from llm_helpers import by_row

from bulkflow.llm import pii_transducer as pii

BITS = ["a", "@", "@", "b-", "x.", "..", ".", "1", "23", "4", "256", " ", "-", "+", "+4", "(", ")", "4111111111111111", "é", "+1 (415) 555-1234", "\n"]


def luhn(digits):
    total = 0
    for n, d in enumerate(reversed(digits)):
        x = int(d) * (1 + n % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    out += [("ip", *m.span()) for m in ips if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    out += [("phone", *m.span()) for m in phones if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))


def test_base_spans_by_brute_force():
    r = random.Random(2)
    for _ in range(10_000):
        text = "".join(r.choice(BITS) for _ in range(r.randint(0, 25)))
        assert [(s.kind, s.start, s.end) for s in pii.base_spans(text)] == brute(text)


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("mail john dot smith at example dot com now", "email", "john dot smith at example dot com"),
        ("😀 to: john [at] example [dot] com", "email", "john [at] example [dot] com"),
        ("jоhn＠exаmple．com", "email", "jоhn＠exаmple．com"),
        ("x j​ohn@exa​mple.com y", "email", "j​ohn@exa​mple.com"),
        ("call plus one four one five five five five one two three four ok", "phone", "plus one four one five five five five one two three four"),
        ("at one nine two dot one six eight dot one dot one.", "ip", "one nine two dot one six eight dot one dot one"),
        ("call plus four nine 1 5 1 2 3 4 5 6 7 8 now", "phone", "plus four nine 1 5 1 2 3 4 5 6 7 8"),
        ("(plus one four one five five five five one two three four)", "phone", "plus one four one five five five five one two three four"),
        ("mail john at example [dot] com now", "email", "john at example [dot] com"),
        ("card ４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, found):
    base, added = pii.find(text)
    assert [(s.kind, text[s.start : s.end]) for s in added if s.kind == kind] == [(kind, found)]
    assert f"[{kind.upper()}]" in pii.redact(text) and found not in pii.redact(text)


@pytest.mark.parametrize("text", ["we met at home dot", "one or two of them", "look at example", "we look at example.com [at] home", "", "naïve café", "(a) at (b)"])
def test_clean_texts_stay(text):
    assert pii.find(text) == ([], []) and pii.redact(text) == text


def test_odd_rows(odd_docs, no_docs):
    found = pii.find_personal_data(odd_docs)
    expected = sorted(((x["doc_id"], brute(x["text"] or "")) for x in odd_docs.collect()), key=repr)
    got = sorted(((x["doc_id"], [(s["kind"], s["start"], s["end"]) for s in x["spans"] if s["base"]]) for x in found.collect()), key=repr)
    assert got == expected
    assert pii.find_personal_data(no_docs).collect() == []
    masked = odd_docs.select("doc_id", pii.redact_column(odd_docs["text"]).alias("t"))
    assert (1, None) in by_row(masked, "doc_id", "t") and (10, "12 [IP] [EMAIL] [PHONE]") in by_row(masked, "doc_id", "t")


def test_very_long_odd_texts_take_linear_time():
    for text in ("1" * 200_000, "a." * 100_000 + "@", "@" * 100_000, "+1(" * 50_000, "one " * 50_000, "[" * 100_000, " " * 100_000):
        pii.find(text)


# The patterns as one expression each; they read the same, but start again inside what they have rejected.
SPOKEN = re.compile(
    r"(?<![\w.%+-])[A-Za-z0-9_%+-]+(?:(?:\s+dot\s+|\.)[A-Za-z0-9_%+-]+)*(?:\s+at\s+|@)[A-Za-z0-9-]+(?:(?:\s+dot\s+|\.)[A-Za-z0-9-]+)*\s+dot\s+[A-Za-z0-9-]+(?:\s+dot\s+[A-Za-z0-9-]+)*",
    re.I,
)
WRITTEN = re.compile(
    r"(?<![\w.%+-])[A-Za-z0-9_%+-]+(?:(?:\s+dot\s+|\.)[A-Za-z0-9_%+-]+)*\s+at\s+([A-Za-z0-9-]+(?:(?:\s+dot\s+|\.)[A-Za-z0-9-]+)*\.[A-Za-z0-9-]+)", re.I
)
BRACKETED = re.compile(r"\s*[\[({<]\s*(at|dot|punkt|point|punto|arroba|@|\.)\s*[\])}>]\s*", re.I)


def test_addresses_against_one_pattern():
    r = random.Random(11)
    bits = ["john", "a.b", "at", "AT", "dot", "Dot", " ", "  ", "\n", " at ", " dot ", "@", ".", "com", "é", "[at]", "(dot)", "[ . ]", " { at } ", "-", "%", "4"]
    for _ in range(20_000):
        text = "".join(r.choice(bits) for _ in range(r.randint(1, 16)))
        assert [(a, b) for a, _, b in pii._addresses(text, True)] == [m.span() for m in SPOKEN.finditer(text)], text
        assert [x for x in pii._addresses(text, False)] == [(m.start(), m.start(1), m.end()) for m in WRITTEN.finditer(text)], text
        assert [x[:2] for x in pii._signs_in_brackets(text)] == [m.span() for m in BRACKETED.finditer(text)], text


@pytest.mark.parametrize("shape", ["a dot ", "x [at] y" + " " * 400, "[  ", "x at ", "at dot ", "dot dot at ", " ", "one ", "+1(((", "x at y.y dot ", "a.a@"])
def test_long_texts_take_linear_time(shape):
    """Doubling a text about doubles the work; before, 24 kB of some shapes took seconds."""

    def seconds(size):
        text, best = (shape * (size // len(shape) + 1))[:size], 1e9
        for _ in range(2):
            start = time.perf_counter()
            pii.find(text)
            best = min(best, time.perf_counter() - start)
        return best

    assert seconds(200_000) < 5 * seconds(50_000) + 1.0
