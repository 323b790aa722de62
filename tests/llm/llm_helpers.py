import random

# Clashing names: what operators use inside or return must not disturb extra columns.
EXTRA = "score string, ids string, decoded string, key string, mark int, range string, copy int, f0 string, runs string, node long, hash string"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
SYLLABLES = "ta ko mi ru se no ha vi lo pe dra stu ning".split()


def word(r):
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))


def prose(r, n):
    return " ".join(word(r) + (r.choice([".", ",", "\n", "!"]) if r.random() < 0.1 else "") for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank texts, repeated rows, equal texts, one very long text."""
    r = random.Random(3)
    long_text = prose(r, 30_000)
    shared = prose(r, 60)
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (None, "no id here at all", None, "a", 17),
        (None, None, None, None, None), (4, "one", "en", "b", 3), (5, shared, "en", "b", 1), (5, shared, "en", "b", 1), (6, shared, "de", "b", 1),
        (7, long_text, "en", "c", 9), (8, long_text + " end", "en", "c", 9), (9, "a b " * 200, "fr", "c", 9),
        (10, "12 34.5.6.7 x@y.zz +1 (415) 555-1234", "en", None, 9), (11, "日本語 ünï 😀 \x00 ▁▁  ﬁ", "en", "d", 1),
    ]
    rows += [(100 + n, prose(r, r.randint(5, 200)), r.choice(["en", "de"]), r.choice("abc"), 1) for n in range(40)]
    return rows


def with_extra(rows):
    return [(*x, "s", "i", "d", "k", 1, "r", 9, "f", "u", 7, "h") for x in rows]


def by_row(df, *columns):
    """Rows as a sorted list, nulls included."""
    return sorted((tuple(x[c] for c in columns) for x in df.collect()), key=repr)
