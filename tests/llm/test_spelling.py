import collections
import random
import re
import zlib

import pytest
from llm_helpers import DOCUMENTS, with_extra

from bulkflow.llm import spelling_variants as sv
from bulkflow.llm.contract import QUERIES


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def pairs_by_hand(words):
    words = sorted(set(words))
    return {(a, b) for n, a in enumerate(words) for b in words[n + 1 :] if near(a, b)}


def random_words(r, letters, low, high, n):
    return {"".join(r.choice(letters) for _ in range(r.randint(low, high))) for _ in range(n)}


def test_composition_against_all_pairs():
    r = random.Random(4)
    for n in range(200):
        words = random_words(r, "ab" if n % 2 else "abcé", 0 if n % 3 else 4, 7, r.randint(0, 60))
        found = [tuple(sorted(x)) for x in sv.near_pairs(list(words))]
        assert len(found) == len(set(found)) and set(found) == pairs_by_hand(words)


def test_the_automaton_is_minimal():
    words = sorted(a + b + "ing" for a in ("walk", "talk", "stalk") for b in ("", "er"))
    automaton = sv.Automaton(words)
    languages = collections.defaultdict(set)
    for q in range(len(automaton.arcs)):
        todo, accepted = [(q, "")], set()
        while todo:
            p, text = todo.pop()
            accepted |= {text} if automaton.final[p] else set()
            todo += [(t, text + c) for c, t in automaton.arcs[p].items()]
        languages[frozenset(accepted)].add(q)
    assert all(len(q) == 1 for q in languages.values())
    assert sorted(next(k for k, q in languages.items() if automaton.initial in q)) == words


@pytest.mark.parametrize("group_words", [3, 40, 20_000])
def test_pairs_on_spark_with_split_groups(spark, group_words):
    r = random.Random(6)
    words = random_words(r, "abc", 6, 8, 300) | {"hotbegin" + w for w in random_words(r, "xyz", 0, 4, 150)} | {w + "ending" for w in random_words(r, "xyé", 1, 4, 100)}
    words |= {"a" * n for n in (6, 7, 9, 3000, 3001)}
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
    found = [tuple(x) for x in sv.pairs_of(frame, group_words).collect()]
    assert len(found) == len(set(found)) and set(found) == pairs_by_hand(words)


def forms_by_hand(texts):
    """(word, form, root, n, n_near, form_n) of (doc_id, text)."""
    counts = collections.Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 5}
    beside = collections.defaultdict(list)
    for a, b in pairs_by_hand(counts):
        beside[a].append(b)
        beside[b].append(a)
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda o: (-counts[o], o))
        if counts[best] >= 5 * counts[w]:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(beside[w]), counts[form[w]] if w in form else None))
    return sorted(out)


def test_the_query_against_plain_python(spark, tmp_path):
    r = random.Random(8)
    stems = ["receive", "separate", "straße", "definitely", "Ünlike", "naïveté", "aaaaaa"]
    texts = []
    for n in range(400):
        words = []
        for _ in range(r.randint(0, 60)):
            w = r.choice(stems)
            for _ in range(r.choice([0, 0, 0, 0, 0, 0, 1, 1, 2])):
                at = r.randrange(len(w))
                w = w[:at] + r.choice(["", w[at] * 2, "e"]) + w[at + 1 :]
            words.append(w.upper() if r.random() < 0.1 else w)
        texts.append((n if n % 50 else None, " ".join(words) if n % 41 else None))
    texts += [(1, "receive2receive_réceive\nreceive×÷"), (1, "receive2receive_réceive\nreceive×÷"), (5000, "longword" * 9000 + " "), (5001, "")]
    texts.append((6000, " ".join(["chaingamma"] * 130 + ["chaingamme"] * 26 + ["chaingxmme"] * 5)))
    spark.createDataFrame(with_extra([(i, t, None, None, None) for i, t in texts]), DOCUMENTS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(tuple(x) for x in QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect())
    expected = forms_by_hand(texts)
    assert found == expected and len(found) > 100
    assert any(x[1] and x[2] != x[1] for x in found)  # a chain of two


def test_an_empty_table(spark, no_docs):
    words = sv.words_of(no_docs, 6, spoil=199)
    assert sv.forms(sv.vocabulary(words, 5)).count() == 0
    assert sv.words_of(no_docs, 6).count() == 0
