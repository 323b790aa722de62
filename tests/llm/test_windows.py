import collections
import random
import re

import numpy as np
import pytest
from llm_helpers import by_row, prose

from bulkflow.llm import window_dedup as wd


def brute(rows, size):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    seen = collections.Counter(tuple(w[n : n + size]) for _, w in words for n in range(len(w) - size + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for n in range(len(w) - size + 1):
            if seen[tuple(w[n : n + size])] > 1:
                gone[n : n + size] = [True] * size
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def planted():
    """Passages in the middle of texts, at their ends, overlapping, within one text, and just too short."""
    r = random.Random(4)
    passages = [prose(r, n) for n in (34, 35, 36, 50, 120)]
    rows = [(n, prose(r, r.randint(0, 120))) for n in range(60)]
    for n in range(60, 160):
        rows.append((n, " ".join(r.choice([prose(r, r.randint(0, 40)), r.choice(passages)]) for _ in range(r.randint(1, 4)))))
    rows += [(160, "same " * 100), (161, "a b c " * 40), (162, (prose(r, 40) + " ") * 3)]
    rows += [(200 + n, passages[4] + " " + word) for n, word in enumerate(["x", "y"] * 50)]
    return rows


@pytest.mark.parametrize("size", [35, 8])
def test_by_brute_force(spark, size):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert by_row(wd.remove_repeats(docs, size), "doc_id", "n_words", "n_removed", "kept") == brute(rows, size)


def test_many_blocks_and_buckets(spark, monkeypatch):
    """Sketch blocks with hardly an anchor and buckets with hardly a text: as many as at a thousand times the data."""
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(wd, "CELLS_PER_ANCHOR", 1 << 14)
    monkeypatch.setattr(wd, "BUCKET_CHARS", 700)
    assert by_row(wd.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == brute(rows, 35)


def anchors_by_hand(rows, size=35):
    """(mark, place) to anchor, and those of windows that repeat."""
    all_, seen = {}, collections.defaultdict(set)
    for mark, (_, t) in enumerate(rows):
        raw = np.frombuffer(t.encode(), np.uint8)
        w = wd.Windows(raw, np.array([0, len(raw)]), size)
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        for anchor, place, start in zip(w.anchor.tolist(), w.place.tolist(), w.start.tolist()):
            all_[mark, place] = anchor
            seen[tuple(words[start : start + size])].add((mark, place, start))
    return all_, {x[:2] for where in seen.values() if len(where) > 1 for x in where}


@pytest.mark.parametrize("blocks", [1, 50])
def test_the_sketch_never_underestimates(spark, blocks):
    rows = planted()
    texts = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "mark int, text string").repartition(5)
    found = set()
    for x in wd.estimated_repeated(texts, 35, blocks, 3).collect():
        marks, places = np.frombuffer(x["marks"], np.int32).tolist(), np.frombuffer(x["places"], np.int32).tolist()
        assert all(m % 3 == x["bucket"] for m in marks)
        found |= set(zip(marks, places))
    all_, needed = anchors_by_hand(rows)
    assert needed <= found <= set(all_)
    counts = collections.Counter(all_.values())
    once = {x for x, anchor in all_.items() if counts[anchor] == 1}
    assert len(found & once) < 0.1 * len(once)


def test_words_are_told_apart(spark):
    """Words that a polynomial hash confuses, in windows that are otherwise equal; words of any length."""
    one = "a"
    while len(one) < 1024:
        one += one.translate(str.maketrans("ab", "ba"))
    two = one.translate(str.maketrans("ab", "ba"))
    r = random.Random(3)
    words = [one, two, "x" * 64, "x" * 65, "x" * 66, "x" * 2000, "x" * 1999 + "y", "é" * 40, "\x00", "\x00\x00", "12345678", "123456789"]
    h1, h2, _ = wd.word_hashes(np.frombuffer(" ".join(words).encode(), np.uint8), np.array([0, len(" ".join(words).encode())]))
    assert len(set(h1.tolist())) == len(set(h2.tolist())) == len(words)
    rows = []
    for n, w in enumerate(words):
        passage = prose(r, 34) if n % 2 == 0 else passage
        rows.append((n, f"{passage} {w}"))
    rows += [(100, rows[0][1]), (101, "z " + rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert by_row(wd.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == brute(rows, 35)


def test_pieces_of_a_long_text(monkeypatch):
    monkeypatch.setattr(wd, "SLICE_CHARS", 300)
    text = prose(random.Random(2), 700) + " " + "long" * 200 + "  " + prose(random.Random(3), 50) + " \n "
    raw = np.frombuffer(text.encode(), np.uint8)
    whole = wd.Windows(raw, np.array([0, len(raw)]), 35)
    found, parts = {}, 0
    for piece, first in wd._pieces(raw, 35):
        w = wd.Windows(piece, np.array([0, len(piece)]), 35, np.array([first]))
        every = np.ones(len(w.at), bool)
        for start, place, anchor, a, b in zip(w.start.tolist(), w.place.tolist(), w.anchor.tolist(), *(h.tolist() for h in w.hashes(every))):
            assert start not in found
            found[start] = (place, anchor, a, b)
        parts += 1
    every = np.ones(len(whole.at), bool)
    expected = zip(whole.place.tolist(), whole.anchor.tolist(), *(h.tolist() for h in whole.hashes(every)))
    assert parts > 10 and found == dict(zip(whole.start.tolist(), expected))


def test_texts_longer_than_a_slice(spark):
    r = random.Random(7)
    shared = prose(r, 60)
    long_texts = [" ".join(prose(r, 150_000) + " " + shared for _ in range(3)) for _ in range(2)]
    assert min(map(len, long_texts)) > 1.2 * wd.SLICE_CHARS
    rows = [(1, long_texts[0]), (2, long_texts[1]), (3, "x " + shared + " y")]
    found = by_row(wd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")), "doc_id", "n_words", "n_removed")
    assert found == [(1, 450_180, 180), (2, 450_180, 180), (3, 62, 60)]


def test_runs_end_with_their_document(spark):
    """In one part: a document whose last repeated window starts at 3, then one whose first kept window starts at 4.

    The windows before it are only left out by the sketch when their anchor is the document's own, hence many pairs.
    """
    r = random.Random(5)
    rows = []
    for n in range(0, 1200, 4):
        one, two = prose(r, 38), prose(r, 38)
        rows += [(n, one + " " + prose(r, 9)), (n + 1, prose(r, 9) + " " + two), (n + 2, one), (n + 3, prose(r, 4) + " " + two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert by_row(wd.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == brute(rows, 35)


@pytest.mark.parametrize("size", [1, 2, 3])
def test_repeats_across_batches(spark, size):
    """Passages seen twice in one task and once in another, with batches that end inside a hash's rows."""
    r = random.Random(6)
    passages = [prose(r, 38) for _ in range(12)]
    rows = [(n, prose(r, 5) + " " + p + " " + prose(r, 5)) for n, p in enumerate(passages[6:] + passages * 2 + passages[:6])]
    tasks = spark.sparkContext.parallelize([rows[:6], rows[6:30], rows[30:]], 3).flatMap(list)
    docs = spark.createDataFrame(tasks, "doc_id long, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        assert by_row(wd.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == brute(rows, 35)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_odd_rows(odd_docs, no_docs):
    rows = [(x["doc_id"], x["text"]) for x in odd_docs.collect()]
    odd_docs = odd_docs.selectExpr("*", "1 as bucket", "2 as h1", "3 as start")
    assert by_row(wd.remove_repeats(odd_docs), "doc_id", "n_words", "n_removed", "kept") == brute(rows, 35)
    assert wd.remove_repeats(no_docs).collect() == []
