import collections
import re

import numpy as np
from llm_helpers import by_row

from bulkflow.llm import quality_llr as ql
from bulkflow.llm import quality_rff as qr
from bulkflow.llm.contract import QUERIES

SF = "/root/testdata/sf0.01"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def counts_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = collections.Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for n in range(len(words) - 2):
        if triples[tuple(words[n : n + 3])] > 1:
            inside |= {n, n + 1, n + 2}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed


def test_base_counts_by_brute_force(spark, odd_docs, no_docs):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(-1, "a b a b a b a"), (-2, "x\n\nx\r\nx\n y\n"), (-3, "#*$%&|<> é"), (-4, "a b c a b")], "doc_id long, text string")
    for docs in (documents, odd_docs, extra):
        expected = sorted(((x["doc_id"], *counts_by_hand(x["text"])) for x in docs.select("doc_id", "text").collect()), key=repr)
        assert by_row(ql.base_counts(docs), "doc_id", *COUNTS) == expected
    assert ql.base_counts(no_docs).collect() == []


def test_ratios_by_hand(spark, monkeypatch):
    """The mean ratio of every text, from counters over all texts and over the trusted ones."""
    rows = [(n, t) for n, t in enumerate(["good words here", "good words there, yes", "bad ### words", "### ###", "", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    grams = {x["doc_id"]: x["g"] for x in docs.select("doc_id", ql.ngrams(docs["text"]).alias("g")).collect()}
    assert [len(grams[n] or []) for n in range(5)] == [5, 9, 5, 3, 0]
    corpus = collections.Counter(b for g in grams.values() for b in g or [])
    target = collections.Counter(b for n in (0, 1) for b in grams[n])
    ratios = ql.learn_ratios(docs, labels)
    for b in corpus:
        p = (target[b] + 1) / (sum(target.values()) + ql.BUCKETS)
        q = (corpus[b] + 1) / (sum(corpus.values()) + ql.BUCKETS)
        assert abs(ratios[b] - np.log(p / q)) < 1e-9
    got = {x["doc_id"]: x["ratio"] for x in ql.judge(docs, ratios).collect()}
    for n in range(4):
        assert abs(got[n] - np.mean([ratios[b] for b in grams[n]])) < 1e-9
    assert got[4] == got[5] == 0


def test_llr_odd_rows(odd_docs, no_docs, labels, no_labels):
    assert ql.judge(odd_docs, ql.learn_ratios(odd_docs, labels)).count() == odd_docs.count()
    assert set(ql.learn_ratios(odd_docs, no_labels)) == {0.0} == set(ql.learn_ratios(no_docs, labels))
    assert ql.judge(no_docs, [0.0] * ql.BUCKETS).collect() == []


def test_llr_keeps_clean_documents_and_drops_junk(spark):
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op8_quality_llr"](spark, SF).join(marks, "doc_id").collect()
    assert all(x["kept"] for x in rows if x["quality"] and not x["base_failed"])
    assert np.mean([x["kept"] for x in rows if not x["quality"]]) < 0.1


def test_isotonic_by_hand():
    values, weights = np.array([0.1, 0.5, 0.3, 0.2, 0.9, 0.8]), np.array([1, 1, 1, 2, 1, 3.0])
    out = qr.isotonic(values, weights)
    assert np.all(np.diff(out) >= 0) and abs((out * weights).sum() - (values * weights).sum()) < 1e-9
    assert np.allclose(out[1:4], 0.3) and np.allclose(out[4:], 0.825)


def test_random_features_approximate_the_kernel():
    x = np.random.default_rng(0).normal(size=(20, len(qr.NAMES)))
    z = qr.random_features(x)[:, :-1]
    true = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (4 * x.shape[1]))
    assert np.abs(z @ z.T - true).max() < 0.3


def test_rff_held_out_accuracy(spark):
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op10_quality_rff"](spark, SF).join(marks, "doc_id").where("held_out").collect()
    assert np.mean([x["predicted"] == x["quality"] for x in rows]) > 0.95 and all(0 <= x["score"] <= 1 for x in rows)


def test_rff_sums_equal_those_of_one_partition(spark, odd_docs, labels):
    measured = qr.measure(odd_docs)
    one, many = (qr.fit(measured.repartition(n), labels) for n in (1, 6))
    assert np.allclose(one.weights, many.weights, atol=1e-6) and np.allclose(one.steps, many.steps)


def test_rff_odd_rows(odd_docs, no_docs, labels, no_labels):
    for docs in (odd_docs, no_docs):
        for marks in (labels, no_labels):
            measured = qr.measure(docs)
            model = qr.fit(measured, marks)
            assert (model is None) == (docs is no_docs or marks is no_labels)
            scores = [x["s"] for x in measured.select(qr.score_column(model, measured["stats"]).alias("s")).collect()]
            assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
            assert model is not None or set(scores) <= {0.5}
