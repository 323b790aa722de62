import random

import numpy as np
from llm_helpers import by_row, prose

from bulkflow.llm import toxicity_pu as tox
from bulkflow.llm.contract import QUERIES


def test_learns_from_positives_and_unlabelled_texts(spark):
    r = random.Random(5)
    rows, marks = [], []
    for n in range(1500):
        bad = r.random() < 0.12
        text = prose(r, 60).split(" ")
        for w in r.sample(["vile", "nasty", "rotten"], 2) if bad else []:
            text.insert(r.randrange(60), w.upper() + "!")
        rows.append((n, " ".join(text)))
        marks.append((n, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = tox.fit(docs, labels)
    scores = {n: model.score(t) for n, t in rows}
    right = [(scores[n] >= 0.5) == bool(m) for n, m in marks]
    assert np.mean(right) > 0.99


def test_risk_does_not_turn_negative():
    """With few unlabelled rows and a large prior the plain estimate would fall without end."""
    r = np.random.default_rng(0)
    p, u = (np.hstack([r.normal(size=(20, 30)), np.ones((20, 1))]) for _ in range(2))
    w = tox.non_negative_pu(p, u, 0.9, 0)
    assert np.isfinite(w).all() and np.abs(w).max() < 100


def test_odd_rows(odd_docs, no_docs, labels, no_labels):
    model = tox.fit(odd_docs, labels)
    found = odd_docs.select("doc_id", tox.score_column(model, odd_docs["text"]).alias("s")).collect()
    assert len(found) == odd_docs.count() and all(0 <= x["s"] <= 1 for x in found)
    same = {x["s"] for x in found if x["doc_id"] in (1, 2, 3)}
    assert len(same) == 1
    for docs, marks in ((odd_docs, no_labels), (no_docs, labels), (no_docs, no_labels)):
        assert tox.fit(docs, marks).score("anything") == 0 or docs is odd_docs
    assert odd_docs.select(tox.score_column(tox.fit(odd_docs, no_labels), odd_docs["text"]).alias("s")).distinct().collect()[0]["s"] < 1e-9


def test_query(spark):
    found = QUERIES["op2_toxicity_pu"](spark, "/root/testdata/sf0.01")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.join(marks, "doc_id").where("held_out").collect()
    assert np.mean([x["predicted"] == x["toxic"] for x in rows]) > 0.9
    assert by_row(found, "doc_id") == [(n,) for n in sorted(range(found.count()), key=lambda n: repr((n,)))]
