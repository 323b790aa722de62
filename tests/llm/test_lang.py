import numpy as np
import pytest
from llm_helpers import by_row

from bulkflow.llm import lang_hyperdim as lh
from bulkflow.llm.contract import QUERIES

SF = "/root/testdata/sf0.01"


def test_triples_by_hand():
    owner, triple, count = lh.count_triples(["Aba b", "", "1 2"])
    found = {(o, *(chr(t >> s & (1 << 21) - 1) for s in (42, 21, 0))): c for o, t, c in zip(owner.tolist(), triple.tolist(), count.tolist())}
    assert found == {(0, "\0", "a", "b"): 1, (0, "a", "b", "a"): 1, (0, "b", "a", "\0"): 1, (0, "\0", "b", "\0"): 1}


def test_products_are_those_of_the_bundles():
    """Scoring by products per triple equals building the document's vector and multiplying."""
    texts = ["the quick brown fox", "der schnelle braune Fuchs", "le renard brun"]
    vectors = np.random.default_rng(0).normal(size=(2, lh.DIMENSIONS)).astype(np.float32)
    scorer = lh._Scorer(lh.Profiles(("x", "y"), vectors))
    owner, triple, count = lh.count_triples(texts)
    for n in range(len(texts)):
        own = owner == n
        bundle = count[own] @ lh.letters().triples(triple[own])
        assert np.allclose(bundle @ vectors.T, count[own] @ scorer.of(triple[own]), rtol=1e-3)
        assert abs(np.linalg.norm(bundle) / np.sqrt((count[own] ** 2).sum() * lh.DIMENSIONS) - 1) < 0.2


def test_too_many_languages_are_refused(spark, monkeypatch):
    docs = spark.createDataFrame([(n, "some text", f"l{n % 7}") for n in range(60)], "doc_id long, text string, lang string")
    assert len(lh.learn(docs).languages) == 7
    monkeypatch.setattr(lh, "MOST_LANGUAGES", 6)
    with pytest.raises(ValueError, match="more than 6"):
        lh.learn(docs)


def test_held_out_accuracy(spark):
    found = QUERIES["op7_hyperdim_lang"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").where("held_out").collect()
    assert np.mean([x["lang"] == x["lang_pred"] for x in rows]) > 0.97
    assert all(0 <= x["score"] <= 1 for x in rows)


def test_odd_rows(odd_docs, no_docs):
    profiles = lh.learn(odd_docs)
    assert set(profiles.languages) <= {"en", "de", "fr"}
    found = odd_docs.select("doc_id", lh.predict_column(profiles, odd_docs["text"]).alias("p")).collect()
    assert len(found) == odd_docs.count()
    assert {tuple(x["p"]) for x in found if x["doc_id"] in (1, 2, 3)} == {("und", 0.0)}
    assert all(x["p"]["lang"] != "und" for x in found if x["doc_id"] == 11)
    nothing = lh.learn(no_docs)
    assert nothing.languages == ()
    assert by_row(odd_docs.limit(3).select(lh.predict_column(nothing, odd_docs["text"])["lang"].alias("l")), "l") == [("und",)] * 3
