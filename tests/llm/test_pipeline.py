import collections
import random

import pytest
import sentencepiece
from llm_helpers import prose, with_extra

import corpus_pipeline as cp
from bulkflow.llm import poisson_mix, simhash_ring, toxicity_pu
from bulkflow.llm.pii_transducer import redact

STAGES = dict(cp.STAGES)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Planted: toxic texts, exact and near copies, personal data; everything else is clean."""
    r = random.Random(9)
    rows, marks = [], []
    for n in range(400):
        toxic = n % 8 == 0
        words = prose(r, 150).split(" ")
        for w in ["vile", "nasty", "rotten"] if toxic else []:
            words.insert(r.randrange(len(words)), w)
        if n % 9 == 1:
            words.insert(5, "me@example.com")
        rows.append((n, " ".join(words), "en", "ab"[n % 3 == 0], len(" ".join(words))))
        if n % 2 == 0:
            marks.append((n, 1, int(toxic)))
    for n in range(20):
        rows.append((1000 + n, rows[8 * n + 2][1], "en", "a", 1))  # an exact copy
        rows.append((2000 + n, rows[8 * n + 3][1].upper().replace(" ", " \t"), "en", "a", 1))  # the same words
        words = rows[8 * n + 4][1].split(" ")
        words[r.randrange(len(words))] = "changed"
        rows.append((3000 + n, " ".join(words), "en", "a", 1))  # a near copy, linked where the fingerprints say so
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def test_against_a_plain_version(spark, corpus):
    path, rows = corpus
    model = toxicity_pu.fit(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    kept = [x for x in rows if model.score(x[1]) < cp.TOXIC]
    assert {x[0] for x in rows} - {x[0] for x in kept} == {n for n in range(0, 400, 8)}
    prints = [int(simhash_ring.fingerprint(x[1], 4)[0]) for x in kept]
    root = list(range(len(kept)))  # components by hand; ``kept`` is in no order of ids beyond 400
    for n in range(len(kept)):
        for m in range(n):
            if (prints[n] ^ prints[m]).bit_count() <= 4 and root[n] != root[m]:
                root = [root[m] if x == root[n] else x for x in root]
    groups = collections.defaultdict(list)
    for n, x in enumerate(kept):
        groups[root[n]].append(x)
    once = [min(group) for group in groups.values()]
    assert {n for n in range(400) if n % 8} <= {x[0] for x in once} <= {n for n in range(400) if n % 8} | set(range(3000, 3020))
    assert len(once) < 370  # some of the near copies are linked
    masked = [(x[0], redact(x[1]), x[2], x[3]) for x in once]
    sizes = collections.Counter(x[3] for x in masked)
    weight = {s: n**0.5 for s, n in sizes.items()}
    library = sentencepiece.SentencePieceProcessor(model_file=cp.tokenizer_file("piece_bpe_32k.model"))
    expected = collections.Counter()
    from test_mixing import copies_by_hand

    for i, text, lang, source in masked:
        rate = weight[source] / sum(weight.values()) * len(masked) / sizes[source]
        expected[i, source, lang, tuple(library.encode(text))] += copies_by_hand(17, i, rate, text)
    found = collections.Counter((x["doc_id"], x["source"], x["lang"], tuple(x["ids"])) for x in cp.run(spark, path).collect())
    assert found == +expected


def test_stages_on_odd_rows(spark, odd_docs, no_docs, corpus):
    path, _ = corpus
    for docs in (odd_docs, no_docs):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, path)
            assert sorted(out.columns) == sorted(docs.columns), name
            assert out.count() > 0 or docs is no_docs
        assert cp.tokens(spark, docs, path).count() == docs.count()
    once = cp.without_near_duplicates(spark, odd_docs, path).collect()
    ids = collections.Counter(x["doc_id"] for x in once)
    assert ids[5] == 1 and 6 not in ids and ids[None] == 2 and ids[7] == 1 and 8 not in ids


def test_columns_and_contract():
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None and poisson_mix.TERMS >= 64
    assert with_extra([]) == []


def test_near_duplicates_keep_columns_of_any_name(spark, odd_docs):
    odd = odd_docs.selectExpr("*", "'x' as row_hash", "'y' as Row_Hash_", "1.5 as component_id", "'z' as _row_hash")
    out = cp.without_near_duplicates(spark, odd, "")
    assert out.columns == odd.columns
    assert {(x["row_hash"], x["Row_Hash_"], float(x["component_id"]), x["_row_hash"], x["mark"]) for x in out.collect()} == {("x", "y", 1.5, "z", 1)}
