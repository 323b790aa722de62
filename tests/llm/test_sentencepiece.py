import random

import pytest
import sentencepiece
from llm_helpers import by_row

from bulkflow.llm import sentencepiece_bpe as sp
from bulkflow.llm.contract import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
BITS = ["a", " ", "  ", "▁", "\n", "\t", "é", "日本", "😀", "the", "ing", " t", "0", "12", "\x00", "<s>", "<0x0A>", "....", "==", "​", "ﬁ", "thonanre"]


@pytest.fixture(scope="module")
def vocabulary():
    return sp.Vocabulary.read(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_encodes_and_decodes_as_the_library(vocabulary, library):
    t, r = sp.tokenizer(vocabulary), random.Random(1)
    texts = ["".join(r.choice(BITS) for _ in range(r.randint(0, 30))) for _ in range(3000)] + [" " * 5000, "x" * 5000, "ab " * 5000]
    assert [t.encode(x).tolist() for x in texts] == library.encode(texts)
    ids = [[r.choice([r.randrange(32000), r.randrange(262)]) for _ in range(r.randint(0, 8))] for _ in range(3000)]
    assert [t.decode(x) for x in ids] == [library.decode(x) for x in ids]


def test_small_memories_change_nothing(vocabulary, library, monkeypatch):
    monkeypatch.setattr(sp, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(sp, "REMEMBERED_PAIRS", 3)
    t, r = sp.PrefixTableTokenizer(vocabulary), random.Random(2)
    texts = [" ".join(r.choice(["stream", "streams", "upstream", "the", "xx"]) for _ in range(20)) for _ in range(20)]
    assert [t.encode(x).tolist() for x in texts] == library.encode(texts)


def test_odd_rows(odd_docs, no_docs, vocabulary, library):
    found = sp.encode_documents(odd_docs, vocabulary)
    assert {"score", "key", "f0"} <= set(found.columns)
    expected = sorted(((x["doc_id"], library.encode(x["text"] or ""), library.decode(library.encode(x["text"] or ""))) for x in odd_docs.collect()), key=repr)
    assert by_row(found, "doc_id", "ids", "decoded") == expected
    assert sp.encode_documents(no_docs, vocabulary).collect() == []
    apart = odd_docs.select("doc_id", sp.encode_column(vocabulary, odd_docs["text"]).alias("n"))
    again = apart.select("doc_id", "n", sp.decode_column(vocabulary, apart["n"]).alias("t"))
    assert by_row(again, "doc_id", "n", "t") == expected
