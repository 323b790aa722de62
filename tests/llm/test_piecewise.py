import random

import pytest
from llm_helpers import prose

from bulkflow.llm import piecewise_hash as ph


def rows_by_hand(rows):
    """Pairs of (text, next text) in descending order of id; nulls last."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is None, -(x[0] or 0)))
    return rows


def test_edit_distance_by_table():
    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abcd") for _ in range(r.randint(0, 70))) for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for n, y in enumerate(b):
                new.append(row[n] + 1 if x == y else max(row[n + 1], new[n]))
            row = new
        assert ph._common(a, b) == row[-1]


def test_fingerprints():
    r = random.Random(2)
    assert ph.fingerprint("") == "3::" and ph.likeness("3::", "3::") == 1 and ph.likeness("3::", ph.fingerprint("abc")) == 0
    for n in (1, 5, 40, 300, 20_000):
        text, other = prose(r, n), prose(r, n)
        mark = ph.fingerprint(text)
        size, fine, coarse = mark.split(":")
        assert len(fine) <= ph.LENGTH and len(coarse) <= len(fine) and ph.fingerprint(text) == mark
        if n >= 40:
            changed = ph.fingerprint(text.replace(text.split()[n // 2], "changed", 1))
            assert ph.likeness(mark, changed) > 0.7 > 0.2 > ph.likeness(mark, ph.fingerprint(other))
    assert ph.fingerprint("x" * 100_000).count(":") == 2


@pytest.mark.parametrize("ranges", [1, 2, 7])
def test_next_document_across_ranges(spark, ranges):
    r = random.Random(3)
    rows = [(n * n, prose(r, r.randint(0, 50))) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x["doc_id"]: x for x in ph.compare_with_next(docs, ranges=ranges).collect()}
    ordered = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i]["edited"] == edited and got[i]["n_chars"] == len(text)
        assert got[i]["edited_fingerprint"] == ph.fingerprint(edited) and got[i]["fingerprint"] == ph.fingerprint(text)
        assert got[i]["near_next"] == ph.likeness(ph.fingerprint(text), ph.fingerprint(after))


def test_odd_rows(odd_docs, no_docs, spark):
    found = ph.compare_with_next(odd_docs, ranges=4).collect()
    assert sorted((x["doc_id"] or -1, x["n_chars"]) for x in found) == sorted((x["doc_id"] or -1, len(x["text"] or "")) for x in odd_docs.collect())
    assert ph.compare_with_next(no_docs).collect() == []
    one = ph.compare_with_next(spark.createDataFrame([(1, "only one")], "doc_id long, text string")).collect()
    assert [(x["doc_id"], x["edited"], x["near_next"]) for x in one] == [(1, "onlyonly", 1.0)]
    nulls = ph.compare_with_next(spark.createDataFrame([(None, "ab"), (None, "ab")], "doc_id long, text string")).collect()
    assert len(nulls) == 2


def test_ranges_are_even_and_found_by_search(spark):
    docs = spark.range(20_000).selectExpr("id * 3 as doc_id", "concat('text ', id) as text")
    found = ph.compare_with_next(docs, ranges=51)
    sizes = sorted(x[0] for x in found.groupBy(ph.F.spark_partition_id()).count().select("count").collect())
    assert len(sizes) >= 50 and sizes[0] > 200 and sizes[-1] < 600
    cuts = sorted({n * n for n in range(1, 700)}, reverse=True)
    ids = spark.range(-5, 500_000, 997).withColumnRenamed("id", "doc_id")
    for x in ids.select("doc_id", ph._range_of(ids["doc_id"], cuts).alias("r")).collect():
        assert x["r"] == sum(c >= x["doc_id"] for c in cuts)
