import random
import re

import numpy as np
import pytest
import xxhash
from llm_helpers import by_row, prose

from bulkflow.llm import simhash_ring as sr
from bulkflow.llm.components import components


def by_hand(text, shingle):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return 0
    parts = [b" ".join(words[n : n + shingle]) for n in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(ids, prints, limit):
    """Smallest id reachable, over all pairs."""
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n in range(len(ids)):
        for m in range(n):
            if (prints[n] ^ prints[m]).bit_count() <= limit or (ids[n] is not None and ids[n] == ids[m]):
                parent[find(n)] = find(m)
    groups = {}
    for n, i in enumerate(ids):
        groups.setdefault(find(n), []).append(i)
    return [min((i for i in groups[find(n)] if i is not None), default=None) for n in range(len(ids))]


def test_by_brute_force(spark):
    r = random.Random(6)
    texts = [prose(r, r.randint(0, 80)) for _ in range(60)]
    for t in texts[:30]:
        for _ in range(4):
            words = t.split(" ")
            words[r.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
    rows = [(n * 7 % 1009, t) for n, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    prints = [by_hand(t, 4) for _, t in rows]
    expected = {i: (p, c) for (i, _), p, c in zip(rows, prints, roots([i for i, _ in rows], prints, 4))}
    got = {x["doc_id"]: (x["f0"] % 2**64, x["component_id"]) for x in sr.near_duplicates(docs, 4, 4, 5).collect()}
    assert got == expected and len({c for _, c in got.values()}) < len(got)


@pytest.mark.parametrize("words, limit, segments, depth", [(1, 4, 5, 2), (1, 4, 5, 3), (1, 6, 7, 2), (2, 20, 21, 2), (1, 0, 2, 1)])
def test_ring_loses_no_link(spark, words, limit, segments, depth):
    r = np.random.default_rng(0)
    f = np.repeat(r.integers(0, 2**63, (25, words), dtype=np.uint64), 10, 0)
    for row in f:
        for b in r.choice(64 * words, r.integers(0, limit + 3), replace=False):
            row[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    f = np.unique(f, axis=0)
    rows = [(n, *x) for n, x in enumerate(f.view(np.int64).tolist())]
    classes = spark.createDataFrame(rows, "node long, " + ", ".join(f"{c} long" for c in sr.fingerprint_columns(words)))
    whole = [int.from_bytes(x.tobytes(), "little") for x in f]
    found = {x["node"]: x["root"] for x in components(sr.links(classes, limit, segments, words, depth)).collect()}
    assert [found.get(n, n) for n in range(len(f))] == roots(list(range(len(f))), whole, limit)


@pytest.mark.parametrize("cells", [1 << 20, 500])
def test_large_groups_keep_all_components(monkeypatch, cells):
    monkeypatch.setattr(sr, "MATRIX_CELLS", cells)
    r = np.random.default_rng(1)
    f = np.repeat(r.integers(0, 2**63, (30, 1), dtype=np.uint64), 8, 0)
    for row in f:
        for b in r.choice(64, r.integers(0, 6), replace=False):
            row[0] ^= np.uint64(1) << np.uint64(b)
    a, b = sr._large_group(len(f), np.arange(len(f)), f, 4)
    parent = list(range(len(f)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        parent[max(find(x), find(y))] = min(find(x), find(y))
    assert [find(n) for n in range(len(f))] == roots(list(range(len(f))), [int(x) for x in f[:, 0]], 4)


def test_forest():
    a, b = np.array([5, 9, 7, 2, 3, 3, 100]), np.array([9, 7, 3, 8, 3, 5, 101])
    x, y = sr._forest(a, b)
    assert sorted(zip(x.tolist(), y.tolist())) == [(2, 8), (3, 5), (3, 7), (3, 9), (100, 101)]
    chain = np.arange(500)
    assert set(sr._forest(chain[1:], chain[:-1])[0].tolist()) == {0}
    assert len(sr._forest(a[:0], b[:0])[0]) == 0


def test_components(spark):
    path = [(n, n + 1) for n in range(50)]
    edges = spark.createDataFrame([*path, (100, 101), (102, 101), (5, 5), (7, 6), (200, 200)], "a long, b long")
    found = dict(by_row(components(edges), "node", "root"))
    assert found == {n: 0 for n in range(51)} | {100: 100, 101: 100, 102: 100}
    assert components(edges.limit(0)).collect() == []


def test_odd_rows(odd_docs, no_docs):
    rows = [(x["doc_id"], x["text"]) for x in odd_docs.collect()]
    prints = [by_hand(t, 4) for _, t in rows]
    expected = sorted(((i, p, c) for (i, _), p, c in zip(rows, prints, roots([i for i, _ in rows], prints, 4))), key=repr)
    got = sorted(((x["doc_id"], x["f0"] % 2**64, x["component_id"]) for x in sr.near_duplicates(odd_docs, 4, 4, 5).collect()), key=repr)
    assert got == expected
    assert sr.near_duplicates(no_docs, 4, 4, 5).collect() == []


def near_family(r, size, flips):
    """Fingerprints around one centre, differing in a few of all bits; many share a key, not all are linked."""
    centre = r.integers(0, 2**63, dtype=np.uint64)
    f = np.full(size, centre)
    for n in range(size):
        for b in r.choice(64, r.integers(0, flips + 1), replace=False):
            f[n] ^= np.uint64(1) << np.uint64(b)
    return np.unique(f)


@pytest.mark.parametrize("flips, group_rows, block_rows", [(6, 40, 16), (10, 100, 64), (3, 200, 1 << 13)])
def test_large_groups_are_compared_in_blocks(spark, monkeypatch, flips, group_rows, block_rows):
    r = np.random.default_rng(flips)
    f = np.concatenate([near_family(r, 700, flips), near_family(r, 300, flips), r.integers(0, 2**63, 50, dtype=np.uint64)])
    f = np.unique(f)
    rows = [(n, int(x.view(np.int64))) for n, x in enumerate(f)]
    classes = spark.createDataFrame(rows, "node long, f0 long").repartition(4)
    monkeypatch.setattr(sr, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(sr, "BLOCK_ROWS", block_rows)
    found = {x["node"]: x["root"] for x in components(sr.links(classes, 4, 5)).collect()}
    expected = roots(list(range(len(f))), [int(x) for x in f], 4)
    assert [found.get(n, n) for n in range(len(f))] == expected


def test_whole_groups_holds_no_large_group():
    """Parts of a large group come as they are read; all others are whole."""
    import pyarrow as pa

    r = random.Random(4)
    keys = sorted(r.choice([1, 2, 3, 4, 5, 6]) if n % 3 else 4 for n in range(5000))
    batches = []
    at = 0
    while at < len(keys):
        part = keys[at : at + r.randint(1, 90)]
        at += len(part)
        n = len(part)
        batches.append(pa.RecordBatch.from_arrays([pa.array(part), pa.array([False] * n), pa.array(range(n)), pa.array(range(n))], ["key", "changed", "node", "f0"]))
    large, small = [], []
    for is_large, key, *_ in sr._whole_groups(iter(batches), ["f0"], 1000):
        assert len(key) <= (1100 if is_large else 5000)
        (large if is_large else small).append(key.tolist())
    assert {k for part in large for k in part} == {4} and sum(map(len, large)) == keys.count(4)
    seen = [set(part) for part in small]
    assert sum(map(len, seen)) == 5 and sorted(k for part in small for k in part) == [k for k in keys if k != 4]
