import hashlib
import random
import zlib

import pytest
from llm_helpers import DOCUMENTS, by_row, with_extra
from pyspark.sql import functions as F

from bulkflow.llm import merkle_manifest as mm
from bulkflow.llm.contract import LEAF, QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_by_hand(leaves, arity):
    """The root, and every leaf's runs as (slot, run) from below."""
    ways, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        runs = [nodes[k : k + arity] for k in range(0, len(nodes), arity)]
        for way, k in zip(ways, at):
            way.append((k % arity, runs[k // arity]))
        nodes, at = [h(*run) for run in runs], [k // arity for k in at]
    return nodes[0], ways


def manifest_by_hand(rows, arity=3):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, text, lang, source, n_chars)."""
    key = lambda x: (x is not None, b"" if x is None else x.encode() if isinstance(x, str) else x)
    leaves = [(r[3], r[0], leaf_by_hand((r[0], r[3], r[2], r[4], r[1])), r) for r in rows]
    leaves.sort(key=lambda x: (key(x[0]), (x[1] is not None, x[1] or 0), x[2]))
    sources = sorted({x[0] for x in leaves}, key=key)
    low = {s: tree_by_hand([x[2] for x in leaves if x[0] == s], arity) for s in sources}
    root, high = tree_by_hand([low[s][0] for s in sources], arity)
    out = []
    for s, above in zip(sources, high):
        for x, way in zip([x for x in leaves if x[0] == s], low[s][1]):
            r, acc, proof = x[3], x[2], ""
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                acc = leaf_by_hand((r[0], r[3], r[2], r[4], r[1].replace("\n", "")))
            for slot, run in way + above:
                before, after = "".join(run[:slot]), "".join(run[slot + 1 :])
                acc, proof = h(before, acc, after), proof + before + after
            out.append((r[0], x[2], low[s][0], root, h(proof), acc, acc == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def query(spark, tmp_path, rows):
    spark.createDataFrame(with_extra(rows), DOCUMENTS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return by_row(QUERIES["op11_merkle_manifest"](spark, str(tmp_path)), *COLUMNS)


def test_odd_rows(spark, odd_docs, tmp_path):
    rows = [tuple(x)[:5] for x in odd_docs.collect()]
    got = query(spark, tmp_path, rows)
    assert got == manifest_by_hand(rows)
    assert any(x[-1] for x in got) and not all(x[-1] for x in got)


@pytest.mark.parametrize("sizes", [[1], [2], [3], [4, 1], [27, 1, 9, 10], [1] * 11])
def test_shapes_and_a_hot_group(spark, tmp_path, sizes):
    r = random.Random(1)
    rows = [(r.randrange(10**9), f"line {n}\nmore", "en", f"s{s}é", n) for s, size in enumerate(sizes) for n in range(size)]
    rows += [(n, "plain", None, None, n) for n in range(sizes[0] // 9 * 30)]
    assert query(spark, tmp_path, rows) == manifest_by_hand(rows)


def test_equal_rows_and_equal_ids(spark, tmp_path):
    rows = [(7, "same", "en", "a", 4)] * 5 + [(7, "other", "en", "a", 4), (8, None, None, "a", None), (None, "x", "en", "a", 1)]
    assert query(spark, tmp_path, rows) == manifest_by_hand(rows)


def test_binary_runs_use_the_other_slot(spark):
    docs = spark.createDataFrame([(n, "g" if n % 3 else None) for n in range(23)], "id int, part string")
    root, proofs = mm.manifest(docs, ["id"], "part", "id", arity=2)
    low = {g: tree_by_hand([leaf_by_hand((n,)) for n in range(23) if ("g" if n % 3 else None) == g], 2) for g in (None, "g")}
    assert root == h(low[None][0], low["g"][0])
    found = proofs.select("id", "leaf", mm.folded(F.col("leaf"), F.col("path")).alias("f")).collect()
    assert len(found) == 23 and {x["f"] for x in found} == {root}
    changed = proofs.select(mm.folded(F.sha2(F.col("leaf"), 256), F.col("path")).alias("f")).collect()
    assert root not in {x["f"] for x in changed}


def test_an_empty_table(spark, no_docs):
    root, proofs = mm.manifest(no_docs, LEAF, "source", "doc_id", also={"mark": F.lit(1)})
    assert root is None and proofs.count() == 0 and proofs.columns == ["group", "id", "mark", "leaf", "subroot", "path"]
    with pytest.raises(ValueError):
        mm.manifest(no_docs, LEAF, "source", "doc_id", arity=1)


def test_values_cannot_run_into_each_other(spark):
    rows = spark.createDataFrame([("a", "1:b"), ("a1:b", ""), ("-", None), (None, "-"), ("ä", "")], "x string, y string")
    leaves = [x[0] for x in rows.select(mm.leaf_digest([rows["x"], rows["y"]])).collect()]
    assert len(set(leaves)) == 5 and leaves[4] == h("2:ä0:")


def test_positions_do_not_gather_a_hot_group(spark):
    rows = spark.range(4000).selectExpr("id", "if(id % 3 = 0, null, cast(id % 3 as string)) as g0")
    placed = mm.positions(rows.withColumn("g0", F.when(F.col("id") < 3000, "hot").otherwise(F.col("g0"))), ["g0"], ["id"])
    found = placed.groupBy("g").agg(F.count("*").alias("n"), F.min("i"), F.max("i"), F.countDistinct("i"), F.max("n")).collect()
    assert all(x[2] == 0 and x[3] == x[1] - 1 and x[4] == x[1] and x[5] == x[1] for x in found) and len(found) == 4
    assert sorted(x[1] for x in found)[-1] == 3000
