import collections
import hashlib
import math

import duckdb
import numpy as np
from llm_helpers import by_row

from bulkflow.llm import poisson_mix as pm
from bulkflow.llm.contract import QUERIES, SQL

SF = "/root/testdata/sf0.01"


def copies_by_hand(seed, doc_id, rate, text=""):
    draws = max(1, math.ceil(rate / pm.DRAW_RATE))
    total = 0
    for d in range(draws):
        key = f"{seed}|{d}|{'null' if doc_id is None else doc_id}|{hashlib.md5((text or '').encode()).hexdigest()}"
        u = int(hashlib.md5(key.encode()).hexdigest()[: pm.DIGITS], 16) / 16**pm.DIGITS
        n, p = 0, math.exp(-rate / draws)
        c = p
        while u >= c and n < pm.TERMS:
            n += 1
            p *= rate / draws / n
            c += p
        total += n
    return total


def test_copies_by_hand_and_distribution(spark):
    for rate in (0.0, 0.3, 1.0, 7.9, 30.0):
        rows = spark.range(2000).select("id", pm.copies(5, pm.row_key(pm.F.col("id"), pm.F.lit("")), pm.F.lit(rate)).alias("n")).collect()
        assert all(x["n"] == copies_by_hand(5, x["id"], rate) for x in rows)
        n = np.array([x["n"] for x in rows])
        assert abs(n.mean() - rate) <= 4 * math.sqrt(max(rate, 1e-9) / 2000) and abs(n.var() - rate) < 0.2 * rate + 1e-9


def test_sql(spark):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    expected = sorted(c.execute(SQL["op9_poisson_mix"]).fetchall(), key=repr)
    found = QUERIES["op9_poisson_mix"](spark, SF)
    assert by_row(found, "doc_id", "text", "lang", "source", "n_chars", "copy") == expected


def test_shares_and_order(spark):
    docs = spark.range(6000).selectExpr("id doc_id", "case when id < 4000 then 'big' when id < 5500 then 'mid' else 'low' end source", "'t' as text")
    weights = spark.createDataFrame([("big", 1.0), ("mid", 1.0), ("low", 2.0), ("absent", 9.0)], "source string, weight double")
    rows = pm.mix(docs, weights, size=2.0).collect()
    shares = collections.Counter(x["source"] for x in rows)
    assert abs(len(rows) / 12_000 - 1) < 0.05 and abs(shares["low"] / len(rows) - 0.5) < 0.03 and abs(shares["big"] / len(rows) - 0.25) < 0.03
    ids = np.array([x["doc_id"] for x in rows], float)
    assert abs(np.corrcoef(ids[:-1], ids[1:])[0, 1]) < 0.05  # neighbours are unrelated


def test_odd_rows(odd_docs, no_docs, spark):
    out = pm.mix(odd_docs, pm.tempered_weights(odd_docs), size=3.0)
    assert sorted(out.columns) == sorted(odd_docs.columns)
    rate = {x["mix_source"]: x["rate"] for x in pm.rates(odd_docs, pm.tempered_weights(odd_docs), 3.0).collect()}
    assert None in rate
    expected = collections.Counter()
    for x in odd_docs.collect():
        expected[x["doc_id"], x["text"]] += copies_by_hand(17, x["doc_id"], rate[x["source"]], x["text"])
    assert collections.Counter((x["doc_id"], x["text"]) for x in out.collect()) == +expected
    assert pm.mix(no_docs, pm.tempered_weights(no_docs)).collect() == []
    assert pm.mix(odd_docs, pm.tempered_weights(no_docs)).collect() == []


def test_a_hot_id_draws_by_its_rows_and_is_dealt_out(spark):
    """A third of the rows share a null id: their copies follow the rate, and no task gets them all."""
    docs = spark.range(30_000).selectExpr("if(id % 3 = 0, null, id) as doc_id", "concat('text ', id) as text", "'s' as source", "1.5 as rate", "2 as mix_times", "'m' as mix_source", "'k' as Mix_Key")
    out = pm.mix(docs, pm.tempered_weights(docs), size=1.0)
    assert out.columns == [*docs.columns, "copy"]
    null = out.where("doc_id is null").count()
    assert abs(null / 10_000 - 1) < 0.05 and abs(out.count() / 30_000 - 1) < 0.03
    placed = out.repartitionByRange(8, pm.F.xxhash64(pm.F.lit(17), pm.row_key(pm.F.col("doc_id"), pm.F.col("text")), pm.F.col("copy")))
    sizes = [x[0] for x in placed.groupBy(pm.F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
