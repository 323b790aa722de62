"""The three learnt scorers against plain versions of learning and scoring, row by row."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from llm_helpers import DOCUMENTS, prose, with_extra

from bulkflow.llm import lang_hyperdim as lh
from bulkflow.llm import quality_rff as qr
from bulkflow.llm import toxicity_pu as tox
from bulkflow.llm.contract import QUERIES


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(12)
    alphabets = {"en": "taeoin", "de": "üßernst", "fr": "éàlsui"}
    rows, marks = [], []
    for n in range(420):
        lang = r.choice(list(alphabets))
        bad, good = r.random() < 0.2, r.random() < 0.5
        words = ["".join(r.choice(alphabets[lang]) for _ in range(r.randint(2, 7))) for _ in range(r.randint(8, 40))]
        words += r.sample(["Vile", "nasty!", "rotten", "horrid"], 2) * bad
        words += [w + r.choice(".,") if good else w.upper() + "##" for w in words[:9]]
        r.shuffle(words)
        rows.append((n, " ".join(words) + "\n" * (n % 3), lang if n % 17 else None, "s", 1))
        if n % 4:
            marks.append((n, int(good), int(bad)))
    rows += [(n, rows[5][1], "en", "s", 1) for n in (900, 901, 902)] + [(950, None, "en", "s", 1), (951, "12 !", "en", "s", 1), (None, prose(r, 20), "de", "s", 1)]
    marks += [(900, 1, 1), (901, 1, 1), (902, 0, 0), (None, 1, 1), (3, None, None), (7, 1, 1), (7, 0, 0)]
    path = str(tmp_path_factory.mktemp("learners"))
    spark.createDataFrame(with_extra(rows), DOCUMENTS).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, [(x[0], x[1] or "", x[2]) for x in rows], marks


def marked(marks, column):
    """The largest mark of each id of the training fold."""
    out = {}
    for row in marks:
        if row[column] is not None and not held_out(row[0]):
            out[row[0]] = max(out.get(row[0], 0), row[column])
    return out


def test_toxicity_by_a_plain_version(spark, corpus):
    path, rows, marks = corpus
    known = marked(marks, 2)
    prior = sum(known.values()) / len(known)
    assert len(known) < tox.UNLABELLED and 0 < prior < 0.5

    def words(text):
        found = set(re.findall(r"[^\W\d_]+", text.lower()))
        return found | {w[:4] + "-" for w in found if len(w) > 4}

    texts = {}
    for i, text, _ in rows:
        if i in known:
            p, _ = texts.get(text, (0, 1))
            texts[text] = (max(p, known[i]), 1)
    bags = [(words(t), p) for t, (p, _) in texts.items()]
    positive, n_u = [b for b, p in bags if p], len(bags)
    n_p = len(positive)
    ranked = []
    for w in set().union(*(b for b, _ in bags)):
        a, b = sum(w in x for x in positive), sum(w in x for x, _ in bags)
        rate_p, rate_u = (a + 0.5) / (n_p + 1), (b + 0.5) / (n_u + 1)
        if a >= max(2, tox.LEAST_SHARE * n_p):
            ranked.append((-abs(rate_p - rate_u) / math.sqrt(rate_u * (1 - rate_u) * (1 / n_p + 1 / n_u)), w))
    ranked.sort()
    features = sorted(w for _, w in ranked[: tox.FEATURES])
    assert len(ranked) < tox.FEATURES or ranked[tox.FEATURES - 1][0] < ranked[tox.FEATURES][0] - 1e-9
    x_u = np.array([[float(f in b) for f in features] + [1.0] for b, _ in bags])
    x_p = np.array([[float(f in b) for f in features] + [1.0] for b in positive])
    weights = np.zeros(len(features) + 1)
    for seed in range(tox.CLASSIFIERS):
        w = np.random.default_rng(seed).normal(0, 0.01, len(weights))
        w[-1] = math.log(prior / (1 - prior))
        first, second = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, tox.STEPS + 1):
            f_p, f_u = x_p @ w, x_u @ w
            risk_n = np.log1p(np.exp(f_u)).mean() - prior * np.log1p(np.exp(f_p)).mean()
            slope_positive = -prior * (x_p * (1 / (1 + np.exp(f_p)))[:, None]).mean(0)  # of softplus(-f)
            slope_negative = (x_u * (1 / (1 + np.exp(-f_u)))[:, None]).mean(0) - prior * (x_p * (1 / (1 + np.exp(-f_p)))[:, None]).mean(0)
            g = slope_positive + slope_negative if risk_n >= 0 else -slope_negative
            g[:-1] += tox.SHRINK * w[:-1]
            first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g**2
            w = w - tox.RATE * first / (1 - 0.9**t) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        weights += w / tox.CLASSIFIERS
    by_name = dict(zip(features, weights))
    found = collections.defaultdict(set)
    for x in QUERIES["op2_toxicity_pu"](spark, path).collect():
        assert x["held_out"] == held_out(x["doc_id"]) and x["predicted"] == (x["score"] >= 0.5)
        found[x["doc_id"]].add(round(x["score"], 9))
    for i, text, _ in rows:
        logit = weights[-1] + sum(by_name.get(w, 0.0) for w in words(text))
        assert any(abs(s - 1 / (1 + math.exp(-logit))) < 0.01 for s in found[i]), (i, text)


def test_language_by_a_plain_version(spark, corpus):
    path, rows, _ = corpus

    def triples(text):
        codes = [0, *(ord(c) if c.isalpha() else 0 for c in text.lower()), 0]
        return collections.Counter(tuple(codes[k - 1 : k + 2]) for k in range(1, len(codes) - 1) if codes[k])

    made = {}

    def vector(triple):
        if triple not in made:
            out = np.ones(lh.DIMENSIONS)
            for shift, code in zip((2, 1, 0), triple):
                out = out * np.roll(lh.letters().vector(code), shift)
            made[triple] = out
        return made[triple]

    bundles = [triples(t) for _, t, _ in rows]
    totals = {}
    for (i, text, lang), counts in zip(rows, bundles):
        if lang and not held_out(i) and counts:
            size = math.sqrt(sum(n * n for n in counts.values()))
            totals[lang] = totals.get(lang, 0) + sum(n / size * vector(t) for t, n in counts.items())
    profiles = {k: v / np.linalg.norm(v) for k, v in sorted(totals.items())}
    found = collections.defaultdict(set)
    for x in QUERIES["op7_hyperdim_lang"](spark, path).collect():
        assert x["held_out"] == held_out(x["doc_id"])
        found[x["doc_id"]].add((x["lang_pred"], round(x["score"], 3)))
    for (i, _, _), counts in zip(rows, bundles):
        if not counts:
            assert found[i] == {("und", 0.0)}
            continue
        document = sum(n * vector(t) for t, n in counts.items())
        length = math.sqrt(sum(n * n for n in counts.values()) * lh.DIMENSIONS)
        cosines = {k: document @ v / length for k, v in profiles.items()}
        best = max(cosines, key=cosines.get)
        score = 1 / sum(math.exp(lh.SHARPNESS * (c - cosines[best])) for c in cosines.values())
        assert any(name == best and abs(s - score) < 0.002 for name, s in found[i]), i


def test_quality_by_a_plain_version(spark, corpus):
    path, rows, marks = corpus
    known = marked(marks, 1)
    stats = np.array([qr.statistics(t) for _, t, _ in rows])
    import struct

    import xxhash

    def calibrates(doc_id):
        return xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42) % 4 == 3

    learnt = [(stats[n], known[i], calibrates(i)) for n, (i, _, _) in enumerate(rows) if i in known]
    x, y = np.array([s for s, _, c in learnt if not c]), np.array([m for _, m, c in learnt if not c], float)
    held_x, held_y = np.array([s for s, _, c in learnt if c]), np.array([m for _, m, c in learnt if c], float)
    mean, spread = x.mean(0), np.sqrt(np.maximum(x.var(0), 1e-12))
    z = qr.random_features((x - mean) / spread)
    ridge = np.eye(z.shape[1]) * qr.RIDGE * len(x)
    ridge[-1, -1] = 0
    weights = np.linalg.solve(sum(np.outer(row, row) for row in z) + ridge, sum(row * m for row, m in zip(z, y)))

    def raw(s):
        return qr.random_features((s - mean) / spread) @ weights

    bins = collections.defaultdict(list)
    for value, m in zip(raw(held_x), held_y):
        bins[min(max(int((value + 0.5) / 2 * qr.BINS), 0), qr.BINS - 1)].append(m)
    centres = sorted(bins)
    # The isotonic fit by its definition: the largest over starts of the least over ends of the means.
    steps = [
        max(min(np.mean([m for c in centres[a : b + 1] for m in bins[c]]) for b in range(k, len(centres))) for a in range(k + 1)) for k in range(len(centres))
    ]
    expected = np.interp(raw(stats), [(c + 0.5) / qr.BINS * 2 - 0.5 for c in centres], steps)
    found = collections.defaultdict(set)
    for x in QUERIES["op10_quality_rff"](spark, path).collect():
        assert x["held_out"] == held_out(x["doc_id"]) and x["predicted"] == (x["score"] >= 0.3)
        found[x["doc_id"]].add(x["score"])
    off = [i for n, (i, _, _) in enumerate(rows) if not any(abs(s - expected[n]) < 1e-6 for s in found[i])]
    assert not off
