"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts of the training fold, whatever their mark, are the
unlabelled ones.  With p the share of toxic texts (the class prior), the risk of a classifier is

    p * E_P[loss(+)]  +  max(0, E_U[loss(-)] - p * E_P[loss(-)]),

and where the second part would turn negative, its gradient is reversed, so that the classifier
cannot fit the unlabelled texts too closely.  A few linear numpy classifiers over the presence of
words and word beginnings are trained from different starts, and their logits are averaged.

Features are chosen by how much their rate among positives differs from the rate among unlabelled
texts.  Only the fit uses a bounded sample of labelled rows (``POSITIVES``, ``UNLABELLED``, taken by
hash of the id); equal texts count once in it.  The prior comes from all rows of the training fold.

Defined results: a null text is an empty one and is scored like any other.  Without any confirmed
toxic row to learn from, every score is 0.  Rows with a null id or label are not learnt from.  Texts of
any length are scored whole, and equal texts get equal scores.  An empty table has no rows.  Only the id,
the text and the mark are looked at, so the names of other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import ids_and_texts, in_training_fold, ship, text_slices
from bulkflow.llm.components import durable

#: Bounds of the fitting sample, number of word features, classifiers, steps and their size.
POSITIVES, UNLABELLED, FEATURES = 4_000, 16_000, 256
CLASSIFIERS, STEPS, RATE, SHRINK = 3, 300, 0.3, 1e-4

#: Something is a feature only if this share of the positives has it.
LEAST_SHARE = 0.01
#: Letters of a word's beginning.
BEGINNING = 4

_LETTERS = re.compile(r"[^\W\d_]+")


def features_of(text: str) -> set[str]:
    """All words in lower case, and the beginnings of longer ones, which stand for inflected forms."""
    words = set(_LETTERS.findall(text.lower()))
    words.update([w[:BEGINNING] + "-" for w in words if len(w) > BEGINNING])
    return words


@dataclass(frozen=True)
class Model:
    """Weights by feature and a bias; at most ``FEATURES`` of them."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str) -> float:
        if self.bias == -np.inf:
            return 0.0
        present = self.weights.keys() & features_of(text)
        logit = self.bias + sum(self.weights[w] for w in sorted(present))
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from the training fold of ``labels`` (id, mark) and the texts of ``docs``."""
    ship(docs.sparkSession)
    marked = labels.select(labels[id_col].alias("doc_id"), labels[label_col].alias("toxic"))
    marked = marked.where(in_training_fold(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = durable(marked)
    prior = marked.select(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return Model({}, -np.inf)
    by_hash = (F.xxhash64("doc_id"), F.col("doc_id"))
    positive = marked.where("toxic = 1").orderBy(*by_hash).limit(POSITIVES).select("doc_id", F.lit(1).alias("p"), F.lit(0).alias("u"))
    unlabelled = marked.orderBy(*by_hash).limit(UNLABELLED).select("doc_id", F.lit(0).alias("p"), F.lit(1).alias("u"))
    chosen = positive.union(unlabelled).groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    texts = ids_and_texts(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # at most POSITIVES + UNLABELLED rows
    words = texts.select("p", "u", F.xxhash64("text").alias("same"), _words_column(F.col("text")).alias("words"))
    sample = durable(words.groupBy("same").agg(F.max("p").alias("p"), F.max("u").alias("u"), F.any_value("words").alias("words")))
    n_p, n_u = sample.agg(F.sum("p"), F.sum("u")).first()
    if not n_p or not n_u:
        return Model({}, -np.inf)
    features = _telling_words(sample, n_p, n_u)
    rows = sample.select("p", "u", F.array_intersect("words", F.array(*map(F.lit, features))).alias("words")).collect()
    return _train(rows, features, float(prior))


def _words_column(text: Column) -> Column:
    @F.arrow_udf("array<string>")
    def words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([sorted(features_of(t)) for part in text_slices(batch) for t in part], pa.list_(pa.string()))

    return words(text)


def _telling_words(sample: DataFrame, n_p: int, n_u: int) -> list[str]:
    """Words whose rates among positives and unlabelled texts differ by the most standard errors."""
    counts = sample.select("p", "u", F.explode("words").alias("word")).groupBy("word").agg(F.sum("p").alias("a"), F.sum("u").alias("b"))
    rate_p, rate_u = (F.col("a") + 0.5) / (n_p + 1), (F.col("b") + 0.5) / (n_u + 1)
    error = F.sqrt(rate_u * (1 - rate_u) * (1 / n_p + 1 / n_u))
    best = counts.where(F.col("a") >= max(2, LEAST_SHARE * n_p)).orderBy(F.desc(F.abs(rate_p - rate_u) / error), "word").limit(FEATURES)
    return sorted(r["word"] for r in best.collect())


def _train(rows: list, features: list[str], prior: float) -> Model:
    place = {w: n for n, w in enumerate(features)}
    x = np.zeros((len(rows), len(features) + 1), np.float32)
    x[:, -1] = 1
    for n, r in enumerate(rows):
        x[n, [place[w] for w in r["words"]]] = 1
    p = np.array([r["p"] for r in rows]) == 1
    u = np.array([r["u"] for r in rows]) == 1
    w = np.mean([non_negative_pu(x[p], x[u], prior, seed) for seed in range(CLASSIFIERS)], axis=0)
    return Model({f: float(w[n]) for f, n in place.items()}, float(w[-1]))


def non_negative_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int) -> np.ndarray:
    """Weights of a linear classifier (last column: bias) under the non-negative risk, by Adam steps."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0, 0.01, positive.shape[1])
    w[-1] = np.log(prior / (1 - prior)) if prior < 1 else 10.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        on_p, on_u = positive @ w, unlabelled @ w
        wrong_p, wrong_u = _sigmoid(on_p), _sigmoid(on_u)  # slopes of softplus(f); that of softplus(-f) is less by 1
        as_negative = np.logaddexp(0, on_u).mean() - prior * np.logaddexp(0, on_p).mean()
        from_p = positive.T @ wrong_p / len(positive)
        slope_n = unlabelled.T @ wrong_u / len(unlabelled) - prior * from_p
        slope_p = prior * (from_p - positive.mean(0))
        g = slope_p + slope_n if as_negative >= 0 else -slope_n
        g[:-1] += SHRINK * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def score_column(model: Model, text: Column) -> Column:
    """Probability-like toxicity of a whole text."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.score(t) for part in text_slices(batch) for t in part], pa.float64())

    return score(F.coalesce(text, F.lit("")))
