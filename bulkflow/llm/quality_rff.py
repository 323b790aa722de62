"""Quality classifier: random Fourier features, ridge regression and isotonic calibration.

A document becomes a few statistics, one pass over its text.  Standardised, they are mapped to
cosines of random projections, whose inner products approximate a Gaussian kernel.  Ridge scores
come from the normal equations, which every partition sums for its own labelled rows and which are
added up in a fixed number of parts; only one square matrix reaches the driver.  The scores are
calibrated by isotonic regression over score bins, on training rows the ridge has not seen.

All labelled rows of the training fold are used: three of its four parts (by hash) for the ridge,
the fourth for the calibration, or all for both when a part has no rows.

Defined results: a null text is an empty one and is scored like any other.  Without labelled rows
every score is 0.5.  Rows with a null id or label are not learnt from.  Texts of any length are measured
whole, and equal texts get equal scores.  An empty table has no rows.  Columns that are not asked for
are left behind before anything else, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import ids_and_texts, in_training_fold, ship, text_slices
from bulkflow.llm.components import durable

#: Random features, ridge weight per row, score bins of the calibration, parts of the sums.
FEATURES, RIDGE, BINS, SUM_PARTS, SEED = 256, 1e-4, 512, 16, 7
NAMES = (
    "log_chars", "log_words", "word_length", "longest_word", "upper", "digits", "punctuation", "symbols", "marks",
    "lines", "new_words", "new_triples", "dup_lines", "capital_words", "short_words", "odd_ends",
)

_UPPER, _DIGIT = slice(65, 91), slice(48, 58)
_PUNCTUATION, _SYMBOLS, _MARKS = (np.frombuffer(x, np.uint8) for x in (b".,;:?'\"()-", b"#*$%&|<>=@~^_\\/{}[]+", b"!"))


def statistics(text: str) -> tuple[float, ...]:
    """The values of ``NAMES`` for a whole text; all 0 where there is nothing to measure."""
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, chars = max(1, len(words)), max(1, len(raw))
    sizes = list(map(len, words))
    triples = max(1, len(words) - 2)
    return (
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        sum(sizes) / n,
        float(np.log1p(max(sizes, default=0))),
        counts[_UPPER].sum() / chars,
        counts[_DIGIT].sum() / chars,
        counts[_PUNCTUATION].sum() / chars,
        counts[_SYMBOLS].sum() / chars,
        counts[_MARKS].sum() / chars,
        len(lines) / n,
        len(set(words)) / n,
        len(set(zip(words, words[1:], words[2:]))) / triples,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(map(str.isupper, words)) / n,
        sum(x <= 3 for x in sizes) / n,
        sum(not w[-1].isalnum() for w in words) / n,
    )


def statistics_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def stats(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([statistics(t) for part in text_slices(batch) for t in part], pa.list_(pa.float64()))

    return stats(F.coalesce(text, F.lit("")))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats) for every row, written to the shared folder: texts are read once."""
    ship(docs.sparkSession)
    texts = ids_and_texts(docs, id_col, text_col)
    return durable(texts.select("doc_id", statistics_column(F.col("text")).alias("stats")))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    steps_at: np.ndarray
    steps: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return random_features((stats - self.mean) / self.spread) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.steps_at, self.steps), 0, 1)


def random_features(x: np.ndarray) -> np.ndarray:
    """sqrt(2/D) cos(Wx + b), and a constant; the kernel's width is the root of twice the statistics."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0, 1 / np.sqrt(2 * x.shape[1]), (x.shape[1], FEATURES))
    b = rng.uniform(0, 2 * np.pi, FEATURES)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(np.clip(x, -8, 8) @ w + b), np.ones((len(x), 1))])


def _stats(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("stats").flatten().to_numpy().reshape(batch.num_rows, len(NAMES))


def _summed(rows: DataFrame, of) -> np.ndarray | None:
    """Sum of ``of(stats, marks)`` over all rows: per partition, then in ``SUM_PARTS`` parts, then here."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                now = of(_stats(batch), batch.column("mark").to_numpy().astype(float))
                total = now if total is None else total + now
        yield packed(total)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column("total").to_pylist():
                now = np.frombuffer(raw, np.float64)
                total = now if total is None else total + now
        yield packed(total)

    def packed(total: np.ndarray | None) -> pa.RecordBatch:
        rows = [] if total is None else [total.astype(np.float64).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["total"])

    parts = rows.mapInArrow(partial, "total binary").repartition(SUM_PARTS).mapInArrow(add_up, "total binary").collect()
    return sum(np.frombuffer(r["total"], np.float64) for r in parts) if parts else None


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model | None:
    """Learn from all labelled rows of the training fold; None without any."""
    marks = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("mark"))
    marks = marks.where(in_training_fold(F.col("doc_id")) & F.col("mark").isNotNull()).groupBy("doc_id").agg(F.max("mark").alias("mark"))
    part = (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 3).alias("calibrates")
    rows = durable(measured.join(marks, "doc_id").select("stats", "mark", part))
    sizes = {r["calibrates"]: r["n"] for r in rows.groupBy("calibrates").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    fitted, held = (rows.where("not calibrates"), rows.where("calibrates")) if len(sizes) == 2 else (rows, rows)

    moments = _summed(fitted, lambda s, _: np.concatenate([[len(s)], s.sum(0), (s * s).sum(0)]))
    n, k = moments[0], len(NAMES)
    mean = moments[1 : k + 1] / n
    spread = np.sqrt(np.maximum(moments[k + 1 :] / n - mean * mean, 1e-12))

    def equations(stats: np.ndarray, mark: np.ndarray) -> np.ndarray:
        z = random_features((stats - mean) / spread)
        return np.concatenate([(z.T @ z).ravel(), z.T @ mark])

    sums, size = _summed(fitted, equations), FEATURES + 1
    left = sums[: size * size].reshape(size, size)
    weights = np.linalg.solve(left + RIDGE * n * np.eye(size) * (np.arange(size) < FEATURES), sums[size * size :])
    model = Model(mean, spread, weights, np.zeros(1), np.full(1, 0.5))

    def bins(stats: np.ndarray, mark: np.ndarray) -> np.ndarray:
        place = np.clip(((model.raw(stats) + 0.5) / 2 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(place, minlength=BINS), np.bincount(place, mark, BINS)])

    counts, ones = _summed(held, bins).reshape(2, BINS)
    some = np.nonzero(counts)[0]
    centres = (some + 0.5) / BINS * 2 - 0.5
    return Model(mean, spread, weights, centres, isotonic(ones[some] / counts[some], counts[some]))


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest non-decreasing values, by pooling neighbours that are out of order."""
    pools: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist()):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            (a, p, m), (b, q, n) = pools[-2:]
            pools[-2:] = [[(a * p + b * q) / (p + q), p + q, m + n]]
    return np.concatenate([np.full(int(n), v) for v, _, n in pools])


def score_column(model: Model | None, stats: Column) -> Column:
    """Calibrated score of a row's statistics."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(rows: pa.Array) -> pa.Array:
        return pa.array(model.score(rows.flatten().to_numpy().reshape(len(rows), len(NAMES))))

    return score(stats)
