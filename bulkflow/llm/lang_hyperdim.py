"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point.  A letter triple is the
product of the three vectors, the first rotated twice and the second once, so that order counts.
A document is the sum (bundle) of its triples, a language the sum of its documents, each scaled to
unit length so that long ones do not outweigh the rest.  A document gets the language with the
largest cosine.  Bundles are linear: the product with a language's vector is the sum of the
triples' products, which are computed once per triple and task; the length of a bundle is that of
its count vector, as products of random vectors are orthogonal but for noise of 1/sqrt(dimensions).

Anything but a letter is one boundary sign; only triples around a letter count.  Training sums are
vectors per language, added up in partitions, so what reaches the driver does not grow with the
documents; more than ``MOST_LANGUAGES`` languages are refused before any sum is made.

Defined results: a null or empty text, or one without letters, is ``und`` with score 0; so is every
text when there is nothing to learn from.  Equal cosines go to the first language by name.  Texts of any
length are counted whole, and equal texts get equal results.  An empty table has no rows.  Only the id,
the text and the language are looked at, so the names of other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import held_out, ship, text_slices

#: Length of the vectors, spread of the cosines in a score, triples a task remembers, text at once.
DIMENSIONS, SHARPNESS, REMEMBERED, CHARS_AT_ONCE = 2048, 20.0, 500_000, 1 << 19
#: Parts in which training sums are added before they reach the driver.
SUM_PARTS = 16
#: The bound of the languages: 16 kB each, times the parts, reach the driver.
MOST_LANGUAGES = 1024
UNKNOWN = "und"
_BITS = np.int64(21)


@dataclass(frozen=True)
class Profiles:
    """Unit vectors of the learnt languages, by name."""

    languages: tuple[str, ...]
    vectors: np.ndarray


class _Letters:
    """Vectors of code points and triples, made when first asked for; one per worker."""

    def __init__(self) -> None:
        self._vectors: dict[int, np.ndarray] = {}
        self.is_letter = np.zeros(0x110000, bool)
        for code in range(0x110000):
            self.is_letter[code] = chr(code).isalpha()

    def vector(self, code: int) -> np.ndarray:
        if code not in self._vectors:
            bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, DIMENSIONS, dtype=np.int8)
            self._vectors[code] = (2 * bits - 1).astype(np.int8)
        return self._vectors[code]

    def triples(self, packed: np.ndarray) -> np.ndarray:
        """Vectors of packed triples, one per row."""
        mask = np.int64((1 << 21) - 1)
        out = None
        for shift in (2, 1, 0):
            codes, place = np.unique(packed >> (_BITS * np.int64(shift)) & mask, return_inverse=True)
            rows = np.stack([np.roll(self.vector(c), shift) for c in codes.tolist()])[place]
            out = rows if out is None else out * rows
        return out.astype(np.float32)


_letters: list[_Letters] = []


def letters() -> _Letters:
    if not _letters:
        _letters.append(_Letters())
    return _letters[0]


def count_triples(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, packed triple, count), by text, for all triples around a letter."""
    is_letter = letters().is_letter
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\0\0".join(["", *lowered, ""]).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    codes = np.where(is_letter[codes], codes, 0)
    sizes = np.array([len(t) + 2 for t in lowered], np.int64)
    middle = np.nonzero(codes[1:-1])[0] + 1
    owner = np.searchsorted(np.cumsum(sizes), middle - 2, "right")
    # Few distinct letters: ranks make a triple and its text one integer.
    alphabet, rank = np.unique(codes, return_inverse=True)
    size = len(alphabet)
    key = ((owner * size + rank[middle - 1]) * size + rank[middle]) * size + rank[middle + 1]
    key, count = np.unique(key, return_counts=True)
    a, b, c = alphabet[key // size**2 % size], alphabet[key // size % size], alphabet[key % size]
    return key // size**3, (a << _BITS | b) << _BITS | c, count


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Profiles from the documents of the training fold that have a language."""
    ship(docs.sparkSession)
    train = docs.select(docs[text_col].alias("text"), docs[lang_col].alias("lang"), docs[id_col].alias("doc_id"))
    train = train.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")

    if train.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        weights: dict[str, dict[int, float]] = {}
        for batch in batches:
            languages, at = batch.column("lang").to_pylist(), 0
            for texts in text_slices(batch.column("text"), CHARS_AT_ONCE):
                names, number = np.unique(np.array(languages[at : at + len(texts)], object).astype(str), return_inverse=True)
                at += len(texts)
                owner, triple, count = count_triples(texts)
                if not len(owner):
                    continue
                share = count / np.sqrt(np.bincount(owner, count * count.astype(float), len(texts)))[owner]
                for n, name in enumerate(names.tolist()):
                    own = number[owner] == n
                    kinds, place = np.unique(triple[own], return_inverse=True)
                    held = weights.setdefault(name, {})
                    for k, w in zip(kinds.tolist(), np.bincount(place, share[own], len(kinds)).tolist()):
                        held[k] = held.get(k, 0.0) + w
                    if len(held) > REMEMBERED:
                        _bundle(sums, name, weights.pop(name))
        for name, held in weights.items():
            _bundle(sums, name, held)
        yield _sum_rows(sums)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, raw in zip(batch.column("lang").to_pylist(), batch.column("total").to_pylist()):
                sums[name] = sums.get(name, 0) + np.frombuffer(raw, np.float64)
        yield _sum_rows(sums)

    kind = "lang string, total binary"
    totals: dict[str, np.ndarray] = {}
    for row in train.mapInArrow(partial, kind).repartition(SUM_PARTS).mapInArrow(add_up, kind).collect():
        totals[row["lang"]] = totals.get(row["lang"], 0) + np.frombuffer(row["total"], np.float64)
    names = tuple(sorted(n for n, v in totals.items() if np.any(v)))
    vectors = np.array([totals[n] / np.linalg.norm(totals[n]) for n in names], np.float32).reshape(len(names), DIMENSIONS)
    return Profiles(names, vectors)


def _bundle(sums: dict[str, np.ndarray], name: str, weights: dict[int, float]) -> None:
    triples, share = np.fromiter(weights.keys(), np.int64), np.fromiter(weights.values(), np.float64)
    total = sums.get(name, np.zeros(DIMENSIONS))
    for at in range(0, len(triples), 2048):
        total = total + share[at : at + 2048] @ letters().triples(triples[at : at + 2048])
    sums[name] = total


def _sum_rows(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array([v.astype(np.float64).tobytes() for v in sums.values()], pa.binary())], ["lang", "total"]
    )


class _Scorer:
    """Products of triples with all profiles, remembered in a sorted table."""

    def __init__(self, profiles: Profiles) -> None:
        self.profiles = profiles
        self.known = np.zeros(0, np.int64)
        self.products = np.zeros((0, len(profiles.languages)), np.float32)

    def of(self, triples: np.ndarray) -> np.ndarray:
        kinds, place = np.unique(triples, return_inverse=True)
        new = kinds[~np.isin(kinds, self.known)]
        if len(new):
            made = [letters().triples(new[at : at + 2048]) @ self.profiles.vectors.T for at in range(0, len(new), 2048)]
            if len(self.known) > REMEMBERED:
                kinds_left = np.isin(self.known, kinds)
                self.known, self.products = self.known[kinds_left], self.products[kinds_left]
            known = np.concatenate([self.known, new])
            order = np.argsort(known)
            self.known, self.products = known[order], np.concatenate([self.products, *made])[order]
        return self.products[np.searchsorted(self.known, kinds)][place]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        count_of = len(self.profiles.languages)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        owner, triple, count = count_triples(texts)
        if not len(owner) or not count_of:
            return names, scores
        weighted = self.of(triple) * count[:, None]
        dots = np.stack([np.bincount(owner, weighted[:, k], len(texts)) for k in range(count_of)], 1)
        length = np.sqrt(np.bincount(owner, count * count.astype(float), len(texts)) * DIMENSIONS)
        some = np.nonzero(length)[0]
        cosine = dots[some] / length[some, None]
        best = cosine.argmax(1)
        sure = np.exp(SHARPNESS * (cosine - cosine.max(1, keepdims=True)))
        scores[some] = 1 / sure.sum(1)
        for n, b in zip(some.tolist(), best.tolist()):
            names[n] = self.profiles.languages[b]
        return names, scores


def predict_column(profiles: Profiles, text: Column) -> Column:
    """Struct (lang, score) for a text; the score is the softmax of the cosines for the winner."""
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _Scorer(profiles)
        for batch in batches:
            done = []
            for texts in text_slices(batch, CHARS_AT_ONCE):
                names, scores = scorer.predict(texts)
                done.append(pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], fields=list(kind)))
            yield pa.concat_arrays(done) if done else pa.array([], kind)

    return predict(F.coalesce(text, F.lit("")))
