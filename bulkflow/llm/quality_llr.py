"""Quality by a hashed n-gram log-likelihood ratio, with DataFrame functions only.

Tokens are runs of letters and runs of other signs.  Single tokens and pairs are hashed into
``BUCKETS``; trusted texts and the whole corpus each give a smoothed multinomial over them.  A
document's score is the mean over its n-grams of log(trusted / corpus), so length does not matter,
and a document is kept when it is at least ``THRESHOLD``.  Simple counts of words, symbols and
repeats are base rules in front of it.

The corpus counts cover every document.  The trusted texts are at most ``TRUSTED`` rows that are
marked good, taken by hash of the id, so that their ids can be broadcast; everything runs inside
the JVM, in one shuffle of counters.

Defined results: a null text is an empty one.  Texts without words fail the base rules; texts
without n-grams have score 0.  Without trusted rows every score is 0, so the base rules decide.
Rows with a null id are scored and counted, but never trusted.  Texts of any length are tokenised whole,
and equal texts get equal scores.  An empty table has no rows.  Only the id and the text are looked at,
so the names of other columns cannot clash.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import SPACE_CLASS

#: Hash buckets, weight of the smoothing count, least score, bound of the trusted sample.
BUCKETS, SMOOTHING, THRESHOLD, TRUSTED = 1 << 14, 1.0, -0.5, 20_000
# The symbols that are counted, white space, and the limits of the base rules.
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it in lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE_CLASS}]+"), lambda w: w != "")


def repeated_words(found: Column) -> Column:
    """How many words are in a three-word window that the text has twice or more."""

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def any_twice(h: Column) -> Column:
        return _bind(F.sort_array(h), lambda s: F.size(F.filter(s, lambda x, i: x == F.get(s, i - 1))) > 0)

    def places(h: Column) -> Column:
        """Starts of windows that come twice or more, ascending: equal hashes are neighbours once sorted."""
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            again = F.filter(s, lambda x, i: x["h"].eqNullSafe(F.get(s, i - 1)["h"]) | x["h"].eqNullSafe(F.get(s, i + 1)["h"]))
            return F.sort_array(F.transform(again, lambda x: x["i"]))

        return _bind(pairs, repeated)

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    def count(h: Column) -> Column:
        return F.when(any_twice(h), _bind(places(h), covered)).otherwise(F.lit(0).cast("long"))

    return F.when(F.size(found) >= 3, _bind(_bind(found, windows), count)).otherwise(F.lit(0).cast("long"))


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = F.coalesce(docs[text_col], F.lit(""))

    def without(signs: str) -> Column:
        return F.length(F.translate(F.col("text"), signs, ""))

    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE_CLASS}]"))
    counted = docs.select(docs[id_col].alias("doc_id"), text.alias("text")).select(
        "doc_id",
        "text",
        _bind(words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))).alias("w"),
        without(SPACES).cast("long").alias("word_chars"),
        (F.length("text") - without(SYMBOLS)).cast("long").alias("n_symbols"),
        _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    counted = counted.select("doc_id", "text", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def ngrams(text: Column) -> Column:
    """Bucket numbers of all tokens and all pairs of neighbours."""

    def hashed(t: Column) -> Column:
        single = F.transform(t, lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))
        pairs = F.transform(t, lambda x, i: F.when(i > 0, F.pmod(F.xxhash64(F.get(t, i - 1), x), F.lit(BUCKETS)).cast("int")))
        return F.concat(single, F.slice(pairs, 2, F.greatest(F.size(t) - 1, F.lit(0))))

    return _bind(F.regexp_extract_all(text, F.lit(rf"\p{{L}}+|[^\p{{L}}{SPACE_CLASS}]+"), F.lit(0)), hashed)


def learn_ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> list[float]:
    """log(trusted / corpus) of every bucket; all zero without trusted rows."""
    good = labels.where(F.col(label_col) == 1).select(labels[id_col].alias("doc_id")).where("doc_id is not null").distinct()
    trusted = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRUSTED).withColumn("good", F.lit(1))
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).where("text is not null")
    marked = texts.join(F.broadcast(trusted), "doc_id", "left")  # at most ``TRUSTED`` rows
    grams = marked.select("good", F.explode(ngrams(F.col("text"))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("corpus"), F.count("good").alias("good")).collect()
    corpus, target = [0] * BUCKETS, [0] * BUCKETS
    for bucket, c, g in counts:
        corpus[bucket], target[bucket] = c, g
    if not sum(target):
        return [0.0] * BUCKETS
    all_c, all_t = sum(corpus) + SMOOTHING * BUCKETS, sum(target) + SMOOTHING * BUCKETS
    return [math.log((t + SMOOTHING) / all_t) - math.log((c + SMOOTHING) / all_c) for t, c in zip(target, corpus)]


def ratio_column(ratios: list[float], text: Column) -> Column:
    """Mean log-likelihood ratio of a text's n-grams."""
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")  # a constant of ``BUCKETS`` numbers

    def mean(g: Column) -> Column:
        total = F.aggregate(g, F.lit(0.0), lambda s, b: s + F.get(table, b))
        return F.when(F.size(g) > 0, total / F.size(g)).otherwise(F.lit(0.0))

    return _bind(ngrams(text), mean)


def judge(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, ``ratio`` and ``kept`` for every row."""
    scored = base_counts(docs, id_col, text_col).withColumn("ratio", ratio_column(ratios, F.col("text"))).drop("text")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))
