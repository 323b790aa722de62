"""Context-triggered piecewise hashing of texts and the likeness of such fingerprints.

A rolling hash over the last seven bytes sets a boundary wherever it meets the block size, so
boundaries depend on nearby content only and move with it.  Each chunk between boundaries gives
one character, from a polynomial hash of all its bytes.  A fingerprint is ``size:chunks:coarser``:
the block size, the chunks' characters, and those for twice the block size.  The block size is the
smallest 3 * 2**k that gives at most ``LENGTH`` chunks, so every byte counts and nothing is cut off.

Two fingerprints are compared where they share a block size (equal sizes, or one twice the other):
1 - distance / (sum of lengths), with insertions and deletions at cost 1, and 0 unless they share a
run of a few chunks, which unrelated texts hardly ever do.

Defined results: a null text is an empty one, whose fingerprint is ``3::``.  Equal fingerprints have
likeness 1, so two empty texts do; an empty and any other text have 0.  Texts of any length are hashed
whole.  Repeated rows follow each other.  An empty table has no rows.  Columns that are not asked for
are left behind before anything else, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import ids_and_texts, mix, ship

# The smallest block, the context of a boundary, the characters of a fingerprint.
SMALLEST, CONTEXT, LENGTH = 3, 7, 64
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
# Odd multipliers of the rolling hash and of the chunk hash.
_ROLL, _CHUNK = 0x5BD1E995, 0x9E3779B97F4A7C15
_tables: dict[str, np.ndarray] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _tables or len(_tables["up"]) < size:
        size = max(1 << 16, size * 5 // 4)
        for name, base in (("up", _CHUNK), ("down", pow(_CHUNK, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=np.uint64)
    return _tables["up"], _tables["down"]


def fingerprint(text: str) -> str:
    """``size:chunks:coarser`` of a whole text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return f"{SMALLEST}::"
    wide = raw.astype(np.uint32) + np.uint32(1)
    roll = np.zeros(len(raw), np.uint32)
    for back in range(min(CONTEXT, len(raw))):
        roll[back:] += wide[: len(raw) - back] * np.uint32(pow(_ROLL, back + 1, 1 << 32))
    roll ^= roll >> np.uint32(15)
    size = SMALLEST
    while size * LENGTH < len(raw):
        size *= 2
    # Boundaries of a block size include those of its double, so start low and thin out.
    size = max(SMALLEST, size // 4)
    ends = np.nonzero(roll % np.uint32(size) == size - 1)[0]
    while len(ends) >= LENGTH:
        size *= 2
        ends = ends[roll[ends] % np.uint32(size) == size - 1]
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(wide * up[: len(raw)], out=sums[1:], dtype=np.uint64)
    coarse = ends[roll[ends] % np.uint32(2 * size) == 2 * size - 1]
    return f"{size}:{_characters(sums, down, ends, len(raw))}:{_characters(sums, down, coarse, len(raw))}"


def _characters(sums: np.ndarray, down: np.ndarray, ends: np.ndarray, length: int) -> str:
    cuts = np.concatenate([[0], ends + 1, [length]])
    if len(cuts) > 1 and cuts[-1] == cuts[-2]:
        cuts = cuts[:-1]
    starts, stops = cuts[:-1], cuts[1:]
    h = mix((sums[stops] - sums[starts]) * down[starts])
    return ALPHABET[h >> np.uint64(58)].tobytes().decode()


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    size_a, fine_a, coarse_a = a.split(":")
    size_b, fine_b, coarse_b = b.split(":")
    size_a, size_b = int(size_a), int(size_b)
    if size_a == size_b:
        return max(_alike(fine_a, fine_b), _alike(coarse_a, coarse_b))
    if size_a == 2 * size_b:
        return _alike(fine_a, coarse_b)
    if size_b == 2 * size_a:
        return _alike(coarse_a, fine_b)
    return 0.0


def _alike(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    shorter = min(len(a), len(b))
    run = min(shorter, 1 if shorter < 4 else 2 if shorter <= 8 else 3 if shorter <= 16 else 4)
    if {a[n : n + run] for n in range(len(a) - run + 1)}.isdisjoint(b[n : n + run] for n in range(len(b) - run + 1)):
        return 0.0
    return 2 * _common(a, b) / (len(a) + len(b))


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence: the edit distance is len(a) + len(b) - 2 times that.

    Bit-parallel: one row of the usual table is one integer.
    """
    where: dict[str, int] = {}
    for n, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << n
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def fingerprint_column(text: Column) -> Column:
    """Fingerprint of a text."""

    @F.arrow_udf("string")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t.as_py()) for t in batch], pa.string())

    return prints(F.coalesce(text, F.lit("")))


#: The most ranges of ids there can be, and the cuts that one step of the search looks at.
MAX_RANGES, SEARCH = 1 << 15, 1 << 8


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The edited text is a text whose second half (rounded down) is replaced by the beginning of the
    next document by descending id; the first one follows the last.  Rows are dealt out by ranges
    of the id, sorted, and streamed with one row of lookahead; each range also gets the first row
    of the range behind it.  Rows with one id follow each other by hash of the text, rows with a
    null id come last.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = ids_and_texts(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    ranges = min(ranges or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_RANGES)
    cuts = _cuts(texts, ranges)
    ordered = texts.withColumn("range", F.coalesce(_range_of(F.col("doc_id"), cuts), F.lit(len(cuts) + 1)))
    order = (F.col("doc_id").desc_nulls_last(), F.col("hash"))
    # The first row of every range that has rows: at most ``MAX_RANGES`` + 1 of them.
    first = F.max_by(F.struct("doc_id", "hash"), F.struct(F.col("doc_id"), -F.col("hash").cast("decimal(20)")))
    heads = ordered.groupBy("range").agg(first.alias("first")).orderBy("range").collect()
    if not heads:
        return _nothing(texts)
    lends = [(h["range"], heads[n - 1]["range"], h["first"]["doc_id"], h["first"]["hash"]) for n, h in enumerate(heads)]
    kind = dict(texts.dtypes)["doc_id"]
    lends = spark.createDataFrame(lends, f"range int, to_range int, head_id {kind}, head_hash long")
    own = ordered.select("doc_id", "text", "hash", F.col("range").alias("target"), F.lit(False).alias("lent"))
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash"))
    lent = ordered.join(F.broadcast(lends), "range").where(is_head)
    lent = lent.select("doc_id", "text", "hash", F.col("to_range").alias("target"), F.lit(True).alias("lent"))
    # A range is a partition: its number says which, so none is empty while another holds two.
    dealt = own.union(lent).repartitionById(len(cuts) + 2, "target").sortWithinPartitions("target", "lent", *order)
    return dealt.select("target", "lent", "doc_id", "text").mapInArrow(_compare, _COMPARED.format(kind))


_COMPARED = "doc_id {}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _nothing(texts: DataFrame) -> DataFrame:
    kind = dict(texts.dtypes)["doc_id"]
    return texts.sparkSession.createDataFrame([], _COMPARED.format(kind))


def _cuts(texts: DataFrame, ranges: int) -> list:
    """Ids that part the table into about equal ranges, descending; from an approximate quantile sketch."""
    shares = [n / ranges for n in range(1, ranges)]
    found = texts.agg(F.percentile_approx("doc_id", shares or [0.5], max(10_000, 20 * ranges))).first()[0] if shares else []
    return sorted(set(found or []), reverse=True)


def _range_of(doc_id: Column, cuts: list) -> Column:
    """Number of cuts that are not below the id, by a search in two steps; null for a null id."""
    if not cuts:
        return F.when(doc_id.isNotNull(), F.lit(0))
    groups = [cuts[k : k + SEARCH] for k in range(0, len(cuts), SEARCH)]

    def not_below(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c >= doc_id))

    # Groups whose last (least) cut is not below the id count as a whole; the next one is looked into.
    whole = not_below(F.array(*[F.lit(g[-1]) for g in groups]))
    inside = F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), whole)
    return F.when(doc_id.isNotNull(), F.least(whole * SEARCH, F.lit(len(cuts))) + F.coalesce(not_below(inside), F.lit(0)))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, the lent row behind a range's own."""
    last, out, size = None, [], 0

    def finished(now: tuple, following: tuple) -> tuple:
        (_, doc_id, text, mark), (_, _, next_text, next_mark) = now, following
        half = len(text) // 2
        edited = text[: len(text) - half] + next_text[:half]
        edited_mark = fingerprint(edited)
        return doc_id, len(text), edited, mark, edited_mark, likeness(mark, edited_mark), likeness(mark, next_mark)

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256).to_pydict()
            for target, lent, doc_id, text in zip(part["target"], part["lent"], part["doc_id"], part["text"]):
                now = (target, doc_id, text, fingerprint(text))
                if last is not None and last[0] == target:
                    out.append(finished(last, now))
                    size += len(out[-1][2])
                last = None if lent else now
                if size > 1 << 20:
                    yield _rows(out)
                    out, size = [], 0
    if out:
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
