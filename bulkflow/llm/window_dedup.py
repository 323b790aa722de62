"""Removal of word windows that occur more than once, behind a count-min prefilter.

Every window is entered into a count-min sketch through its anchor: of the 16-word grams in it, the one
with the least hash (the leftmost of equals).  Equal windows have equal anchors at equal places, so a
count of anchor places is never below the count of a window, and neighbouring windows share an anchor,
which makes the sketch a tenth of the size.

The sketch is never in one place.  An anchor belongs to one block of counters; each task sketches its
own anchors, the partial sketches of a block are merged in a task, which then answers for the anchors
that were sent to it: those with an estimate of two or more go back to their documents.  A task settles
what it sees twice itself, so a passage that a third of all documents share asks once per task.

The second pass reads the documents that got an anchor back, hashes the windows under these anchors and
groups them exactly: by two independent 64-bit hashes, made from two independent hashes of every word's
bytes.  Windows that a task sees twice are settled at once and only one of them goes on.  They are sorted
by hash and compared with their neighbours, so no group is held in memory.  What repeats goes back to
its document as runs of starts.

Texts are dealt out once, by buckets of documents, and that exchange serves both the second pass and the
removal.  There is one sketch pass, one listing pass and one removal, whatever the size of the corpus.

Defined results: a null or empty text has no words.  Texts shorter than a window keep all their words.
A very long text is worked through in overlapping pieces, none of its windows is left out.  Rows that
repeat as a whole repeat all their windows.  Rows with the same id but different texts, or with a null
id, are treated one by one.  An empty table has no rows.  Columns that are not asked for are left behind
before anything else, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bulkflow.llm.common import SLICE_CHARS, SPACE_CLASS, WORD, ids_and_texts, mix, ship, text_bytes

#: Sketch: rows, counters in a row of a block, and counters per anchor.
SKETCH_ROWS, BLOCK, CELLS_PER_ANCHOR = 2, 1 << 16, 4
#: Anchors or windows that a task gathers before it emits them.
GATHERED = 1 << 20
#: Characters of text in a bucket of documents, about.
BUCKET_CHARS = 1 << 22
#: Words up to this many bytes are hashed by blocks of eight, all words at once.
BLOCKWISE = 64

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE = np.uint64((1 << 26) - 1)
# Odd multipliers of the hashes of words (two) and of spans of words (three).
_WORD_BASES = (0x9E3779B97F4A7C15, 0xE7037ED1A0B428DB)
_BASES = (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)
_WORD = re.compile(WORD.encode())
_BLANK = re.compile(f"[{SPACE_CLASS}]".encode())
# The bytes of a block that belong to a word of so many bytes.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

def _power_tables(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i, modulo 2 ** 64."""
    if base not in _powers or len(_powers[base][0]) < size:
        size = max(size, 1 << 16) * 5 // 4
        tables = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers[base] = tuple(tables)
    return _powers[base]


def _span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A polynomial hash of values[start:end] for each span, all from one running sum."""
    power, inverse = _power_tables(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:], dtype=np.uint64)
    return (sums[ends] - sums[starts]) * inverse[starts]


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent hashes per word of all texts, and per text the number of its first word (one more at the end).

    The bytes go in by blocks of eight, each mixed into what came before, so that no pattern of bytes
    cancels out; words of one length up to eight bytes never have equal hashes.
    """
    space = _SPACE[flat]
    before = np.empty(len(flat) + 1, bool)
    before[1:] = space
    before[offsets] = True  # a text's start and end part words too
    starts = np.nonzero(before[:-1] & ~space)[0]
    after = np.append(space[1:], True)[: len(flat)]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    sizes = np.nonzero(after & ~space)[0] + 1 - starts
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    blocks = np.ndarray((len(flat) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from every place on
    hashes = [mix(sizes.astype(np.uint64) * np.uint64(base)) for base in _WORD_BASES]
    for at in range(0, BLOCKWISE, 8):
        more = np.nonzero(sizes > at)[0] if at else np.arange(len(sizes))
        if not len(more):
            break
        block = blocks[starts[more] + at] & _MASKS[np.minimum(sizes[more] - at, 8)]
        for h, base in zip(hashes, _WORD_BASES):
            h[more] = mix((h[more] + block) * np.uint64(base))
    for n in np.nonzero(sizes > BLOCKWISE)[0].tolist():
        word = flat[starts[n] : starts[n] + sizes[n]].tobytes()
        for h, base in zip(hashes, _WORD_BASES):
            h[n] = xxhash.xxh64_intdigest(word, base)
    return hashes[0], hashes[1], np.searchsorted(starts, offsets)


class Windows:
    """The windows of some texts: their anchors now, their hashes on demand.

    ``first_word`` says, for each text, which word of the whole text is its first one.
    """

    def __init__(self, flat: np.ndarray, offsets: np.ndarray, size: int, first_word: np.ndarray | None = None) -> None:
        self.size, gram = size, (size + 1) // 2 if size < 32 else 16
        self.words, self.others, self.first = word_hashes(flat, offsets)
        count = len(self.words)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        at = np.arange(max(0, count - size + 1))
        self.at = at[text[at] == text[at + size - 1]] if len(at) else at
        self.text = text[self.at]
        grams = np.arange(max(0, count - gram + 1))
        least = mix(_span_hashes(self.words, grams, grams + gram, _BASES[2])) & ~_PLACE | grams.astype(np.uint64)
        # The least of ``reach`` neighbours, by doubling.
        reach, have = size - gram + 1, 1
        while have < reach and len(least):
            step = min(have, reach - have)
            least = np.minimum(least[: len(least) - step], least[step:]) if len(least) > step else least[:0]
            have += step
        least = least[self.at]
        self.anchor = least & ~_PLACE
        place = (least & _PLACE).astype(np.int64)
        self.new_anchor = np.concatenate([[True], place[1:] != place[:-1]]) if len(place) else np.zeros(0, bool)
        shift = self.first[:-1] - (first_word if first_word is not None else 0)
        self.place = (place - shift[self.text]).astype(np.int32)
        self.start = (self.at - shift[self.text]).astype(np.int32)

    def hashes(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.at[which]
        one = _span_hashes(self.words, at, at + self.size, _BASES[0])
        two = _span_hashes(self.others, at, at + self.size, _BASES[1])
        return mix(one), mix(two)


def _text_parts(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in parts of about ``SLICE_CHARS`` bytes: (row of each text, bytes, offsets, number of each text's first word).

    A longer text comes in pieces of its own, cut between words; every window lies in one of them.
    """
    flat, offsets = text_bytes(texts)
    start, rows = 0, len(offsets) - 1
    while start < rows:
        if offsets[start + 1] - offsets[start] > SLICE_CHARS:
            for piece, first in _pieces(flat[offsets[start] : offsets[start + 1]], size):
                yield np.array([start]), piece, np.array([0, len(piece)]), np.array([first])
            start += 1
            continue
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE_CHARS, "right")) - 1)
        yield np.arange(start, end), flat[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start], np.zeros(end - start, np.int64)
        start = end


def _pieces(flat: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, int]]:
    """A long text's bytes in pieces, each with the first ``size - 1`` words of the next, and the number of its first word."""
    raw, at, first = flat.tobytes(), 0, 0
    while at < len(raw):
        blank = _BLANK.search(raw, at + SLICE_CHARS)
        cut = blank.start() if blank else len(raw)
        stop = cut
        for _ in range(size - 1):
            word = _WORD.search(raw, stop)
            if not word:
                break
            stop = word.end()
        yield flat[at:stop], first
        space = _SPACE[flat[at:cut]]
        first += int(np.count_nonzero(~space & np.concatenate([[True], space[:-1]])))
        at = cut


def _block_of(anchor: np.ndarray, blocks: int) -> np.ndarray:
    return mix(anchor + np.uint64(SKETCH_ROWS + 1)) % np.uint64(blocks)


def _cells(anchor: np.ndarray) -> np.ndarray:
    """The place of an anchor's counter in each row of its block: one row of the result per anchor."""
    return np.stack([mix(anchor + np.uint64(row + 1)) >> np.uint64(48) for row in range(SKETCH_ROWS)], 1).astype(np.uint16)


_ASKED = "block long, once binary, twice binary, marks binary, places binary"


def _sketched(size: int, blocks: int):
    """Rows (mark, text) to partial sketches by block, each with the owners of the anchors that ask for an answer.

    Owners of anchors seen twice here are settled; their rows have a block below zero and only pass through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            marks = batch.column("mark").to_numpy()
            for rows, flat, offsets, first in _text_parts(batch.column("text"), size):
                w = Windows(flat, offsets, size, first)
                new = w.new_anchor
                held.append((w.anchor[new], marks[rows[w.text[new]]], w.place[new]))
                if sum(len(x[0]) for x in held) > GATHERED:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        anchor, mark, place = (np.concatenate(x) for x in zip(*held))
        block = _block_of(anchor, blocks)
        order = np.lexsort((anchor, block))
        anchor, mark, place, block = anchor[order], mark[order], place[order], block[order]
        same = anchor[1:] == anchor[:-1]
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(anchor) else np.zeros(0, bool)
        begins = np.concatenate([[True], ~same]) if len(anchor) else np.zeros(0, bool)
        out: list[tuple] = []
        cells = _cells(anchor)
        cuts = np.nonzero(np.concatenate([[True], block[1:] != block[:-1]]))[0].tolist() if len(block) else []
        for a, b in zip(cuts, [*cuts[1:], len(block)]):
            once, twice = ~again[a:b], (again & begins)[a:b]
            out.append((int(block[a]), cells[a:b][once].tobytes(), cells[a:b][twice].tobytes(), mark[a:b][once].tobytes(), place[a:b][once].tobytes()))
        if again.any():
            # Dealt out by what was seen here, so that no block gets the owners of a common passage.
            key = -1 - int(mark[again].astype(np.int64).sum() % (1 << 40))
            out.append((key, b"", b"", mark[again].tobytes(), place[again].tobytes()))
        kinds = (pa.int64(), *[pa.binary()] * 4)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 5, kinds)], ["block", "once", "twice", "marks", "places"])

    return run


def _answered(buckets: int):
    """Sorted rows of partial sketches to (bucket, marks, places) of the anchors whose estimate is two or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, held = None, [], []

        def answer() -> None:
            counters = np.zeros((SKETCH_ROWS, BLOCK), np.uint8)
            pairs = [(_pairs(once), _pairs(twice)) for once, twice, _, _ in rows]
            for once, twice in pairs:
                for row, counter in enumerate(counters):
                    cell, n = np.unique(once[:, row], return_counts=True)
                    counter[cell] = np.minimum(counter[cell] + np.minimum(n, 2), 2)
                    counter[twice[:, row]] = 2
            for (once, _), (_, _, marks, places) in zip(pairs, rows):
                fits = np.all([counter[once[:, row]] > 1 for row, counter in enumerate(counters)], 0)
                if fits.any():
                    held.append((np.frombuffer(marks, np.int32)[fits], np.frombuffer(places, np.int32)[fits]))

        for batch in batches:
            for block, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "once", "twice", "marks", "places"))):
                if block < 0:
                    held.append((np.frombuffer(row[2], np.int32), np.frombuffer(row[3], np.int32)))
                else:
                    if block != now:
                        answer()
                        now, rows = block, []
                    rows.append(row)
                if sum(len(x[0]) for x in held) > GATHERED:
                    yield by_bucket(held)
                    held = []
        answer()
        if held:
            yield by_bucket(held)

    def by_bucket(held: list[tuple]) -> pa.RecordBatch:
        mark, place = (np.concatenate(x) for x in zip(*held))
        bucket = mark % buckets
        order = np.argsort(bucket, kind="stable")
        bucket, mark, place = bucket[order], mark[order], place[order]
        cuts = np.nonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[0].tolist()
        parts = list(zip(cuts, [*cuts[1:], len(bucket)]))
        arrays = [pa.array(bucket[cuts].astype(np.int32)), *(pa.array([x[a:b].tobytes() for a, b in parts], pa.binary()) for x in (mark, place))]
        return pa.RecordBatch.from_arrays(arrays, ["bucket", "marks", "places"])

    return run


def _pairs(cells: bytes) -> np.ndarray:
    return np.frombuffer(cells, np.uint16).reshape(-1, SKETCH_ROWS)


def estimated_repeated(texts: DataFrame, size: int, blocks: int, buckets: int) -> DataFrame:
    """(bucket, marks, places): the anchors of ``texts`` (mark, text, ...) that may occur more than once.

    An anchor is named by its document's mark and the number of its first word.  Where two documents
    share a mark, an anchor of one may be kept for both, which only costs time.
    """
    asked = texts.select("mark", "text").mapInArrow(_sketched(size, blocks), _ASKED)
    return asked.repartition("block").sortWithinPartitions("block").mapInArrow(_answered(buckets), "bucket int, marks binary, places binary")


def _listed(size: int, owner_kind: pa.DataType):
    """A bucket's texts and its anchors to its windows: one row per window seen once here, one for all equal ones, and runs of known repeats."""
    names = ["h1", "h2", "doc_id", "mark", "start", "run"]
    kinds = [pa.int64(), pa.int64(), owner_kind, pa.int32(), pa.int32(), pa.int32()]

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        held = []
        if texts.num_rows and answers.num_rows:
            marks, places = (np.concatenate([np.frombuffer(x, np.int32) for x in answers.column(c).to_pylist()]) for c in ("marks", "places"))
            asked = np.unique(marks.astype(np.int64) << 32 | places.astype(np.int64))
            known = np.unique(marks)
            wanted = texts.filter(pa.array(np.isin(texts.column("mark").to_numpy(), known)))
            for batch in wanted.combine_chunks().to_batches():
                mark = batch.column("mark").to_numpy()
                for rows, flat, offsets, first in _text_parts(batch.column("text"), size):
                    w = Windows(flat, offsets, size, first)
                    row = rows[w.text]
                    fits = np.isin(mark[row].astype(np.int64) << 32 | w.place.astype(np.int64), asked)
                    if fits.any():
                        owners = batch.select(["doc_id", "mark"]).take(pa.array(row[fits]))
                        held.append((*w.hashes(fits), owners, w.start[fits], row[fits]))
        return settled(held) if held else pa.Table.from_arrays([pa.array([], k) for k in kinds], names)

    def settled(held: list[tuple]) -> pa.Table:
        h1, h2, start, text = (np.concatenate([x[n] for x in held]) for n in (0, 1, 3, 4))
        owner = pa.Table.from_batches([x[2] for x in held])
        order = np.lexsort((h2, h1))
        same = np.concatenate([[False], (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])])
        again = np.zeros(len(h1), bool)
        again[order] = same | np.append(same[1:], False)
        first = np.zeros(len(h1), bool)
        first[order] = ~same
        # Runs of known repeats: neighbours in one piece of one text, in reading order.
        part = np.repeat(np.arange(len(held)), [len(x[0]) for x in held])
        known = np.nonzero(again)[0]
        breaks = np.ones(len(known), bool)
        if len(known) > 1:
            breaks[1:] = (np.diff(known) != 1) | (np.diff(start[known]) != 1) | (np.diff(part[known]) != 0) | (np.diff(text[known]) != 0)
        counts = np.diff(np.append(np.nonzero(breaks)[0], len(known)))
        which = np.concatenate([np.nonzero(first)[0], known[breaks]])
        length = np.concatenate([np.zeros(int(first.sum()), np.int32), counts.astype(np.int32)])
        owners = owner.take(pa.array(which))
        columns = [pa.array(h1[which].view(np.int64)), pa.array(h2[which].view(np.int64)), *owners.columns, pa.array(start[which]), pa.array(length)]
        return pa.Table.from_arrays(columns, names)

    return run


def repeated_runs(texts: DataFrame, size: int, blocks: int, buckets: int) -> DataFrame:
    """(bucket, owners, counts, runs): starts of repeated windows, as binary pairs of 32-bit start and count.

    ``texts`` has (bucket, doc_id, mark, text): ``mark`` is a hash that tells rows with the same id apart,
    and ``bucket`` is the mark modulo ``buckets``.  A document may have runs in several rows here.
    """
    kind = dict(texts.dtypes)["doc_id"]
    answers = estimated_repeated(texts, size, blocks, buckets)
    listed = _listed(size, to_arrow_type(texts.schema["doc_id"].dataType))
    found = texts.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(listed, f"h1 long, h2 long, doc_id {kind}, mark int, start int, run int")
    # Settled runs come last, so that the windows of a hash are neighbours, also across batches.
    grouped = found.repartition("h1").sortWithinPartitions("h1", "h2", "run")
    return grouped.mapInArrow(_exactly_repeated(buckets), _PACKED.format(kind))


_PACKED = "bucket int, owners array<struct<doc_id:{},mark:int>>, counts array<int>, runs binary"


def _exactly_repeated(buckets: int):
    """Compare sorted windows with their neighbours; gather what repeats by buckets of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, matched, held = None, False, []

        def emit(rows: pa.Table, repeats: np.ndarray) -> None:
            keep = np.nonzero(repeats | (rows.column("run").to_numpy() > 0))[0]
            if len(keep):
                held.append(rows.select(["doc_id", "mark", "start", "run"]).take(pa.array(keep)))

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            if last is not None:
                rows = pa.concat_tables([last, rows])
            repeats = _equal_neighbours(rows)
            repeats[0] |= matched
            emit(rows.slice(0, rows.num_rows - 1), repeats[:-1])
            last, matched = rows.slice(rows.num_rows - 1), bool(repeats[-1])
            if sum(t.num_rows for t in held) > GATHERED:
                yield _by_bucket(held, buckets)
                held = []
        if last is not None:
            emit(last, np.array([matched]))
        if held:
            yield _by_bucket(held, buckets)

    return run


def _equal_neighbours(rows: pa.Table) -> np.ndarray:
    """Whether a window row equals the one before or behind it; settled runs come behind the windows of their hash and do not count."""
    h1, h2, run = (rows.column(c).to_numpy() for c in ("h1", "h2", "run"))
    plain = np.nonzero(run == 0)[0]
    same = (h1[plain][1:] == h1[plain][:-1]) & (h2[plain][1:] == h2[plain][:-1])
    out = np.zeros(len(h1), bool)
    out[plain[1:][same]] = True
    out[plain[:-1][same]] = True
    return out


def _by_bucket(held: list[pa.Table], buckets: int) -> pa.RecordBatch:
    """One row per bucket of documents: the owners, how many runs each has, and the runs."""
    rows = pa.concat_tables(held).combine_chunks()
    bucket = rows.column("mark").to_numpy() % buckets
    rows = rows.append_column("bucket", pa.array(bucket, pa.int32()))
    rows = rows.sort_by([(c, "ascending") for c in ("bucket", "mark", "doc_id", "start")])
    runs = np.stack([rows.column("start").to_numpy(), np.maximum(rows.column("run").to_numpy(), 1)], 1).astype(np.int32)
    new = np.ones(rows.num_rows, bool)
    mark = rows.column("mark").to_numpy()
    ids = pa.array(rows.column("doc_id").to_pylist()).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    new[1:] = (np.diff(mark) != 0) | (np.diff(ids) != 0)
    begins = np.nonzero(new)[0]
    parts = [_joined(runs[x:y]) for x, y in zip(begins.tolist(), [*begins[1:].tolist(), len(runs)])]
    bucket = rows.column("bucket").to_numpy()[begins]
    cuts = np.nonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))[0].tolist()
    owners = rows.select(["doc_id", "mark"]).take(pa.array(begins)).to_pylist()
    out = {"bucket": [], "owners": [], "counts": [], "runs": []}
    for x, y in zip(cuts, [*cuts[1:], len(bucket)]):
        out["bucket"].append(int(bucket[x]))
        out["owners"].append(owners[x:y])
        out["counts"].append([len(r) for r in parts[x:y]])
        out["runs"].append(np.concatenate(parts[x:y]).tobytes())
    owner = pa.struct([rows.schema.field("doc_id"), ("mark", pa.int32())])
    kinds = {"bucket": pa.int32(), "owners": pa.list_(owner), "counts": pa.list_(pa.int32()), "runs": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(out[c], k) for c, k in kinds.items()], list(kinds))


def _joined(runs: np.ndarray) -> np.ndarray:
    """Sorted runs of starts with neighbours and overlaps made one."""
    ends = np.maximum.accumulate(runs[:, 0] + runs[:, 1])
    new = np.concatenate([[True], runs[1:, 0] > ends[:-1]])
    begins = runs[new, 0]
    stops = np.append(ends[:-1][new[1:]], ends[-1])
    return np.stack([begins, stops - begins], 1).astype(np.int32)


def without_repeats(text: str, runs: np.ndarray | None, size: int) -> tuple[int, int, str]:
    """Number of words, number of removed ones, and the rest joined by one space."""
    words = _WORD.findall(text.encode())
    if runs is None:
        return len(words), 0, b" ".join(words).decode()
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0], 1)
    np.add.at(edges, np.minimum(runs[:, 0] + runs[:, 1] + size - 1, len(words)), -1)
    covered = np.cumsum(edges[:-1]) > 0
    kept = [w for w, c in zip(words, covered.tolist()) if not c]
    return len(words), len(words) - len(kept), b" ".join(kept).decode()


def remove_repeats(docs: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every word in a window that also starts elsewhere is gone."""
    ship(docs.sparkSession)
    texts = ids_and_texts(docs, id_col, text_col).withColumn("mark", F.hash("doc_id", "text"))
    chars = texts.select(F.sum(F.length("text"))).first()[0] or 0
    # About six characters a word and an anchor every ten words; both numbers only set the cost.
    blocks = 1 + chars // 60 * CELLS_PER_ANCHOR // BLOCK
    buckets = min(1 + chars // BUCKET_CHARS, (1 << 31) - 1)
    dealt = texts.select(F.pmod("mark", F.lit(buckets)).cast("int").alias("bucket"), "doc_id", "mark", "text")
    runs = repeated_runs(dealt, size, blocks, buckets)
    kind = dict(texts.dtypes)["doc_id"]
    finished = _finished(size, to_arrow_type(texts.schema["doc_id"].dataType))
    return dealt.groupBy("bucket").cogroup(runs.groupBy("bucket")).applyInArrow(finished, f"doc_id {kind}, n_words long, n_removed long, kept string")


def _finished(size: int, owner_kind: pa.DataType):
    """A bucket's texts without the words under its runs."""
    names, kinds = ["doc_id", "n_words", "n_removed", "kept"], [owner_kind, pa.int64(), pa.int64(), pa.string()]

    def run(texts: pa.Table, runs: pa.Table) -> pa.Table:
        known: dict[tuple, list[np.ndarray]] = {}
        for owners, counts, packed in zip(*(runs.column(c).to_pylist() for c in ("owners", "counts", "runs"))):
            starts = np.frombuffer(packed, np.int32).reshape(-1, 2)
            ends = np.cumsum(counts).tolist()
            for owner, a, b in zip(owners, [0, *ends], ends):
                known.setdefault((owner["doc_id"], owner["mark"]), []).append(starts[a:b])
        done = []
        for batch in texts.select(["doc_id", "mark", "text"]).to_batches(max_chunksize=500):
            for doc_id, mark, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = known.get((doc_id, mark))
                done.append((doc_id, *without_repeats(text, np.concatenate(found) if found else None, size)))
        return pa.Table.from_arrays([pa.array([x[n] for x in done], k) for n, k in enumerate(kinds)], names)

    return run
