"""SimHash near-duplicates, with candidates from pigeonring filtering.

A fingerprint has ``64 * words`` bits, laid out as a ring of ``segments`` nearly equal pieces.
When two fingerprints differ in at most ``limit`` bits, there is a piece from which every chain of
l consecutive pieces holds at most ``l * limit / segments`` of the differences.  So a fingerprint
is put under the bits of each chain of ``depth`` pieces, and also under every change of these bits
that keeps within the chain's proportional budgets; two linked fingerprints then share a key.  A
change is listed on one side only (where its first changed bit is 1), which halves the rows.  The
chain grows with the table, so that a key's group stays small whatever the number of documents.

Equal fingerprints are one class from the start.  In a key's group all pairs are checked in full,
but only a spanning forest of the links goes on, so that groups of near copies do not make a
quadratic number of rows.  Members of one star are already connected and are not compared again.

A group of more than ``GROUP_ROWS`` rows is not held by a task: its rows stream past a few pivots and
go on as rows.  What the pivots connect is settled; the rows outside the group's largest component
are then dealt out in blocks against blocks of the whole group, and each pair of blocks is compared in
a task of its own.  So memory is bounded whatever the group, and no pair is left out.

Defined results: a null text is an empty one; a text without words has the fingerprint zero and is
linked like any other; fewer words than a shingle are one shingle.  Rows with the same id count as
one document.  A null id never becomes a component's name; rows with a null id get the component
of their fingerprint's class, which is null when all of its ids are.  An empty table has no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import WORD, ids_and_texts, mix, ship, text_slices
from bulkflow.llm.components import components, durable, few_tasks

#: Groups up to this size are compared by offsets, larger ones as matrices of at most this many cells.
SMALL_GROUP, MATRIX_CELLS = 32, 1 << 20
#: Rows of a key that one task compares, pivots of a larger group, and rows of its blocks.
GROUP_ROWS, PIVOTS, BLOCK_ROWS = 1 << 16, 64, 1 << 13
#: A chain is long enough when a key has about this many fingerprints.
KEY_MEMBERS = 1024
_WORD = re.compile(WORD.encode())


def fingerprint(text: str, shingle: int, words: int = 1, seed: int = 42) -> np.ndarray:
    """SimHash of a text: a bit is 1 when it is set in over half of the shingles' hashes."""
    found = _WORD.findall(text.encode().lower())  # bytes: only A-Z change
    if not found:
        return np.zeros(words, np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= shingle:
        hashes = [digest(joined, seed)]
    else:
        starts = list(accumulate(map(len, found), lambda at, size: at + size + 1, initial=0))
        hashes = [digest(joined[a : b - 1], seed) for a, b in zip(starts, starts[shingle:])]
    h = np.array(hashes, np.uint64)
    out = np.empty(words, np.uint64)
    for k in range(words):
        bits = mix(h + np.uint64(k)) if k else h
        counts = np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
        out[k] = np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0]
    return out


def fingerprint_columns(words: int) -> list[str]:
    return [f"f{k}" for k in range(words)]


def fingerprints(docs: DataFrame, shingle: int, words: int = 1, id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None) -> DataFrame:
    """(doc_id, f0, f1, ...): 64 bits in each column; with ``mark``, a long that goes along, also (mark)."""
    ship(docs.sparkSession)
    texts = ids_and_texts(docs, id_col, text_col, *([] if mark is None else [mark.alias("mark")]))
    columns = fingerprint_columns(words)
    before = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle, words) for part in text_slices(batch.column("text")) for t in part]
            f = np.array(found, np.uint64).reshape(-1, words).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in before), *(pa.array(f[:, k]) for k in range(words))], [*before, *columns])

    kinds = dict(texts.dtypes)
    return texts.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in before), *(f"{c} long" for c in columns)]))


class Ring:
    """The pieces of a fingerprint and the budgets of their chains."""

    def __init__(self, words: int, limit: int, segments: int, depth: int) -> None:
        bits = 64 * words
        if not 0 <= limit < segments <= bits or not 1 <= depth <= segments:
            raise ValueError("needs limit < segments <= bits and a depth of 1 to segments")
        cuts = [bits * n // segments for n in range(segments + 1)]
        self.words, self.limit, self.segments, self.depth = words, limit, segments, depth
        self.pieces = [(a, b - a) for a, b in zip(cuts, cuts[1:])]

    def key_bits(self) -> int:
        return sum(sorted(size for _, size in self.pieces)[: self.depth])

    def keys(self, f: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """For each start and allowed change: the rows that list it, their keys, and whether it is a change."""
        for start in range(self.segments):
            chain = [self.pieces[(start + n) % self.segments] for n in range(self.depth)]
            plain = np.zeros(len(f), np.uint64)
            for at, size in chain:
                plain = plain << np.uint64(size) | self._bits(f, at, size)
            for change in self._changes([size for _, size in chain]):
                top = np.uint64(max(change.bit_length() - 1, 0))
                rows = np.nonzero(plain >> top & np.uint64(1))[0] if change else np.arange(len(f))
                key = mix((plain[rows] ^ np.uint64(change)) * np.uint64(self.segments) + np.uint64(start))
                yield rows, key, change != 0

    def _bits(self, f: np.ndarray, at: int, size: int) -> np.ndarray:
        word, shift = divmod(at, 64)
        out = f[:, word] >> np.uint64(shift)
        if shift + size > 64:
            out = out | f[:, word + 1] << np.uint64(64 - shift)
        return out & np.uint64((1 << size) - 1)

    def _changes(self, sizes: list[int]) -> list[int]:
        """All bit changes of a chain whose cumulative counts keep within l * limit / segments."""
        found = [(0, 0)]
        for n, size in enumerate(sizes, 1):
            budget = n * self.limit // self.segments
            flips = [(0, 0)]
            for used in range(1, budget + 1):
                flips += [(m | 1 << b, used) for m, u in flips if u == used - 1 for b in range(m.bit_length(), size)]
            found = [(m << size | x, u + y) for m, u in found for x, y in flips if u + y <= budget]
        return [m for m, _ in found]


def links(classes: DataFrame, limit: int, segments: int, words: int = 1, depth: int | None = None) -> DataFrame:
    """Edges (a, b) that connect all classes (node, f0, ...) within ``limit`` bits.

    A task gives each of its nodes at most one edge, to the smallest node that links lead to.
    """
    ship(classes.sparkSession)
    columns = fingerprint_columns(words)
    if depth is None:
        size, depth = classes.count(), min(2, segments)
        while depth < min(segments, 4) and size >> Ring(words, limit, segments, depth).key_bits() > KEY_MEMBERS:
            depth += 1
    ring = Ring(words, limit, segments, depth)

    def list_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 5000):
                part = batch.slice(at, 5000)
                f = _matrix(part, columns)
                node = part.column("node").to_numpy()
                rows, keys, changed = zip(*ring.keys(f))
                rows = np.concatenate(rows)
                changed = np.repeat(np.array(changed), [len(k) for k in keys])
                arrays = [np.concatenate(keys).view(np.int64), changed, node[rows], *(f[rows, k].view(np.int64) for k in range(words))]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["key", "changed", "node", *columns])

    group_rows = GROUP_ROWS

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = None
        for large, key, plain, node, f in _whole_groups(batches, columns, group_rows):
            if not large:
                yield edges(*_links_of(key, plain, node, f, limit))
                continue
            if pivots is None or pivots[0] != key[0]:
                some = np.nonzero(plain)[0][:PIVOTS]  # plain rows come first
                pivots = (key[0], node[some], f[some])
            a, b = np.nonzero(_differing(pivots[2][:, None], f[None]) <= limit)
            yield edges(*_forest(pivots[1][a], node[b]))
            arrays = [pa.array(node), pa.nulls(len(node), pa.int64()), pa.array(key), pa.array(plain), *(pa.array(f[:, k].view(np.int64)) for k in range(words))]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "key", "plain", *columns])

    def edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        empty = [pa.nulls(len(a), t) for t in (pa.int64(), pa.bool_(), *[pa.int64()] * words)]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *empty], ["a", "b", "key", "plain", *columns])

    fields = ", ".join(f"{c} long" for c in columns)
    keyed = classes.select("node", *columns).mapInArrow(list_keys, f"key long, changed boolean, node long, {fields}")
    grouped = keyed.repartition("key").sortWithinPartitions("key", "changed")
    found = durable(grouped.mapInArrow(link, f"a long, b long, key long, plain boolean, {fields}"))
    linked = found.where("b is not null").select("a", "b").distinct()
    large = found.where("b is null")
    if large.isEmpty():
        return linked
    return linked.union(_links_between_blocks(large.select("key", F.col("a").alias("node"), "plain", *columns), linked, limit, columns))


def _links_between_blocks(rows: DataFrame, linked: DataFrame, limit: int, columns: list[str]) -> DataFrame:
    """Edges (a, b) between the components of large groups (key, node, plain, f0, ...), given the edges so far."""
    roots = components(linked).select("node", "root")
    placed = durable(rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("whole"))
    main = main.select("key", F.col("most.root").alias("main"), "whole", (F.col("whole") - F.col("most.n")).alias("rest"))
    known = placed.join(durable(main.where("rest > 0")), "key")

    def blocks(n: str) -> Column:
        return F.ceil(F.col(n) / BLOCK_ROWS).cast("int")

    def dealt(side: DataFrame, is_rest: bool, own: str, others: str) -> DataFrame:
        mine = F.pmod(F.xxhash64("node"), blocks(own)).cast("int").alias("mine")
        out = side.select("key", "node", "plain", "root", *columns, mine, F.explode(F.sequence(F.lit(0), blocks(others) - 1)).alias("other"))
        left, right = ("mine", "other") if is_rest else ("other", "mine")
        return out.select("key", F.col(left).alias("i"), F.col(right).alias("j"), F.lit(is_rest).alias("rest"), "plain", "root", *columns)

    both = dealt(known.where("root <> main"), True, "rest", "whole").union(dealt(known, False, "whole", "rest"))
    ordered = both.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", F.desc("rest"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")], 1)
            cuts = [0, *(np.nonzero((names[1:] != names[:-1]).any(1))[0] + 1).tolist(), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b:
                    if tuple(names[a]) != now and held:
                        yield compared(held)
                        held = []
                    now = tuple(names[a])
                    held.append(batch.slice(a, b - a))
        if held:
            yield compared(held)

    def compared(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()
        batch = table[0] if table else held[0]
        rest, plain = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rest", "plain"))
        root, f = batch.column("root").to_numpy(), _matrix(batch, columns)
        n = int(rest.sum())
        step, found = max(1, MATRIX_CELLS // max(1, len(root) - n)), [(root[:0], root[:0])]
        for at in range(0, n, step):
            own = slice(at, min(n, at + step))
            near = (_differing(f[own, None], f[None, n:]) <= limit) & (plain[own, None] | plain[None, n:]) & (root[own, None] != root[None, n:])
            a, b = np.nonzero(near)
            found.append(_forest(root[own][a], root[n:][b]))
        a, b = _forest(*(np.concatenate(x) for x in zip(*found)))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return ordered.mapInArrow(compare, "a long, b long").distinct()


def _matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy() for c in columns], 1).view(np.uint64)


def _whole_groups(batches: Iterator[pa.RecordBatch], columns: list[str], group_rows: int) -> Iterator[tuple]:
    """Sorted batches again, as (large, key, plain, node, f), cut so that no key's group is torn.

    A group of more than ``group_rows`` rows comes alone, marked as large, in several parts.
    """
    kept: list[tuple] = []  # rows of the last key seen, or also of keys before it
    large = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = (batch.column("key").to_numpy(), ~batch.column("changed").to_numpy(zero_copy_only=False), batch.column("node").to_numpy(), _matrix(batch, columns))
        if large is not None:
            end = int(np.searchsorted(now[0], large, "right"))
            if end:
                yield (True, *(x[:end] for x in now))
            if end == len(now[0]):
                continue
            large, now = None, tuple(x[end:] for x in now)
        cut = int(np.searchsorted(now[0], now[0][-1]))
        if kept and (cut or kept[-1][0][-1] != now[0][0]):
            yield (False, *(np.concatenate(x) for x in zip(*kept, tuple(x[:cut] for x in now))))
            kept = []
        elif cut:
            yield (False, *(x[:cut] for x in now))
        kept.append(tuple(x[cut:] for x in now))
        if sum(len(x[0]) for x in kept) > group_rows:
            large = now[0][-1]
            yield (True, *(np.concatenate(x) for x in zip(*kept)))
            kept = []
    if kept:
        yield (False, *(np.concatenate(x) for x in zip(*kept)))


def _links_of(key: np.ndarray, plain: np.ndarray, node: np.ndarray, f: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
    sizes = np.diff(np.append(begins, len(key)))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # Small groups, all at once: row r against row r + offset while both are in one group.
    rest = np.repeat(begins + sizes, sizes) - np.arange(len(key))  # rows from here to the group's end
    rows = np.nonzero(plain & (np.repeat(sizes, sizes) <= SMALL_GROUP))[0]
    for offset in range(1, SMALL_GROUP):
        rows = rows[rest[rows] > offset]
        if not len(rows):
            break
        near = rows[_differing(f[rows], f[rows + offset]) <= limit]
        found.append((node[near], node[near + offset]))
    for n in np.nonzero(sizes > SMALL_GROUP)[0]:
        own = slice(begins[n], begins[n] + sizes[n])
        if plain[begins[n]]:  # unchanged rows come first
            found.append(_large_group(int(plain[own].sum()), node[own], f[own], limit))
    a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    return _forest(a, b)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One edge per node to the smallest node it is connected with: no more edges than nodes."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        now = label.copy()
        for ends in (x, y, label[x], label[y]):
            np.minimum.at(now, ends, least)
        while (now[now] != now).any():
            now = now[now]
        if (now == label).all():
            break
        label = now
    away = label != np.arange(len(nodes))
    return nodes[label[away]], nodes[away]


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.bitwise_count(a[..., 0] ^ b[..., 0])
    for k in range(1, a.shape[-1]):
        out = out + np.bitwise_count(a[..., k] ^ b[..., k])
    return out


def _large_group(plain: int, node: np.ndarray, f: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the first ``plain`` rows and all rows, as a spanning forest."""
    label = np.arange(len(node))
    if plain * len(node) <= MATRIX_CELLS:
        a, b = np.nonzero(_differing(f[:plain, None], f[None]) <= limit)
        return _forest(node[a[a < b]], node[b[a < b]])
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def unite(a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            if label[x] != label[y]:
                label[label == label[y]] = label[x]
                out.append((node[[x]], node[[y]]))

    free = np.ones(plain, bool)
    stars = []
    for pivot in range(plain):
        if free[pivot]:
            near = np.nonzero(_differing(f[pivot], f) <= limit)[0]
            own = near[near < plain]
            stars.append(own[free[own]])
            free[own] = False
            apart = near[label[near] != label[pivot]]
            mine = np.isin(label, label[apart])
            out.append((np.repeat(node[pivot], len(apart)), node[apart]))
            label[mine] = label[pivot]
    for star in stars:
        if len(star) == 1:
            continue  # a lone pivot has been compared with all rows
        block = max(1, MATRIX_CELLS // len(node))
        for at in range(0, len(star), block):
            mine = star[at : at + block]
            others = np.nonzero(label != label[star[0]])[0]
            a, b = np.nonzero(_differing(f[mine, None], f[None, others]) <= limit)
            unite(mine[a], others[b])
    return _forest(*(np.concatenate(x) for x in zip(*out))) if out else (node[:0], node[:0])


def near_duplicates(
    docs: DataFrame, shingle: int, limit: int, segments: int, words: int = 1, id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None
) -> DataFrame:
    """(doc_id, f0, ..., component_id): the smallest id reachable over links of at most ``limit`` bits.

    One row per row of ``docs``; ``mark``, a long that tells rows with one id apart, goes along as (mark).
    """
    columns = fingerprint_columns(words)
    marked = durable(fingerprints(docs, shingle, words, id_col, text_col, mark))
    classes = durable(few_tasks(marked.groupBy(*columns).agg(F.min("doc_id").alias("node")), marked.count()))
    roots = components(links(classes.where("node is not null"), limit, segments, words))
    named = classes.join(roots, "node", "left").select(*columns, F.coalesce("root", "node").alias("component_id"))
    return marked.join(named, columns, "left")
