"""Spelling variants by finite-state composition, one initial state at a time.

The words are accepted by a minimised automaton; composed with a transducer that makes exactly one
edit (a code point inserted, deleted or replaced) and with the automaton again, it accepts the pairs of
words that are one edit apart.  The first edit of a pair is put at the first code point that differs,
so every pair has one path.

Two words of six or more code points that are one edit apart have the same first three or the same
last three.  So the composition falls apart by initial state: the state behind the first code points
of a word, and for pairs that differ there, the state of the reversed automaton behind the last ones.
Each initial state's words are one group on Spark, minimised, composed and enumerated in one task.
Initial states with more than ``GROUP_WORDS`` words are split: pairs that differ at the very next code
point agree in all that follows, so they meet in an equijoin on the rest; all other pairs share that
code point, so the words go on to the state behind it.  This repeats until all groups are small.

The form of a word is its near word that occurs most often, if that is much more often; following
forms to the last gives the root, in a logarithm of the longest chain many joins.

Defined results: a null text has no words; a null id hashes as an empty text.  Repeated rows count
each.  Of near words with equal counts the smallest in code-point order is the form.  Words of any
length are handled whole.  An empty table has no words.  Columns that are not asked for are left behind
before anything else, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import ids_and_texts, ship
from bulkflow.llm.components import durable, written

# The letters of a run besides A-Z, which become a-z.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[a-zÀ-ÿ]+"
#: Code points that one of the two ends of near words shares, and the shortest words for which that holds.
SHARED, SHORTEST = 3, 6
#: Words of an initial state that a task takes at once.
GROUP_WORDS = 20_000


class Automaton:
    """The minimised acceptor of some words: equal right languages are one state.

    A state's number is larger than those of the states behind it.
    """

    def __init__(self, words: list[str]) -> None:
        """``words`` are sorted and distinct."""
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        open_: list[tuple[bool, list[tuple[str, int]]]] = [(False, [])]  # the states along the last word

        def close(down_to: int, word: str) -> None:
            while len(open_) > down_to + 1:
                state = self._state(known, *open_.pop())
                open_[-1][1].append((word[len(open_) - 1], state))

        last = ""
        for word in words:
            shared = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                shared += 1
            close(shared, last)
            open_.extend((False, []) for _ in range(len(word) - shared))
            open_[-1] = (True, open_[-1][1])
            last = word
        close(0, last)
        self.initial = self._state(known, *open_.pop())

    def _state(self, known: dict, final: bool, arcs: list[tuple[str, int]]) -> int:
        key = (final, tuple(arcs))
        if key not in known:
            known[key] = len(self.arcs)
            self.arcs.append(dict(arcs))
            self.final.append(final)
        return known[key]


class OneEdit:
    """An automaton composed with a one-edit transducer and itself, trimmed to what accepts.

    Before the edit both sides are in one state; behind it the composed states are pairs (p, q).
    """

    def __init__(self, automaton: Automaton) -> None:
        self.a = automaton
        self.edits = [self._edits_at(q) for q in range(len(automaton.arcs))]
        self.live = self._accepting({x[2:] for edits in self.edits for x in edits})
        self.edits = [[x for x in edits if x[2:] in self.live] for edits in self.edits]
        self.leads = [False] * len(automaton.arcs)  # whether a pair lies at or behind the state
        for q, arcs in enumerate(automaton.arcs):
            self.leads[q] = bool(self.edits[q]) or any(self.leads[t] for t in arcs.values())

    def _edits_at(self, q: int) -> list[tuple[str, str, int, int]]:
        """(written left, written right, left state, right state): the edit, with the code point behind it if one side is ahead."""
        arcs, final, found = self.a.arcs, self.a.final, []
        here = sorted(arcs[q].items())
        for n, (c, p) in enumerate(here):
            found += [(c, d, p, r) for d, r in here[n + 1 :]]
            # c is in the left word only; the code point behind it differs from c, or both words end.
            found += [(c + x, x, arcs[p][x], r) for x, r in here if x != c and x in arcs[p]]
            if final[p] and final[q]:
                found.append((c, "", -1, -1))
        return found

    def _accepting(self, starts: set[tuple[int, int]]) -> dict[tuple[int, int], list[tuple[str, int, int]]]:
        """The composed states behind the edit from which both sides accept, with the arcs that lead on."""
        arcs, final = self.a.arcs, self.a.final
        reached, todo = set(starts), list(starts)
        while todo:
            p, q = todo.pop()
            if p != q and p >= 0:
                small, large = sorted((arcs[p], arcs[q]), key=len)
                for c in small:
                    if c in large and (arcs[p][c], arcs[q][c]) not in reached:
                        reached.add((arcs[p][c], arcs[q][c]))
                        todo.append((arcs[p][c], arcs[q][c]))
        live: dict[tuple[int, int], list[tuple[str, int, int]]] = {}
        for p, q in sorted(reached):  # arcs lead to smaller numbers
            if p == q:
                live[p, q] = []  # one state: everything behind it is shared
                continue
            on = [(c, t, arcs[q][c]) for c, t in arcs[p].items() if c in arcs[q] and (t, arcs[q][c]) in live]
            if on or (final[p] and final[q]):
                live[p, q] = on
        return live

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All accepted pairs, each once and in one direction."""
        todo = [(self.a.initial, "")]
        while todo:
            q, prefix = todo.pop()
            for left, right, p, r in self.edits[q]:
                for rest in self._shared(p, r):
                    yield prefix + left + rest, prefix + right + rest
            todo += [(t, prefix + c) for c, t in self.a.arcs[q].items() if self.leads[t]]

    def _shared(self, p: int, q: int) -> Iterator[str]:
        """All strings that lead both states to acceptance."""
        todo = [(p, q, "")]
        while todo:
            p, q, rest = todo.pop()
            if p < 0:
                yield rest
                continue
            if self.a.final[p] and self.a.final[q]:
                yield rest
            on = self.live[p, q] if p != q else [(c, t, t) for c, t in self.a.arcs[p].items()]
            todo += [(x, y, rest + c) for c, x, y in on]


def near_pairs(words: list[str]) -> Iterator[tuple[str, str]]:
    """The pairs of distinct words that are one edit apart, each once."""
    return OneEdit(Automaton(sorted(set(words)))).pairs()


def words_of(docs: DataFrame, shortest: int, id_col: str = "doc_id", text_col: str = "text", spoil: int | None = None) -> DataFrame:
    """(word): every occurrence of a run of letters with ``shortest`` code points or more.

    With ``spoil``, a run whose hash with the id is a multiple of it has one code point deleted.
    """
    texts = ids_and_texts(docs, id_col, text_col)
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))
    each = texts.select("doc_id", F.explode(runs).alias("word")).where(F.length("word") >= shortest)
    if spoil is None:
        return each.select("word")
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
    at = (F.col("h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    spoilt = F.when(F.col("h") % spoil == 0, cut).otherwise(F.col("word"))
    return each.withColumn("h", h).select(spoilt.alias("word")).where(F.length("word") >= shortest)


def vocabulary(words: DataFrame, least: int) -> DataFrame:
    """(word, n): the words that occur ``least`` times or more."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def pairs_of(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(a, b): the near words of a vocabulary (word) of ``SHORTEST`` code points or more, each pair once."""
    ship(words.sparkSession)
    forward, met = _initial_states(words.select("word"), group_words)
    backward, met_backward = _initial_states(words.select(F.reverse("word").alias("word")), group_words)
    groups = forward.select(F.lit(False).alias("reversed"), "key", "word").union(backward.select(F.lit(True), "key", "word"))
    ordered = groups.repartition("reversed", "key").sortWithinPartitions("reversed", "key", "word")
    found = ordered.mapInArrow(_enumerate, "a string, b string")
    for side, pairs in ((False, met), (True, met_backward)):
        if pairs is not None:
            turned = pairs.select(F.reverse("a").alias("a"), F.reverse("b").alias("b")) if side else pairs
            found = found.union(turned)
    # A split group's words may meet in two ways, and a pair may share both ends.
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _initial_states(words: DataFrame, group_words: int) -> tuple[DataFrame, DataFrame | None]:
    """The words (key, word) by initial state, and the pairs (a, b) met on the way to small groups."""
    depth, groups, met = SHARED, None, None
    now = words
    while True:
        keyed = now.select(F.substring("word", F.lit(1), F.lit(depth)).alias("key"), "word")
        large = durable(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group_words).select("key"))
        split = not large.isEmpty()
        small = keyed.join(large, "key", "left_anti") if split else keyed
        groups = small if groups is None else groups.union(small)
        if not split:
            return groups, met
        now = durable(keyed.join(large, "key", "left_semi"))
        rest = F.substring("word", F.lit(depth + 1), F.length("word"))
        # Pairs that differ at the next code point: what follows it, or one word's whole rest, is the same.
        ends = now.select("key", "word", rest.alias("end")).union(
            now.where(F.length("word") > depth).select("key", "word", F.substring("word", F.lit(depth + 2), F.length("word")))
        )
        other = ends.select(F.col("key").alias("k"), F.col("end").alias("e"), F.col("word").alias("b"))
        pairs = ends.join(other, (F.col("key") == F.col("k")) & (F.col("end") == F.col("e"))).where("word < b").select(F.col("word").alias("a"), "b")
        met = pairs if met is None else met.union(pairs)
        now = now.where(F.length("word") > depth).select("word")
        depth += 1


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (reversed, key, word) to pairs, group by group."""
    now, words = None, []
    for batch in batches:
        for turned, key, word in zip(*(batch.column(c).to_pylist() for c in ("reversed", "key", "word"))):
            if (turned, key) != now:
                yield from _group_pairs(now, words)
                now, words = (turned, key), []
            words.append(word)
    yield from _group_pairs(now, words)


def _group_pairs(now: tuple[bool, str] | None, words: list[str]) -> Iterator[pa.RecordBatch]:
    if len(words) < 2:
        return
    turned, key = now
    found: list[tuple[str, str]] = []
    for x, y in near_pairs([w[len(key) :] for w in words]):
        a, b = (key + x, key + y) if not turned else ((key + x)[::-1], (key + y)[::-1])
        if turned and a[:SHARED] == b[:SHARED]:
            continue  # met in the other direction
        found.append((a, b))
        if len(found) == 50_000:
            yield _pair_batch(found)
            found = []
    yield _pair_batch(found)


def _pair_batch(found: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.string()) for k in (0, 1)], ["a", "b"])


def forms(counted: DataFrame, ratio: int = 5, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a vocabulary (word, n) of ``SHORTEST`` code points or more."""
    counted = durable(counted.select("word", "n"))
    pairs = durable(pairs_of(counted, group_words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    known = counted.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = both.join(known, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best")
    )
    placed = counted.join(near, "word", "left")
    often = -F.col("best.less") >= F.col("n") * ratio
    out = durable(
        placed.select(
            "word", F.when(often, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(often, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(out.where("form is not null").select("word", F.col("form").alias("root")))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """(word, root): every chain followed to its end.  Counts grow along a chain, so there are no circles."""
    now = durable(steps)
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = written(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now
