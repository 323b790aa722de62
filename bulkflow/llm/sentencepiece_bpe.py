"""SentencePiece encoding and decoding with a merge-type (BPE) vocabulary.

Every prefix of a text has one encoding, so it has one last token.  The encoder keeps that token
for each prefix: an Aho-Corasick automaton gives the tokens that end at a position, and a token
is the last one when it can stand beside the last token of the prefix before it, that is when
merging their joined characters from scratch gives back the same two tokens.  The ids are then
read backwards from the end.  The table takes one entry per character and a handful of automaton
matches per entry, whatever the length of the text.

Tokens never reach across the start of a word when no piece of the vocabulary has the word mark
behind another character (checked when the vocabulary is read).  Then words are encoded one by
one and a bounded memory keeps frequent ones.

Defined results: a null text is an empty one, and an empty text has no ids and decodes to an
empty text.  Texts of any length are encoded whole.  Repeated rows get equal results.  Control pieces in
a text are ordinary characters.  An empty table has no rows.  Columns that are not asked for are left
behind before anything else, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import ship, text_slices

# The word mark, the piece kinds of the model format, the text of an unknown id.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_TEXT = " ⁇ "

#: Words and token pairs that a task remembers; beyond it the memory starts afresh.
REMEMBERED_WORDS = 200_000
REMEMBERED_PAIRS = 2_000_000
REMEMBERED_WORD_LENGTH = 64
#: Ids that are decoded together, and characters that are encoded and decoded together.
IDS_AT_ONCE, TEXT_AT_ONCE = 1 << 18, 1 << 19


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says, as plain values that travel to the executors (a few hundred kB)."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    leading_mark: bool

    @staticmethod
    def read(path: str) -> Vocabulary:
        """Read a model file on the driver; models that also rewrite text are refused."""
        from sentencepiece import sentencepiece_model_pb2 as format_

        model = format_.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep texts as they are can be used")
        if model.trainer_spec.model_type != format_.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("only merge-type models with byte fallback can be used")
        kinds = tuple(p.type for p in model.pieces)
        if USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("models with user-defined or unused pieces cannot be used")
        return Vocabulary(
            tuple(p.piece for p in model.pieces), tuple(p.score for p in model.pieces), kinds, rules.add_dummy_prefix
        )


class Remembered(dict):
    """The results of a function by its argument, for short arguments, in two generations.

    When the young generation is full it becomes the old one, so what is frequent stays.
    """

    def __init__(self, of) -> None:
        super().__init__()
        self._of, self._old = of, {}

    def __missing__(self, key: str) -> bytes:
        found = self._old.get(key)
        if found is None:
            found = self._of(key)
        if len(key) <= REMEMBERED_WORD_LENGTH:
            if len(self) >= REMEMBERED_WORDS:
                self._old = dict(self)
                self.clear()
            self[key] = found
        return found


def _int32(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


class PrefixTableTokenizer:
    """Encodes and decodes one text at a time; one lives in each Python worker."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        normal = [i for i, k in enumerate(vocabulary.kinds) if k == NORMAL]
        self._id = {vocabulary.pieces[i]: i for i in normal}
        self._score = {vocabulary.pieces[i]: vocabulary.scores[i] for i in normal}
        self._bytes = [0] * 256
        for i, k in enumerate(vocabulary.kinds):
            if k == BYTE:
                self._bytes[int(vocabulary.pieces[i][1:-1], 16)] = i
        self._known = {c for p in self._id for c in p}
        # Tokens in the automaton: pieces that merging can reach, and single characters.
        tokens = [p for p in self._id if len(p) == 1 or self._merge(p) == [p]]
        tokens += [c for c in self._known if c not in self._id]
        self._tokens = tokens
        self._automaton = ahocorasick.Automaton()
        for n, p in enumerate(tokens):
            self._automaton.add_word(p, (len(p), n))
        self._automaton.make_automaton()
        self._ids = [_int32([self._id[p]]) if p in self._id else self._as_bytes(p) for p in tokens]
        if len(tokens) >= 1 << 15:
            raise ValueError("at most 32,767 tokens are supported")
        self._nothing = len(tokens)
        self._side_by_side = {pair for p in self._id for pair in zip(p, p[1:])}
        self._together: dict[int, bool] = {}
        self._parts = Remembered(self._encode_part)
        self._words = Remembered(self._encode_unit)
        self._by_word = not any(MARK in p.lstrip(MARK) for p in self._id) and not any("\n" in p for p in self._id)
        self._unit = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self._control = {i for i, k in enumerate(vocabulary.kinds) if k == CONTROL}
        self._plain = [self._text_of(i).encode() for i in range(len(vocabulary.pieces))]
        for value, i in enumerate(self._bytes):
            self._plain[i] = bytes([value])
        self._blob = np.frombuffer(b"".join(self._plain), np.uint8)
        self._sizes = np.array([len(p) for p in self._plain], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._begins_with_mark = np.array(
            [k == NORMAL and p.startswith(MARK) for k, p in zip(vocabulary.kinds, vocabulary.pieces)], np.int64
        )

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), np.int32)

    def encode_bytes(self, text: str) -> bytes:
        """The ids as native 32-bit integers, one after the other."""
        if not text:
            return b""
        if self._by_word and self.v.leading_mark and "  " not in text and MARK not in text and text[0] != " ":
            units = (MARK + text.replace(" ", " " + MARK).replace("\n", " \n ")).split(" ")
        else:
            marked = (MARK if self.v.leading_mark else "") + text.replace(" ", MARK)
            units = self._unit.findall(marked) if self._by_word else [marked]
        return b"".join(map(self._words.__getitem__, units))

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become one replacement character each."""
        out, leading = [], self.v.leading_mark
        for part in [ids] if self._control.isdisjoint(ids) else self._runs(ids):
            out.append(self._decode_run(part, leading))
            leading = leading and not len(part)
        return "".join(out)

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """``decode`` of every list at once: piece texts are gathered from one byte table."""
        flat = ids.flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())])
        if np.isin(flat, list(self._control)).any() or len(flat) > 1 << 22:
            return pa.array([self.decode(x.values.to_pylist()) if x.is_valid else None for x in ids], pa.string())
        sizes = self._sizes[flat]
        at = np.concatenate([[0], np.cumsum(sizes)])
        raw = self._blob[np.arange(at[-1]) + np.repeat(self._starts[flat] - at[:-1], sizes)]
        begins, stops = at[ends[:-1]], at[ends[1:]]
        if self.v.leading_mark:
            some = ends[:-1] < ends[1:]
            begins[some] += self._begins_with_mark[flat[ends[:-1][some]]]
        whole, valid = raw.tobytes(), ids.is_valid().to_pylist()
        out = [None] * len(ids)
        for n, (a, b) in enumerate(zip(begins.tolist(), stops.tolist())):
            if valid[n]:
                try:
                    out[n] = whole[a:b].decode()
                except UnicodeDecodeError:
                    out[n] = _lenient(whole[a:b])
        return pa.array(out, pa.string())

    def _runs(self, ids) -> list[list[int]]:
        """Control pieces have no text, but end a run of bytes."""
        runs: list[list[int]] = [[]]
        for i in ids:
            if i in self._control:
                runs.append([])
            else:
                runs[-1].append(i)
        return runs

    def _decode_run(self, ids, leading: bool) -> str:
        plain = self._plain
        raw = b"".join([plain[i] for i in ids])
        if leading and len(ids) and self.v.kinds[ids[0]] == NORMAL and raw.startswith(b" "):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _lenient(raw)

    def _text_of(self, i: int) -> str:
        kind = self.v.kinds[i]
        return "" if kind in (CONTROL, BYTE) else UNKNOWN_TEXT if kind == UNKNOWN else self.v.pieces[i].replace(MARK, " ")

    def _encode_unit(self, unit: str) -> bytes:
        """Split between characters that no piece has side by side, then fill each part's prefix table."""
        inside = self._side_by_side
        cuts = [n for n, pair in enumerate(zip(unit, unit[1:]), 1) if pair not in inside]
        if not cuts:
            return self._encode_part(unit)
        return b"".join([self._parts[unit[a:b]] for a, b in zip((0, *cuts), (*cuts, len(unit)))])

    def _encode_part(self, part: str) -> bytes:
        if len(part) <= 1 and part not in self._known:
            return b"".join(self._as_bytes(c) for c in part)
        size = len(part)
        last = [-1] * (size + 1)  # by the prefix's last position; the entry behind them is the empty prefix
        last[size] = self._nothing
        together = self._together
        for end, (length, token) in self._automaton.iter(part):
            if last[end] < 0:
                pair = last[end - length] << 15 | token
                fits = together.get(pair)
                if fits is None:
                    fits = self._fits(last[end - length], token)
                if fits:
                    last[end] = token
        found, at = [], size - 1
        tokens = self._tokens
        while at >= 0:
            token = last[at]
            found.append(token)
            at -= len(tokens[token])
        found.reverse()
        return b"".join([self._ids[token] for token in found])

    def _fits(self, a: int, b: int) -> bool:
        if a == self._nothing:
            fits = True
        else:
            left, right = self._tokens[a], self._tokens[b]
            fits = self._merge(left + right) == [left, right]
        if len(self._together) >= REMEMBERED_PAIRS:
            self._together.clear()
        self._together[a << 15 | b] = fits
        return fits

    def _merge(self, text: str) -> list[str]:
        """Plain merging: the best-scored neighbours first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self._score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _as_bytes(self, c: str) -> bytes:
        return _int32([self._bytes[b] for b in c.encode()])


def _lenient(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


_loaded: dict[Vocabulary, PrefixTableTokenizer] = {}


def tokenizer(vocabulary: Vocabulary) -> PrefixTableTokenizer:
    """One tokenizer per worker process; building it takes about a second."""
    if vocabulary not in _loaded:
        _loaded[vocabulary] = PrefixTableTokenizer(vocabulary)
    return _loaded[vocabulary]


def _encode_batch(t: PrefixTableTokenizer, texts: list[str]) -> pa.ListArray:
    found = [t.encode_bytes(x) for x in texts]
    ends = np.cumsum([0, *map(len, found)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))


def encode_column(vocabulary: Vocabulary, text: Column) -> Column:
    """The ids of a text as ``array<int>``."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = tokenizer(vocabulary)
        for batch in batches:
            done = [_encode_batch(t, texts) for texts in text_slices(batch)]
            yield pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.int32()))

    return encode(F.coalesce(text, F.lit("")))


def decode_column(vocabulary: Vocabulary, ids: Column) -> Column:
    """The text of an ``array<int>`` of ids; null for null."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = tokenizer(vocabulary)
        for batch in batches:
            ends = np.cumsum(batch.value_lengths().fill_null(0).to_numpy())
            start, done = 0, []
            while start < len(batch):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + IDS_AT_ONCE)))
                done.append(t.decode_batch(batch.slice(start, stop - start)))
                start = stop
            yield pa.concat_arrays(done) if done else pa.array([], pa.string())

    return decode(ids)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and the text ``decoded`` from them, in place of columns of those names.

    One Python pass does both, so that a task holds one tokenizer.
    """
    ship(docs.sparkSession)
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        t = tokenizer(vocabulary)
        for batch in batches:
            done = []
            for texts in text_slices(batch, TEXT_AT_ONCE):
                ids = _encode_batch(t, texts)
                done.append(pa.StructArray.from_arrays([ids, t.decode_batch(ids)], fields=list(kind)))
            yield pa.concat_arrays(done) if done else pa.array([], kind)

    texts = F.coalesce(docs[text_col], F.lit(""))
    kept = [docs[c] for c in docs.columns if c.lower() not in ("ids", "decoded")]
    return docs.select(*kept, both(texts).alias("_both")).select("*", "_both.ids", "_both.decoded").drop("_both")
