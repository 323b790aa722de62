"""Chat formatting with a template compiler: syntax tree, folded constants, Python closures.

The template language is a small sandbox: texts, ``{{ value }}``, ``{% if %}``, ``{% for %}``,
``{% set %}`` and ``{% generation %}``.  A name is a local one or a field of a mapping; there are no
calls but the filters below and those a caller adds, no attributes of Python objects and no loops but
over given lists.  A template has one loop over ``messages`` at its top level.  What is before and
behind it is rendered once for each conversation, the body once for each message and from that message
alone.  So every row of a conversation is formatted where it lies, however long the conversation, and
nothing is gathered: the result is a table of pieces, whose order gives the conversation's text.

Texts that hold a control string of the format are escaped by ``protect``: one backslash goes behind
the string's first character, and one more where backslashes stand there already.  Taking one off
gives the text back, so the marks of the template are the only control strings in the output.

Defined results: a null text or role is an empty one; a null conversation is a conversation.  Turns
with one number are ordered by their pieces, null turns first; repeated rows are turns of their own.
An empty table has no pieces.  A turn's text is handled whole.  Columns that are not asked for are
left behind before anything else, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterator, Sequence
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bulkflow.llm.common import ship


class TemplateError(ValueError):
    """A template that cannot be compiled, or a value that it cannot use."""


class Undefined:
    """The value of a name that nobody has set: false, and empty when written."""

    def __bool__(self) -> bool:
        return False

    def __str__(self) -> str:
        return ""


UNDEFINED = Undefined()


class Protection:
    """Escapes and restores the control strings of a format."""

    def __init__(self, controls: Sequence[str]) -> None:
        firsts = {c[:1] for c in controls}
        if any(len(c) < 2 or "\\" in c or firsts & set(c[1:]) for c in controls):
            raise TemplateError("a control string has two characters or more, no backslash, and no string's first character inside")
        self.controls = tuple(controls)
        bodies = "|".join(f"{re.escape(c[0])}\\\\{{}}{re.escape(c[1:])}" for c in controls)
        self._plain, self._escaped = (re.compile(bodies.replace("{}", n)) if controls else None for n in ("*", "+"))

    def protect(self, text: str) -> str:
        return self._plain.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text) if self._plain else text

    def restore(self, text: str) -> str:
        return self._escaped.sub(lambda m: m[0][0] + m[0][2:], text) if self._escaped else text


# --- syntax tree: tuples of a kind and parts ---------------------------------------------------------

_TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(\d+\.\d+|\d+)|("(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*')|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+~<>|.,()\[\]*%]))""")
_WORDS = {"and", "or", "not", "in", "if", "else", "true", "false", "none"}
_CONSTANTS = {"true": True, "false": False, "none": None}
_LEVELS = [("or",), ("and",), ("not",), ("==", "!=", "<", ">", "<=", ">=", "in"), ("~",), ("+", "-"), ("*", "%")]


class _Expression:
    """Recursive descent over one expression; gives its tree."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, Any]] = []
        at = 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:].strip()!r}")
            number, string, word, sign = m.groups()
            if number is not None:
                self.tokens.append(("value", float(number) if "." in number else int(number)))
            elif string is not None:
                self.tokens.append(("value", re.sub(r"\\(.)", lambda e: {"n": "\n", "t": "\t"}.get(e[1], e[1]), string[1:-1], flags=re.DOTALL)))
            else:
                self.tokens.append(("word" if word and word not in _WORDS else "sign", word or sign))
            at = m.end()
        self.at = 0

    def whole(self) -> tuple:
        tree = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"did not expect {self.tokens[self.at][1]!r}")
        return tree

    def sign(self, *signs: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "sign" and self.tokens[self.at][1] in signs:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, sign: str) -> None:
        if not self.sign(sign):
            raise TemplateError(f"expected {sign!r}")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "word":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("expected a name")

    def choice(self) -> tuple:
        tree = self.binary(0)
        if self.sign("if"):
            test = self.binary(0)
            other = self.choice() if self.sign("else") else ("value", "")
            return ("choice", test, tree, other)
        return tree

    def binary(self, level: int) -> tuple:
        if level == len(_LEVELS):
            return self.filtered()
        if _LEVELS[level] == ("not",):
            return ("not", self.binary(level)) if self.sign("not") else self.binary(level + 1)
        tree = self.binary(level + 1)
        while sign := self.sign(*_LEVELS[level]):
            tree = ("binary", sign, tree, self.binary(level + 1))
        return tree

    def filtered(self) -> tuple:
        tree = self.atom()
        while sign := self.sign(".", "[", "|"):
            if sign == ".":
                tree = ("field", tree, ("value", self.name()))
            elif sign == "[":
                tree = ("field", tree, self.choice())
                self.need("]")
            else:
                tree = ("filter", self.name(), tree, self.arguments())
        return tree

    def arguments(self) -> tuple:
        found = []
        if self.sign("(") and not self.sign(")"):
            found.append(self.choice())
            while self.sign(","):
                found.append(self.choice())
            self.need(")")
        return tuple(found)

    def atom(self) -> tuple:
        if self.sign("("):
            tree = self.choice()
            self.need(")")
            return tree
        if self.sign("-"):
            return ("binary", "-", ("value", 0), self.atom())
        for word, value in _CONSTANTS.items():
            if self.sign(word):
                return ("value", value)
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "value":
            self.at += 1
            return self.tokens[self.at - 1]
        return ("name", self.name())


def parse(source: str) -> tuple:
    """The statements of a template, as ("block", statement, ...)."""
    parts = _TAG.split(source)
    stack: list[tuple[str, list, list]] = [("", [], [])]  # (kind, head, statements)
    for n, part in enumerate(parts):
        if n % 2 == 0:
            if n and parts[n - 1].endswith(("-}}", "-%}")):
                part = part.lstrip()
            if n + 1 < len(parts) and parts[n + 1].startswith(("{{-", "{%-")):
                part = part.rstrip()
            stack[-1][2].append(("text", part))
        elif part.startswith("{{"):
            stack[-1][2].append(("write", _Expression(part[2:-2].strip("-")).whole()))
        elif part.startswith("{%"):
            _statement(part[2:-2].strip("-").strip(), stack)
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} has no end")
    return ("block", *stack[0][2])


def _statement(source: str, stack: list) -> None:
    word, _, rest = source.partition(" ")
    if word in ("if", "generation"):
        stack.append((word, [_Expression(rest).whole()] if word == "if" else [], []))
    elif word == "for":
        name, found, values = rest.partition(" in ")
        if not found or not name.strip().isidentifier():
            raise TemplateError(f"cannot read {source!r}")
        stack.append((word, [name.strip(), _Expression(values).whole()], []))
    elif word == "set":
        name, found, value = rest.partition("=")
        if not found or not name.strip().isidentifier():
            raise TemplateError(f"cannot read {source!r}")
        stack[-1][2].append(("set", name.strip(), _Expression(value).whole()))
    elif word in ("elif", "else") and stack[-1][0] == "if":
        _, head, body = stack.pop()
        # The rest of the chain is an if of its own, inside the else of this one.
        stack.append(("if", [*head, ("block", *body), _Expression(rest).whole() if word == "elif" else ("value", True)], []))
    elif word in ("endif", "endfor", "endgeneration") and stack[-1][0] == word[3:]:
        kind, head, body = stack.pop()
        block: tuple = ("block", *body)
        if kind == "if":
            tree: tuple = ("block",)
            parts = [*head, block]
            for k in range(len(parts) - 2, -1, -2):
                tree = ("if", parts[k], parts[k + 1], tree)
        else:
            tree = (kind, *head, block)
        stack[-1][2].append(tree)
    else:
        raise TemplateError(f"unknown statement {source!r}")


# --- constants folded --------------------------------------------------------------------------------

_OPERATORS: dict[str, Callable[[Any, Any], Any]] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
    "in": lambda a, b: a in b, "~": lambda a, b: _text(a) + _text(b), "+": operator.add, "-": operator.sub, "*": operator.mul, "%": operator.mod,
}
FILTERS: dict[str, Callable[..., Any]] = {
    "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(), "length": len,
    "default": lambda v, other="": other if v is UNDEFINED else v, "replace": lambda v, old, new: _text(v).replace(old, new),
    "join": lambda v, between="": between.join(map(_text, v)),
}


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _checked(sign: str, a: Any, b: Any) -> Any:
    """An operator on plain values; ``%`` and ``*`` are for numbers, so that no text is formatted or blown up."""
    if sign in "%*" and not all(isinstance(x, (int, float)) for x in (a, b)):
        raise TemplateError(f"{sign} needs numbers")
    try:
        return _OPERATORS[sign](a, b)
    except TypeError as e:
        raise TemplateError(str(e)) from None


def fold(tree: Any, filters: dict[str, Callable[..., Any]]) -> Any:
    """The tree with what is known beforehand computed, dead branches left out and texts joined."""
    if not isinstance(tree, tuple) or not tree or tree[0] in ("value", "text", "name"):
        return tree
    kind, *parts = tree
    parts = [fold(p, filters) if isinstance(p, tuple) and kind != "filter" else p for p in parts]
    if kind == "filter":
        name, value, given = tree[1], fold(tree[2], filters), tuple(fold(x, filters) for x in tree[3])
        if name not in filters:
            raise TemplateError(f"unknown filter {name!r}")
        if all(x[0] == "value" for x in (value, *given)):
            return ("value", filters[name](value[1], *(x[1] for x in given)))
        return (kind, name, value, given)
    if kind == "binary":
        sign, a, b = parts
        if sign in ("and", "or") and a[0] == "value":
            return b if bool(a[1]) == (sign == "and") else a
        if sign not in ("and", "or") and a[0] == b[0] == "value":
            return ("value", _checked(sign, a[1], b[1]))
    elif kind == "not" and parts[0][0] == "value":
        return ("value", not parts[0][1])
    elif kind in ("choice", "if") and parts[0][0] == "value":
        return parts[1] if parts[0][1] else parts[2]
    elif kind == "write" and parts[0][0] == "value":
        return ("text", _text(parts[0][1]))
    elif kind == "block":
        flat: list[tuple] = []
        for p in parts:
            for x in p[1:] if p[0] == "block" else (p,):
                if x[0] == "text" and flat and flat[-1][0] == "text":
                    flat[-1] = ("text", flat[-1][1] + x[1])
                elif x != ("text", ""):
                    flat.append(x)
        return ("block", *flat)
    return (kind, *parts)


# --- closures ----------------------------------------------------------------------------------------


class Output:
    """What a template writes: parts, their length, and the spans under generation markers."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def value_of(tree: tuple, filters: dict) -> Callable[[dict], Any]:
    """A closure that gives an expression's value for the names of a scope."""
    kind = tree[0]
    if kind == "value":
        value = tree[1]
        return lambda scope: value
    if kind == "name":
        name = tree[1]
        return lambda scope: scope.get(name, UNDEFINED)
    if kind == "not":
        inner = value_of(tree[1], filters)
        return lambda scope: not inner(scope)
    if kind == "filter":
        f, inner, given = filters[tree[1]], value_of(tree[2], filters), [value_of(x, filters) for x in tree[3]]
        return lambda scope: f(inner(scope), *(x(scope) for x in given))
    if kind == "field":
        inner, key = value_of(tree[1], filters), value_of(tree[2], filters)

        def field(scope: dict) -> Any:
            holder, k = inner(scope), key(scope)
            if isinstance(holder, dict):
                return holder.get(k, UNDEFINED)
            if isinstance(holder, (list, tuple)) and isinstance(k, int):
                return holder[k] if -len(holder) <= k < len(holder) else UNDEFINED
            return UNDEFINED

        return field
    if kind == "choice":
        test, yes, no = (value_of(x, filters) for x in tree[1:])
        return lambda scope: yes(scope) if test(scope) else no(scope)
    sign, a, b = tree[1], value_of(tree[2], filters), value_of(tree[3], filters)
    if sign == "and":
        return lambda scope: a(scope) and b(scope)
    if sign == "or":
        return lambda scope: a(scope) or b(scope)
    return lambda scope: _checked(sign, a(scope), b(scope))


def statement_of(tree: tuple, filters: dict) -> Callable[[dict, Output], None]:
    """A closure that writes a statement's output."""
    kind = tree[0]
    if kind == "text":
        text = tree[1]
        return lambda scope, out: out.write(text)
    if kind == "write":
        value = value_of(tree[1], filters)
        return lambda scope, out: out.write(_text(value(scope)))
    if kind == "set":
        name, value = tree[1], value_of(tree[2], filters)
        return lambda scope, out: scope.__setitem__(name, value(scope))
    if kind == "if":
        test, yes, no = value_of(tree[1], filters), statement_of(tree[2], filters), statement_of(tree[3], filters)
        return lambda scope, out: yes(scope, out) if test(scope) else no(scope, out)
    if kind == "block":
        steps = [statement_of(x, filters) for x in tree[1:]]

        def block(scope: dict, out: Output) -> None:
            for step in steps:
                step(scope, out)

        return block
    body = statement_of(tree[-1], filters)
    if kind == "generation":

        def generation(scope: dict, out: Output) -> None:
            start = out.length
            body(scope, out)
            out.spans.append((start, out.length))

        return generation
    name, values = tree[1], value_of(tree[2], filters)

    def loop(scope: dict, out: Output) -> None:
        found = values(scope)
        if found is not UNDEFINED and not isinstance(found, (list, tuple)):
            raise TemplateError("a loop needs a list")
        for item in found or ():
            body(scope | {name: item}, out)

    return loop


class Template:
    """A compiled template; ``controls`` are the strings that ``protect`` escapes."""

    def __init__(self, source: str, controls: Sequence[str], filters: dict[str, Callable[..., Any]] | None = None) -> None:
        self.source, self.extra, self.protection = source, filters or {}, Protection(controls)
        known = FILTERS | self.extra | {"protect": lambda v: self.protection.protect(_text(v))}
        tree = fold(parse(source), known)
        loops = [n for n, x in enumerate(tree) if isinstance(x, tuple) and x[0] == "for" and x[2] == ("name", "messages")]
        if len(loops) != 1:
            raise TemplateError("needs one loop over messages at its top level")
        at = loops[0]
        self.name = tree[at][1]
        before, inside, behind = ("block", *tree[1:at]), tree[at][3], ("block", *tree[at + 1 :])
        if any(_names(x, "messages") for x in (before, inside, behind)):
            raise TemplateError("messages are for the loop at the top level only")
        self._parts = [statement_of(x, known) for x in (before, inside, behind)]

    def __reduce__(self):
        return Template, (self.source, self.protection.controls, self.extra)

    def _run(self, part: int, scope: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        self._parts[part](scope, out)
        return "".join(out.parts), out.spans

    def opening(self) -> tuple[str, list[tuple[int, int]]]:
        return self._run(0, {})

    def message(self, fields: dict) -> tuple[str, list[tuple[int, int]]]:
        return self._run(1, {self.name: fields})

    def closing(self) -> tuple[str, list[tuple[int, int]]]:
        return self._run(2, {})


def _names(tree: Any, name: str) -> bool:
    return isinstance(tree, tuple) and (tree[:2] == ("name", name) or any(_names(x, name) for x in tree))


# --- on Spark ----------------------------------------------------------------------------------------

PIECES = "part int, piece string, spans array<struct<start: int, end: int>>"
OPENING, MESSAGE, CLOSING = 0, 1, 2


def _spans(spans: list[list[tuple[int, int]]]) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], kind)


def format_conversations(rows: DataFrame, template: Template, conversation: str, turn: str, fields: Sequence[str]) -> DataFrame:
    """(conversation, turn, part, piece, spans): a piece for every row, one to open and one to close each conversation.

    Sorted by (conversation, part, turn, piece), the pieces are the formatted text; ``spans`` are under generation markers.
    """
    ship(rows.sparkSession)
    given = rows.select(rows[conversation].alias("conversation"), rows[turn].alias("turn"), *(rows[f].alias(f"field_{f}") for f in fields))
    kinds = dict(given.dtypes)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(f"field_{f}").to_pylist() for f in fields]
            found = [template.message(dict(zip(fields, values))) for values in zip(*columns)]
            arrays = [batch.column("conversation"), batch.column("turn"), pa.array([MESSAGE] * len(found), pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array([t for t, _ in found], pa.string()), _spans([s for _, s in found])], ["conversation", "turn", "part", "piece", "spans"]
            )

    turns = given.mapInArrow(render, f"conversation {kinds['conversation']}, turn {kinds['turn']}, {PIECES}")
    each = given.select("conversation").distinct()
    around = [_constant(each, part, *piece, kinds["turn"]) for part, piece in ((OPENING, template.opening()), (CLOSING, template.closing()))]
    return turns.union(around[0]).union(around[1])


def _constant(each: DataFrame, part: int, piece: str, spans: list[tuple[int, int]], turn: str) -> DataFrame:
    marks = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in spans)) if spans else F.array()
    return each.select("conversation", F.lit(None).cast(turn).alias("turn"), F.lit(part).alias("part"), F.lit(piece).alias("piece"), marks.cast(PIECES.split("spans ")[1]).alias("spans"))


def formatted_text(piece: Column, part: Column, turn: Column) -> Column:
    """Aggregate: a conversation's text as one string, for conversations known to be short."""
    ordered = F.array_sort(F.collect_list(F.struct(part.alias("part"), turn.alias("turn"), piece.alias("piece"))))
    return F.array_join(F.transform(ordered, lambda x: x["piece"]), "")


class Reader:
    """Reads a conversation back from its pieces, one after the other, and keeps digests only.

    ``turn`` is a pattern for one turn with the groups ``role`` and ``text``; the borders of the pieces
    do not matter.  What cannot be read so far is kept, which is one turn at most.
    """

    def __init__(self, turn: re.Pattern, opening: str, closing: str, protection: Protection) -> None:
        self.pattern, self.opening, self.closing, self.protection = turn, opening, closing, protection
        self.turns, self.turns_digest = 0, hashlib.sha256()
        self.loss_chars, self.loss_digest = 0, hashlib.sha256()
        self.chars, self.rest, self.opened = 0, "", False

    def feed(self, piece: str, spans: Sequence[tuple[int, int]]) -> None:
        self.chars += len(piece)
        for a, b in spans:
            text = self.protection.restore(piece[a:b])
            self.loss_chars += len(text)
            self.loss_digest.update(text.encode())
        self.rest += piece
        if not self.opened and len(self.rest) >= len(self.opening):
            if not self.rest.startswith(self.opening):
                raise TemplateError("a conversation does not begin as its template says")
            self.rest, self.opened = self.rest[len(self.opening) :], True
        at = 0
        while self.opened and (m := self.pattern.match(self.rest, at)):
            role, text = (self.protection.restore(m[g] or "") for g in ("role", "text"))
            self.turns += 1
            self.turns_digest.update(f"{role}\n{text}\n".encode())
            at = m.end()
        self.rest = self.rest[at:]

    def result(self) -> tuple[int, str, int, str, int]:
        if not self.opened or self.rest != self.closing:
            raise TemplateError("a conversation does not end as its template says")
        return self.turns, self.turns_digest.hexdigest(), self.loss_chars, self.loss_digest.hexdigest(), self.chars


DIGESTS = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def read_back(pieces: DataFrame, turn: re.Pattern, template: Template) -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of formatted conversations.

    Sorted pieces stream through; a task holds one turn, however long the conversation.  A SHA-256 is
    taken in order, so the pieces of one conversation pass through one task.
    """
    ship(pieces.sparkSession)
    opening, closing = template.opening()[0], template.closing()[0]
    kind = dict(pieces.dtypes)["conversation"]
    arrow_kind = None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal arrow_kind
        now, reader = None, None
        for batch in batches:
            arrow_kind = batch.schema.field("conversation").type
            done = []
            for name, piece, spans in zip(*(batch.column(c).to_pylist() for c in ("conversation", "piece", "spans"))):
                if reader is None or name != now:
                    if reader is not None:
                        done.append((now, *reader.result()))
                    now, reader = name, Reader(turn, opening, closing, template.protection)
                reader.feed(piece, [(s["start"], s["end"]) for s in spans])
            yield _digests(done, arrow_kind)
        if reader is not None:
            yield _digests([(now, *reader.result())], arrow_kind)

    ordered = pieces.repartition("conversation").sortWithinPartitions("conversation", "part", "turn", "piece")
    return ordered.select("conversation", "piece", "spans").mapInArrow(
        read, f"conversation {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def _digests(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["conversation", *DIGESTS])
