"""Strict cell parsers.

A parser is a factory: it takes the text column of one field and gives back two columns,
the typed value and an error message (NULL when the cell is good).  Spark's own casts are
laxer than the formats accepted here (blanks around numbers, ``1d``, silent overflow to
infinity), so a pattern guards every cast.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from bulkflow.functions.times import parse_by


class Parsed(NamedTuple):
    value: Column
    error: Column


Parser = Callable[[Column], Parsed]

_DIGITS = "[0-9]+(?:_[0-9]+)*"
# Accepted number formats.
INTEGER = r"\A[+-]?[0-9]+\z"
DECIMAL = rf"\A[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\z"
PLAIN = r"\A[+-]?[0-9]{1,300}(?:\.[0-9]{0,300})?\z"
HEXADECIMAL = r"\A[+-]?0[xX](?:[0-9a-fA-F]+(?:\.[0-9a-fA-F]*)?|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+\z"
SPECIAL = r"\A(?i:[+-]?inf(?:inity)?|nan)\z"


def no_error() -> Column:
    return F.lit(None).cast("string")


def integer_value(c: Column) -> Column:
    """64-bit integer or NULL."""
    return F.when(c.rlike(INTEGER), c.try_cast("bigint"))


def float_value(c: Column) -> Column:
    """Double or NULL; a finite literal too large for a double is NULL as well."""
    plain = F.replace(c, F.lit("_"), F.lit("")).try_cast("double")
    finite = F.when(F.abs(plain) < F.lit(float("inf")), plain)
    # Nearly all cells are plain decimals: the cheap pattern first, and no overflow is possible.
    return (
        F.when(c.rlike(PLAIN), c.try_cast("double"))
        .when(c.rlike(DECIMAL), finite)
        .when(c.rlike(SPECIAL), c.try_cast("double"))
        .when(c.rlike(HEXADECIMAL), finite)
    )


def number_is_integer(c: Column) -> Column:
    """True when a NUMBER cell is an exact 64-bit integer literal."""
    return integer_value(c).isNotNull()


def number_value(c: Column) -> Column:
    """NUMBER cell as a double; every integer literal is a float literal too."""
    return float_value(c)


def _checked(c: Column, value: Column, what: str, empty_is_null: bool = False) -> Parsed:
    text = F.coalesce(c, F.lit(""))
    bad = value.isNull()
    if empty_is_null:
        bad = bad & (text != "")
    message = F.concat(F.lit(f"invalid {what} '"), text, F.lit("'"))
    return Parsed(value, F.when(bad, message))


def parse_int(c: Column) -> Parsed:
    return _checked(c, integer_value(c), "integer")


def parse_float(c: Column) -> Parsed:
    return _checked(c, float_value(c), "float")


def parse_string(c: Column) -> Parsed:
    return Parsed(F.coalesce(c, F.lit("")), no_error())


def parse_nullable_string(c: Column) -> Parsed:
    return Parsed(F.nullif(c, F.lit("")), no_error())


def parse_nullable_int(c: Column) -> Parsed:
    return _checked(c, integer_value(c), "integer", empty_is_null=True)


def parse_number(c: Column) -> Parsed:
    return _checked(c, number_value(c), "NUMBER", empty_is_null=True)


def read_as(c: Column, kind: str) -> Column:
    """A cell read in a Spark type, maybe rounded; a whole type reads "17.0" by way of a decimal."""
    plain = F.replace(c, F.lit("_"), F.lit(""))
    return F.coalesce(plain.try_cast(kind), plain.try_cast("decimal(38,18)").try_cast(kind))


def parse_number_as(kind: str) -> Callable[..., Parsed]:
    """NUMBER cell in a given Spark type; a cell that the type cannot hold as it is is an error.

    ``number`` and ``read``: columns that already hold :func:`number_value` and :func:`read_as` of the cell.
    """

    def parse(c: Column, number: Column | None = None, read: Column | None = None) -> Parsed:
        number = number_value(c) if number is None else number
        read = read_as(c, kind) if read is None else read
        # A NULL number makes the comparison false.
        fits = F.coalesce(read.cast("double") == number, F.lit(False))
        value = F.when(fits, read)
        text = F.coalesce(c, F.lit(""))
        message = F.when(number.isNull(), F.concat(F.lit("invalid NUMBER '"), text, F.lit("'"))).otherwise(
            F.concat(F.lit(f"{kind} cannot hold '"), text, F.lit("'"))
        )
        return Parsed(value, F.when(~fits & (text != ""), message))

    return parse


def parse_timestamp(formats: list[str] | None = None) -> Parser:
    """Wall-clock time; ISO text when no format is given."""

    def parse(c: Column) -> Parsed:
        value = timestamp_value(c, formats)
        return _checked(c, value, "timestamp", empty_is_null=True)

    return parse


def timestamp_value(c: Column, formats: list[str] | None = None) -> Column:
    if not formats:
        return c.try_cast("timestamp_ntz")
    return F.coalesce(*[parse_by(c, f) for f in formats])


def constant(value: Column) -> Parser:
    """A column that does not come from the file."""
    return lambda _c: Parsed(value, no_error())


def from_function(value: Callable[[Column], Column], error: Callable[[Column], Column] | None = None) -> Parser:
    """Wrap any column function (built-in expression or pandas UDF) as a parser."""
    return lambda c: Parsed(value(c), error(c) if error else no_error())


def first_error(fields: list[tuple[str, Parsed]]) -> Column:
    """Message of the first bad field of a row in field order, NULL when the row is good."""
    return F.coalesce(*[F.concat(F.lit(f"{name}: "), p.error) for name, p in fields], no_error())


def gated_value(parsed: Parsed, previous: list[Parsed]) -> Column:
    """The value of a field, NULL once an earlier field of the same row was bad."""
    value = F.when(parsed.error.isNull(), parsed.value)
    for p in previous:
        value = F.when(p.error.isNull(), value)
    return value
