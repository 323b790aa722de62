"""Identifier rules, on a column of names and on single names read from a header."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the length of a name.
MAX_NAME = 30

# The characters Unicode calls white space.
WHITE_SPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_space(c: Column) -> Column:
    """Trim Unicode white space on both sides (Spark's ``trim`` only knows the blank).

    Trimming by a character set walks over the whole text, so it is only done for cells
    that begin or end with white space.
    """
    edge = F.substring(c, 1, 1).isin(*WHITE_SPACE) | F.substring(c, -1, 1).isin(*WHITE_SPACE)
    return F.when(edge, F.btrim(c, F.lit(WHITE_SPACE))).otherwise(c)


def trim_to_null(c: Column) -> Column:
    """Trimmed text, NULL when nothing is left; a cell without outer white space costs two looks."""
    edge = F.substring(c, 1, 1).isin("", *WHITE_SPACE) | F.substring(c, -1, 1).isin(*WHITE_SPACE)
    return F.when(edge, F.nullif(F.btrim(c, F.lit(WHITE_SPACE)), F.lit(""))).otherwise(c)


def normalize_identifiers(c: Column) -> Column:
    """Loose rule: make any text a legal upper-case name, '' when nothing is left."""
    cleaned = F.upper(F.regexp_replace(trim_space(c), "[^A-Za-z0-9_]", "_"))
    lettered = F.when(cleaned.rlike("^[A-Z]"), cleaned).otherwise(F.concat(F.lit("X"), cleaned))
    return F.when(cleaned == "", F.lit("")).otherwise(F.substring(lettered, 1, MAX_NAME))


def identifier_errors(c: Column) -> Column:
    """Strict rule: NULL when the name is legal as it stands, else the reason."""
    return (
        F.when(c.isNull() | ~c.rlike(r"\A[A-Za-z][A-Za-z0-9_]*\z"), F.lit("identifier has illegal characters"))
        .when(F.length(c) > MAX_NAME, F.lit("identifier exceeds 30 characters"))
    )


def normalize_name(name: str) -> str:
    """The loose rule for one header cell."""
    # Fixed value: what a name may hold; all else becomes an underscore.
    cleaned = re.sub(r"[^A-Za-z0-9_]", "_", name.strip(WHITE_SPACE)).upper()
    if cleaned and not cleaned[0].isalpha():
        cleaned = "X" + cleaned
    return cleaned[:MAX_NAME]


def strict_name(name: str) -> str:
    """The strict rule for one name given in code; returns it in upper case."""
    # Fixed value: what a legal name looks like.
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]*", name):
        raise ValueError(f"identifier {name!r} has illegal characters")
    if len(name) > MAX_NAME:
        raise ValueError(f"identifier {name!r} exceeds {MAX_NAME} characters")
    return name.upper()
