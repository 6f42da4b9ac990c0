"""Column expressions over text. All of them stay inside generated code."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_JSON_ARRAY = "[]"


def quote(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contains_any(column: str, terms: Iterable[str], prefixes: Iterable[str] = ()) -> str:
    """SQL condition: any term occurs in the column, or it starts with one of ``prefixes``.

    Word lists are long, so they become one SQL text instead of many small column
    calls. A term that has another listed term inside it adds nothing and is left out.
    """
    terms = list(terms)
    needed = [t for t in terms if not any(o != t and o in t for o in terms)]
    tests = [f"contains({column}, {quote(t)})" for t in needed]
    tests += [f"startswith({column}, {quote(p)})" for p in prefixes]
    return "(" + (" OR ".join(tests) or "false") + ")"


def blank_to_null(c: Column) -> Column:
    """NULL where the text is empty or white space only; otherwise unchanged."""
    return F.when(c.rlike(r"\S"), c)


# The characters that count as white space at the ends of a text
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.trim(c, F.lit(WHITE_SPACE))


def null_literal_to_null(c: Column, literals: Iterable[str] = ("", "null")) -> Column:
    """NULL where the lower-cased text is one of the literals that stand for nothing."""
    return F.when(~F.lower(c).isin(*literals), c)


def fill(template: str, **columns: Column) -> Column:
    """Concatenate a sentence with ``{name}`` places and the columns named there."""
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            parts.append(columns[piece])
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def json_array(c: Column) -> Column:
    """Parse a JSON array of strings; NULL for anything else."""
    return F.from_json(c, "array<string>")
