"""Regular expressions in the RE2 dialect on Spark's engine: ASCII word boundaries, RE2's white space, ends of text and of lines at \\n only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = "0-9A-Za-z_"
_EDGE = f"(?:(?<![{_WORD}])(?=[{_WORD}])|(?<=[{_WORD}])(?![{_WORD}]))"
_BLANK = "\\t\\n\\f\\r "


def java(pattern: str) -> str:
    """The same pattern for Java: \\b, \\s, \\S and a bare $ mean there what they mean in RE2."""
    lines = pattern.startswith("(?m)")
    out, inside, i = [], False, 0
    while i < len(pattern):
        c, two = pattern[i], pattern[i : i + 2]
        if two == "\\s":
            out.append(_BLANK if inside else f"[{_BLANK}]")
        elif two == "\\S" and not inside:
            out.append(f"[^{_BLANK}]")
        elif two == "\\b":
            out.append(_EDGE)
        elif c == "\\":
            out.append(two)
        elif c == "$" and not inside and not lines:
            out.append("\\z")
        else:
            out.append("\\[" if c == "[" and inside else c)  # Java would read another class
            inside = c == "[" or inside and c != "]"
        i += 2 if c == "\\" else 1
    return "(?d)" + "".join(out)


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(java(pattern))


def count(text: Column, pattern: str) -> Column:
    """Characters of a class: by what its removal takes away, which makes no list of matches."""
    return F.length(text) - F.length(F.regexp_replace(text, F.lit(f"(?d)(?:{java(pattern)[4:]})+"), F.lit("")))


def replace(text: Column, pattern: str, by: str = "") -> Column:
    """by refers to groups as $1."""
    return F.regexp_replace(text, F.lit(java(pattern)), F.lit(by))


def quoted(x: str) -> str:
    """A string of DuckDB's SQL."""
    return "'" + x.replace("'", "''") + "'"


def sql_matches(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {quoted(pattern)})"


def sql_count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, {quoted(pattern)}))"


def sql_replace(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, {quoted(pattern)}, {quoted(by.replace('$', chr(92)))}, 'g')"
