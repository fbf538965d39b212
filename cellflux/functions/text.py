"""Text / JSON column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_line(line: Column) -> Column:
    """trim and strip list-literal quoting ``[' ... ']``."""
    return F.regexp_replace(F.trim(line), r"^[\[\]' ]+|[\[\]' ]+$", "")


def field(line: Column, i: int, sep: str = ",") -> Column:
    """the i-th (0-based) comma field of a line, null if absent."""
    return F.get(F.split(line, sep), F.lit(i))


def no_spaces(col: Column) -> Column:
    """remove every space."""
    return F.replace(col, F.lit(" "), F.lit(""))


def parse_list_literal(col: Column) -> Column:
    """``"['a', 'b']"`` -> array<string> (quotes normalised to JSON)."""
    return F.from_json(F.regexp_replace(col, "'", '"'), "array<string>")


def join_list(col: Column, sep: str = ",") -> Column:
    """F8: array -> text."""
    return F.array_join(col, sep)


def number_text(x: Column) -> Column:
    """integral numbers without a fraction (7.0 -> "7"), others as is (7.5 -> "7.5")."""
    return F.when(x.isNull(), F.lit(None).cast("string")).when(
        x == F.floor(x), F.floor(x).cast("long").cast("string")
    ).otherwise(x.cast("string"))


def point_text(x: Column, y: Column) -> Column:
    """``"(x,y)"``."""
    return F.concat(F.lit("("), x.cast("string"), F.lit(","), y.cast("string"), F.lit(")"))


def glob_regex(pattern: str) -> str:
    """A shell wildcard (``*``, ``?``) as an anchored regular expression."""
    import re

    out = []
    for ch in pattern:
        out.append(".*" if ch == "*" else "." if ch == "?" else re.escape(ch))
    return "^" + "".join(out) + "$"


def matches_glob(name: Column, pattern: str) -> Column:
    """File name matches a wildcard (whole-name match, as ``fnmatch``)."""
    return name.rlike(glob_regex(pattern))


def base_name(path: Column) -> Column:
    """The last path component."""
    return F.regexp_extract(path, r"([^/]+)$", 1)
