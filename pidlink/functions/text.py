"""Column-expression helpers. All JVM-side built-ins: no Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.split() splits on any Unicode blank (including the four separators
# U+001C..U+001F, which Java's Unicode \s lacks) and drops empty tokens.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(c: str | Column) -> Column:
    """Whitespace tokens of a text cell, empties dropped; NULL cell -> empty array."""
    return F.filter(F.split(F.coalesce(col_(c), F.lit("")), WHITESPACE), lambda t: t != "")


def strip_prefix(c: str | Column, prefix: str) -> Column:
    """str.removeprefix(prefix): case-sensitive, only when the text starts with it."""
    c = col_(c)
    return F.when(c.startswith(prefix), c.substr(F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def bracket_content(c: str | Column, last: bool = False) -> Column:
    """Python ``v[v.index('[') + 1:v.index(']')]``; NULL when a bracket is missing.

    ``last=True`` reads the last ``[...]`` instead (the first ``]`` after the last ``[``), for
    names that contain brackets themselves.
    """
    c = col_(c)
    if last:
        s = F.when(F.instr(c, "[") > 0, F.length(c) - F.instr(F.reverse(c), "[") + 1).otherwise(F.lit(0))
        after = F.instr(c.substr(s + 1, F.length(c)), "]")
        e = F.when((s > 0) & (after > 0), s + after).otherwise(F.lit(0))
    else:
        s = F.instr(c, "[")
        e = F.instr(c, "]")
    length = e - s - 1
    body = F.when(length > 0, c.substr(s + 1, length)).otherwise(F.lit(""))
    return F.when((s > 0) & (e > 0), body)


def last_with_prefix(arr: Column, prefix: str) -> Column:
    """Last element of ``arr`` starting with ``prefix``; NULL if none."""
    return F.try_element_at(F.filter(arr, lambda t: t.startswith(prefix)), F.lit(-1))


def without_prefix(arr: Column, prefix: str) -> Column:
    return F.filter(arr, lambda t: ~t.startswith(prefix))


def scheme(c: str | Column) -> Column:
    """Scheme of a prefixed identifier: text before the first ':'."""
    return F.substring_index(col_(c), ":", 1)


def non_blank(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def join_sorted(arr: Column, sep: str = " ") -> Column:
    return F.array_join(F.array_sort(F.array_distinct(arr)), sep)
