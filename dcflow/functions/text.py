"""Whitespace and array-element scalars (all JVM-side column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.split() treats as separators are the
# Unicode White_Space set plus the four ASCII information separators 0x1C-0x1F.
# Java regex with (?U) gives the former for \s; the class adds the latter.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c: Column | str) -> Column:
    """Trim and squeeze every whitespace run to one blank (``" ".join(s.split())``)."""
    return F.trim(F.regexp_replace(_c(c), WHITESPACE_RUN, " "))


def first_value(arr: Column | str) -> Column:
    """First element, NULL for an empty or NULL array."""
    return F.get(_c(arr), 0)


def last_value(arr: Column | str) -> Column:
    """Last element (the later occurrence overwrites), NULL for empty or NULL."""
    return F.try_element_at(_c(arr), F.lit(-1))


def empty_if_null(arr: Column | str) -> Column:
    """A missing repeated element becomes an empty array."""
    return F.coalesce(_c(arr), F.array().cast("array<string>"))


def array_len(arr: Column | str) -> Column:
    """Number of elements; 0 for NULL whatever the session's ANSI setting
    (outside ANSI mode ``size(NULL)`` is -1)."""
    c = _c(arr)
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))
