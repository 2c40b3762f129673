"""Record filters and the SELECT/WHERE/ORDER BY/LIMIT template.

Predicates are plain column expressions so Catalyst can push them into the
Parquet scan: the date range is written on the timestamp itself (a range
``ts >= lo AND ts < hi + 1 day``), which the scan can prune with row-group
statistics. ``array_contains`` is not pushed to Parquet, so filter on dates
first where both apply (Catalyst keeps the pushable part either way).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_date
from ..functions.jsonfmt import array_to_json


def in_set(set_spec: str, col: str = "header_setSpecs") -> Column:
    """exact membership of ``set_spec`` in the record's set list."""
    return F.array_contains(F.col(col), F.lit(set_spec))


def set_like(set_spec: str, col: str = "header_setSpecs") -> Column:
    """``set_spec`` occurs anywhere in the JSON text of the set list.

    ``%`` and ``_`` in the name match themselves (a plain substring test).
    """
    return F.instr(array_to_json(col), set_spec) > 0


def set_predicate(set_spec: str, match: str = "exact", col: str = "header_setSpecs") -> Column:
    if match == "exact":
        return in_set(set_spec, col)
    if match == "substring":
        return set_like(set_spec, col)
    raise ValueError(f"match must be 'exact' or 'substring', not {match!r}")


def date_between(lo: str | _dt.date | Column | None, hi: str | _dt.date | Column | None,
                 col: str = "header_datestamp") -> Column:
    """``DATE(col) BETWEEN lo AND hi`` (inclusive), as a timestamp range."""
    ts = F.col(col)
    conds = []
    if lo is not None:
        conds.append(ts >= lit_date(lo).cast("timestamp_ntz"))
    if hi is not None:
        conds.append(ts < F.date_add(lit_date(hi), 1).cast("timestamp_ntz"))
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def list_records(df: DataFrame, set_spec: str | None = None, from_date=None, until_date=None,
                 match: str = "exact") -> DataFrame:
    """the selective-harvest arguments as a filter over stored records.

    Every argument is optional; an empty set name means no set restriction.
    """
    out = df
    if from_date is not None or until_date is not None:
        out = out.filter(date_between(from_date, until_date))
    if set_spec:
        out = out.filter(set_predicate(set_spec, match))
    return out


def subject_contains(subject: str, col: str = "metadata_subject") -> Column:
    """the record lists ``subject`` among its subjects."""
    return F.array_contains(F.col(col), F.lit(subject))


def select_where(df: DataFrame, *conds: Column) -> DataFrame:
    """the conjunction of the given predicates."""
    if not conds:
        return df
    return df.filter(reduce(lambda a, b: a & b, conds))


def order_by(df: DataFrame, col: str, asc: bool = True,
             tie_break: Sequence[str] = ()) -> DataFrame:
    """O1: one sort key (NULLs last ascending, first descending); optional
    unique tie-break columns make the order total."""
    key = F.col(col).asc_nulls_last() if asc else F.col(col).desc_nulls_first()
    return df.orderBy(key, *[F.col(t).asc() for t in tie_break])


def query(df: DataFrame, where: Sequence[Column] = (), order_col: str | None = None,
          asc: bool = True, limit: int | None = None, tie_break: Sequence[str] = ()) -> DataFrame:
    """O3 (with O2): ``SELECT * ... WHERE ... ORDER BY ... LIMIT`` in one call.

    ORDER BY + LIMIT plans as a top-k (``TakeOrderedAndProject``): each task
    keeps its best ``limit`` rows, so no full sort or shuffle of the input.
    """
    out = select_where(df, *where)
    if order_col is not None:
        out = order_by(out, order_col, asc, tie_break)
    if limit is not None:
        out = out.limit(int(limit))
    return out


def limit(df: DataFrame, n: int) -> DataFrame:
    """O2: at most ``n`` rows."""
    return df.limit(int(n))


@dataclass(frozen=True)
class Select:
    """The ``SELECT * FROM t WHERE .. ORDER BY .. LIMIT ..`` template as values.

    ``where`` adds a conjunct; a later ``order_by`` or ``limit`` replaces the
    earlier one. ``apply`` turns it into DataFrame operations (O3).
    """

    conds: tuple = ()
    order: tuple | None = None
    n: int | None = None

    def where(self, cond: Column) -> "Select":
        return replace(self, conds=self.conds + (cond,))

    def order_by(self, col: str, asc: bool = True) -> "Select":
        return replace(self, order=(col, asc))

    def limit(self, n: int) -> "Select":
        return replace(self, n=int(n))

    def apply(self, df: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
        col, asc = self.order if self.order else (None, True)
        return query(df, self.conds, col, asc, self.n, tie_break)
