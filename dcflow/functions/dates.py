"""Date and timestamp scalars. All values are TIMESTAMP_NTZ / DATE, so no
result depends on the session time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# The earliest day a backfill starts from when none is given,
# and the size of the look-back window of a recent harvest.
DEFAULT_BACKFILL_START = "2007-01-01"
RECENT_FROM_DAYS_BACK = 2
RECENT_UNTIL_DAYS_BACK = 1


def lit_date(d: str | _dt.date | Column | None) -> Column:
    """A date literal (ISO text parsed strictly; invalid text -> NULL)."""
    if d is None:
        return F.lit(None).cast("date")
    if isinstance(d, Column):
        return d
    if isinstance(d, _dt.datetime):
        d = d.date()
    if isinstance(d, _dt.date):
        return F.lit(d)
    return parse_iso_date(F.lit(d))


def lit_ts(ts: str | _dt.datetime | Column) -> Column:
    if isinstance(ts, Column):
        return ts
    if isinstance(ts, _dt.datetime):
        # through ISO text: a datetime literal would be a zoned TIMESTAMP and
        # its cast to TIMESTAMP_NTZ would depend on the session time zone
        ts = ts.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(ts).try_cast("timestamp_ntz")


def harvest_date(ts: Column | str) -> Column:
    """``DATE(header_datestamp)``."""
    return F.to_date(_c(ts))


def parse_datestamp(s: Column | str) -> Column:
    """Datestamp text -> TIMESTAMP_NTZ; day granularity gives midnight.

    A trailing ``Z`` (UTC, the protocol's only zone) is accepted; text that is
    not a valid date or time, or names no day, gives NULL instead of failing the job.
    """
    c = _c(s)
    return F.when(c.rlike(r"^\s*[+-]?\d{4,}-\d{1,2}-\d{1,2}"), c.try_cast("timestamp_ntz"))


def parse_iso_date(s: Column | str) -> Column:
    """Strict ``YYYY-MM-DD``; anything else (one-digit fields, times, junk) -> NULL."""
    c = _c(s)
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))


def day_range(d: Column | str, legacy: bool = False) -> tuple[Column, Column]:
    """One-day request window: ``d..d``, or ``d..d+1`` in the legacy form."""
    c = _c(d)
    return c, (F.date_add(c, 1) if legacy else c)


def recent_window(as_of: Column | str | _dt.date) -> tuple[Column, Column]:
    """``[as_of - 2 days, as_of - 1 day]``."""
    a = F.to_date(lit_date(as_of) if not isinstance(as_of, Column) else as_of)
    return F.date_sub(a, RECENT_FROM_DAYS_BACK), F.date_sub(a, RECENT_UNTIL_DAYS_BACK)


def backfill_bounds(start: str | None, end: str | None,
                    as_of: Column | str | _dt.date) -> tuple[Column, Column]:
    """Closed backfill range; default start is the fixed first day, default end
    is yesterday relative to ``as_of``."""
    a = F.to_date(lit_date(as_of) if not isinstance(as_of, Column) else as_of)
    lo = lit_date(start) if start is not None else lit_date(DEFAULT_BACKFILL_START)
    hi = lit_date(end) if end is not None else F.date_sub(a, 1)
    return lo, hi


def ordered_bounds(lo: Column, hi: Column) -> tuple[Column, Column]:
    """``(min, max)`` of two bounds; both NULL if either is NULL (``least``
    alone would skip the NULL and return the other bound)."""
    both = lo.isNotNull() & hi.isNotNull()
    return F.when(both, F.least(lo, hi)), F.when(both, F.greatest(lo, hi))


def days_between(lo: Column, hi: Column, end_inclusive: bool = True) -> Column:
    """Every day of a range as an array of dates.

    A reversed range is swapped; a half-open range drops the last day; a NULL
    bound gives an empty array.
    """
    a, b = ordered_bounds(lo, hi)
    if not end_inclusive:
        b = F.date_sub(b, 1)
    seq = F.when(a <= b, F.sequence(a, b, F.expr("INTERVAL 1 DAY")))
    return F.coalesce(seq, F.array().cast("array<date>"))
