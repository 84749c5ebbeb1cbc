"""Time expressions shared by the real-time models.

``as_of`` is always a parameter (a Python datetime turned into a literal),
never ``current_timestamp()`` inside a model: results are reproducible and
the bounds reach the parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"second": "seconds", "minute": "minutes", "hour": "hours",
          "day": "days", "week": "weeks"}


def to_timedelta(span) -> dt.timedelta:
    """``"24 hours"``, ``"5 minutes"``, ``"1 hour"`` or a timedelta."""
    if isinstance(span, dt.timedelta):
        return span
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day|week)s?\s*", str(span).lower())
    if not m:
        raise ValueError(f"cannot read time span {span!r}")
    return dt.timedelta(**{_UNITS[m.group(2)]: int(m.group(1))})


def trailing(col: str | Column, as_of: dt.datetime, span) -> Column:
    """``col >= as_of - span``; no upper bound, so future-dated rows pass."""
    c = F.col(col) if isinstance(col, str) else col
    return c >= F.lit(as_of - to_timedelta(span))


def same_day(col: str | Column, as_of: dt.datetime) -> Column:
    """``DATE(col) = DATE(as_of)`` written as a half-open range so that it
    prunes row groups and date partitions."""
    c = F.col(col) if isinstance(col, str) else col
    start = dt.datetime.combine(as_of.date(), dt.time())
    return (c >= F.lit(start)) & (c < F.lit(start + dt.timedelta(days=1)))


def hour_text(col: str | Column) -> Column:
    """``'YYYY-MM-DD HH:00:00'`` text of the hour a timestamp falls in."""
    return F.date_format(col, "yyyy-MM-dd HH:00:00")


def whole_minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole elapsed minutes from ``start`` to ``end`` (truncated)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("MINUTE", s, e)


def local_time(col: str | Column, tz: str = "UTC") -> Column:
    """Wall-clock time of a UTC timestamp in ``tz``."""
    c = F.col(col) if isinstance(col, str) else col
    return c if tz.upper() == "UTC" else F.from_utc_timestamp(c, tz)


PARTITION_DATE = "event_date"


def since(df, as_of: dt.datetime, span, col: str = "event_time"):
    """Rows of ``df`` at or after ``as_of - span``. When the table carries the
    ``event_date`` partition column, the matching date bound is added so the
    scan skips older partitions (Catalyst does not derive it from the time
    predicate)."""
    lo = as_of - to_timedelta(span)
    out = df.where(F.col(col) >= F.lit(lo))
    if PARTITION_DATE in df.columns:
        out = out.where(F.col(PARTITION_DATE) >= F.lit(lo.date()))
    return out


def on_day(df, as_of: dt.datetime, col: str = "event_time"):
    """Rows of ``df`` on the calendar day of ``as_of`` (with the partition
    bound when ``event_date`` is present)."""
    out = df.where(same_day(col, as_of))
    if PARTITION_DATE in df.columns:
        out = out.where(F.col(PARTITION_DATE) == F.lit(as_of.date()))
    return out


def latest_event_time(df, col: str = "event_time"):
    """The newest event time, as one scalar for use as ``as_of``.

    On a table partitioned by ``event_date`` only the newest day is scanned
    for it (the newest day itself comes from the partition column, which
    reads no data column)."""
    if PARTITION_DATE in df.columns:
        day = df.agg(F.max(PARTITION_DATE).alias("d")).first()["d"]
        if day is None:
            return None
        df = df.where(F.col(PARTITION_DATE) == F.lit(day))
    return df.agg(F.max(col).alias("m")).first()["m"]
