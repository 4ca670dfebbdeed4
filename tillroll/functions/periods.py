"""Calendar periods as half-open timestamp ranges.

``year(ts) = 2013`` hides the column inside a function, so only ``IsNotNull`` reaches the
parquet scan. The same condition written as ``ts >= 2013-01-01 AND ts < 2014-01-01``
is pushed down and prunes row groups by their min/max statistics.

Tables written by ``ingest(by_month=True)`` also carry ``_month`` (yyyymm), a partition
column; ``restrict`` then adds the matching ``_month`` range so whole month folders are
pruned before any file is opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD = "_month"  # yyyymm of the record's timestamp, a partition column when present


def year_bounds(year: int) -> tuple[dt.date, dt.date]:
    return dt.date(year, 1, 1), dt.date(year + 1, 1, 1)


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    start = dt.date(year, month, 1)
    end = dt.date(year + (month == 12), month % 12 + 1, 1)
    return start, end


def within(ts: Column | str, start: dt.date | None, end: dt.date | None) -> Column:
    """``start <= ts < end``; either bound may be None (open)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= F.lit(start))
    if end is not None:
        cond = cond & (ts < F.lit(end))
    return cond


def in_year(ts: Column | str, year: int) -> Column:
    return within(ts, *year_bounds(year))


def in_month(ts: Column | str, year: int, month: int) -> Column:
    return within(ts, *month_bounds(year, month))


def since_year(ts: Column | str, year: int) -> Column:
    return within(ts, dt.date(year, 1, 1), None)


def month_key(ts: Column | str) -> Column:
    """yyyymm as an int, the value of the ``_month`` partition column."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.year(ts) * 100 + F.month(ts)


def restrict(
    df: DataFrame, ts: str, start: dt.date | None, end: dt.date | None
) -> DataFrame:
    """Rows of ``df`` with ``start <= ts < end``, plus partition pruning on ``_month``."""
    cond = within(ts, start, end)
    if PERIOD in df.columns:
        if start is not None:
            cond = cond & (F.col(PERIOD) >= start.year * 100 + start.month)
        if end is not None:
            last = end - dt.timedelta(days=1)
            cond = cond & (F.col(PERIOD) <= last.year * 100 + last.month)
    return df.filter(cond)
