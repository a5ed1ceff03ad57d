"""Time helpers that do not depend on the session time zone.

Order data carries ``TIMESTAMP_NTZ`` values (wall-clock, no zone).  Spark's
``date_trunc`` returns a zoned ``TIMESTAMP``, so hour buckets are rebuilt
from their NTZ fields instead.  Day differences count calendar days
(23:00 -> 01:00 next day is 1 day), as the warehouse ``DATEDIFF('day')``
does.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_ntz(value: str | _dt.datetime | _dt.date) -> Column:
    """TIMESTAMP_NTZ literal."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.to_timestamp_ntz(F.lit(text))


def as_of_col(as_of: str | _dt.datetime | Column | None) -> Column:
    """The query's reference time; ``None`` means now (session wall clock)."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    return ts_ntz(as_of)


def hour_floor(c: Column | str) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, result TIMESTAMP_NTZ."""
    x = F.col(c) if isinstance(c, str) else c
    return F.make_timestamp_ntz(F.year(x), F.month(x), F.dayofmonth(x), F.hour(x),
                                F.lit(0), F.lit(0))


def calendar_days(start: Column | str, end: Column | str) -> Column:
    """Calendar days from ``start`` to ``end`` (day boundaries crossed)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.datediff(F.to_date(e), F.to_date(s))


def epoch_seconds(c: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ (fraction dropped)."""
    x = F.col(c) if isinstance(c, str) else c
    days = F.datediff(F.to_date(x), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(x) * 3600 + F.minute(x) * 60 + F.second(x)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Second boundaries crossed from ``start`` to ``end``."""
    return epoch_seconds(end) - epoch_seconds(start)
