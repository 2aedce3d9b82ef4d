"""Time expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text format of event times in the raw feeds, and its plain shape.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_PLAIN = r"^[1-9]\d{3}-\d\d-\d\d \d\d:\d\d:\d\d$"


def parse_event_time(name: str) -> Column:
    """Unparsable text becomes NULL, also under ANSI mode.

    Text of the plain shape is cast, which reads it several times faster than a
    pattern does and to the same instant; anything else meets the pattern.
    """
    text = F.col(name)
    return F.when(text.rlike(_PLAIN), text.try_cast("timestamp")).otherwise(
        F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT)))


def clock(now: dt.datetime | None) -> Column:
    """The job's clock; a fixed instant makes a run reproducible."""
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


def day_key(day: Column) -> Column:
    """A date as the integer yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def days_between(as_of: Column, earlier: Column) -> Column:
    return F.datediff(as_of, F.to_date(earlier))
