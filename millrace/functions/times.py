"""Date and time conversions used when cleaning and querying."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yyyymmdd_to_date(number: Column) -> Column:
    """Integer such as 20240705 to a date; an impossible date gives NULL, not an error."""
    return F.try_to_date(number.cast("string"), "yyyyMMdd")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Seconds since the epoch to a timestamp."""
    return F.timestamp_seconds(seconds)


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts)
