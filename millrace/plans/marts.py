"""Queries on the cleaned tables.

Each takes and returns DataFrames. Counts are aggregated map side before the one shuffle
on their key, so a key that holds much of the data costs no more than any other; a top-k is
taken per task and merged. Ties in a ranking go to the smaller key.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import contains_text, like_text
from millrace.functions.times import epoch_to_timestamp, minute_of
from millrace.operators.cleaning import keep_value
from millrace.schemas import UNKNOWN

Day = str | date


def count_by(df: DataFrame, key: Column, key_name: str, count_name: str) -> DataFrame:
    return df.groupBy(key.alias(key_name)).agg(F.count(F.lit(1)).alias(count_name))


def top(counts: DataFrame, key: str, count: str, k: int = 10) -> DataFrame:
    return counts.orderBy(F.desc(count), F.asc(key)).limit(k)


def top_places(events: DataFrame, k: int = 10) -> DataFrame:
    """Places named in most events: country, event_count."""
    place = F.col("Action_Geo_FullName")
    counts = count_by(events.filter(place != UNKNOWN), place, "country", "event_count")
    return top(counts, "country", "event_count", k)


def top_country_codes(events: DataFrame, k: int = 10) -> DataFrame:
    """Country codes with most events: country, events_count."""
    code = F.col("Action_Geo_Country_Code")
    counts = count_by(events.filter(code != UNKNOWN), code, "country", "events_count")
    return top(counts, "country", "events_count", k)


def edits_per_minute(edits: DataFrame, wiki: str = "enwiki") -> DataFrame:
    """Edits of one wiki per minute, in time order: minute_ts, cnt."""
    minute = minute_of(epoch_to_timestamp(F.col("timestamp")))
    return count_by(keep_value(edits, "wiki", wiki), minute, "minute_ts", "cnt").orderBy("minute_ts")


def place_list(events: DataFrame) -> DataFrame:
    """All place names in order: country."""
    place = F.col("Action_Geo_FullName")
    return events.filter(place.isNotNull()).select(place.alias("country")).distinct().orderBy("country")


def _day(df_column: str = "event_timestamp") -> Column:
    return F.col(df_column).cast("date")


def _in_days(start: Day, end: Day) -> Column:
    """Both ends included. Spark turns this into a range on the stored column."""
    return _day().between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def daily_events(events: DataFrame, country: str, start: Day, end: Day) -> DataFrame:
    """Events per day at one place: date, event_count."""
    chosen = events.filter((F.col("Action_Geo_FullName") == F.lit(country)) & _in_days(start, end))
    return count_by(chosen, _day(), "date", "event_count").orderBy("date")


def daily_mentions(
    edits: DataFrame,
    word: str,
    start: Day,
    end: Day,
    wiki: str = "enwiki",
    literal: bool = False,
) -> DataFrame:
    """Edits per day whose title mentions ``word``: date, edit_count.

    ``word`` is matched as ``LIKE '%word%'``, or character by character if ``literal``.
    """
    title = F.col("title")
    hit = contains_text(title, word) if literal else like_text(title, word)
    chosen = keep_value(edits, "wiki", wiki).filter(hit & _in_days(start, end))
    return count_by(chosen, _day(), "date", "edit_count").orderBy("date")


def total(daily: DataFrame, count: str) -> DataFrame:
    """Sum of a daily count, one row: total. 0 when there are no days."""
    return daily.agg(F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias("total"))


def top_event_types(events: DataFrame, k: int = 10) -> DataFrame:
    """Most common event codes: event_code, event_count."""
    counts = count_by(events, F.col("Event_Code"), "event_code", "event_count")
    return top(counts, "event_code", "event_count", k)


def peak_hours(edits: DataFrame, wiki: str = "enwiki") -> DataFrame:
    """Edits per hour of the day, busiest first: hour, edit_count."""
    hour = F.hour(epoch_to_timestamp(F.col("timestamp")))
    counts = count_by(keep_value(edits, "wiki", wiki), hour, "hour", "edit_count")
    return counts.orderBy(F.desc("edit_count"), "hour")


def latest(df: DataFrame, column: str) -> Column:
    """The greatest value of a column of ``df``, as a subquery Spark runs once."""
    return df.agg(F.max(column)).scalar()


def top_users(edits: DataFrame, k: int = 10, wiki: str = "enwiki", months: int | None = None) -> DataFrame:
    """Most active users: user, edit_count. ``months`` looks only that far back from the
    latest edit in the table."""
    chosen = keep_value(edits, "wiki", wiki)
    if months is not None:
        since = F.add_months(latest(chosen, "event_timestamp").cast("date"), -months)
        chosen = chosen.filter(_day() >= since)
    return top(count_by(chosen, F.col("user"), "user", "edit_count"), "user", "edit_count", k)


def last_month_places(events: DataFrame, k: int = 10, months: int = 1) -> DataFrame:
    """:func:`top_places` of the months before the latest event in the table."""
    since = F.add_months(latest(events, "event_timestamp"), -months)
    return top_places(events.filter(F.col("event_timestamp") >= since), k)


def daily_counts(df: DataFrame, count_name: str) -> DataFrame:
    return count_by(df.filter(_day().isNotNull()), _day(), "date", count_name)


def daily_correlation(events: DataFrame, edits: DataFrame) -> DataFrame:
    """Correlation of the daily counts of both feeds over their common days: r, n_days.

    Both sides are reduced to one row per day before they are joined.
    """
    left = daily_counts(events, "event_count")
    right = daily_counts(edits, "edit_count")
    return left.join(right, "date").agg(
        F.round(F.corr("event_count", "edit_count"), 6).alias("r"),
        F.count(F.lit(1)).alias("n_days"),
    )
