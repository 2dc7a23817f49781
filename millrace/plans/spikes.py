"""Spikes of daily counts, and how one feed's days follow those of another.

A day is a spike when its count lies far above the median of the days before it, measured by
the median deviation of those days, which a single earlier spike does not move. Days without
rows count 0. The days before are held as one short array per day, so the work is a window
over daily counts, whatever the number of rows behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.marts import daily_counts

SPAN_DAYS = 14
LEAST_DAYS = 5
THRESHOLD = 3
MAX_LAG_DAYS = 3

_EPOCH = "1970-01-01"
# Days that are ordered together: a long series is cut into parts, each with the days before it.
_PART_DAYS = 3650


def _median(values: Column) -> Column:
    """Median of an array that is not empty."""
    ordered, n = F.array_sort(values), F.size(values)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / F.lit(2.0)


def spikes(
    daily: DataFrame,
    count: str,
    by: Sequence[str] = (),
    *,
    span: int = SPAN_DAYS,
    least: int = LEAST_DAYS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``daily`` (``by``, date, ``count``) with median, deviation and is_spike.

    Both figures are over the ``span`` days before, as far as the whole table reaches back.
    A day is a spike if its count is at least ``threshold`` deviations, of 1 or more each,
    above the median. Where fewer than ``least`` days lie before it, the figures are NULL and
    it is none. NULL is a key like any other; a row without a date is left out, and one
    without a count counts 0. Several rows of a day are summed.
    """
    keys = [F.col(f"`{c}`") for c in by]
    rows = daily.filter(F.col("date").isNotNull()).groupBy(*keys, "date").agg(F.coalesce(F.sum(count), F.lit(0)).alias(count))
    day = F.datediff("date", F.lit(_EPOCH).cast("date"))
    rows = rows.withColumn("_day", day)
    first = rows.agg(F.min("_day")).scalar()
    # A row is at home in one part, and goes along to the next if days there look back on it.
    part = F.floor(F.col("_day") / _PART_DAYS).cast("int")
    seen_from = F.floor((F.col("_day") + span) / _PART_DAYS).cast("int")
    rows = rows.withColumn("_home", part).withColumn("_part", F.explode(F.sequence("_home", seen_from)))
    before = Window.partitionBy(*keys, "_part").orderBy("_day").rangeBetween(-span, -1)
    rows = rows.withColumn("_held", F.collect_list(count).over(before)).filter("_part = _home")
    known = F.least(F.lit(span), F.col("_day") - first)
    quiet = F.array_repeat(F.lit(0).cast("bigint"), known - F.size("_held"))
    rows = rows.withColumn("_known", known).withColumn("_before", F.concat("_held", quiet))
    enough = F.col("_known") >= least
    rows = rows.withColumn("median", F.when(enough, _median(F.col("_before"))))
    apart = F.transform("_before", lambda v: F.abs(v - F.col("median")))
    rows = rows.withColumn("deviation", F.when(enough, _median(apart)))
    far = F.col(count) - F.col("median") >= threshold * F.greatest("deviation", F.lit(1.0))
    return rows.select(*keys, "date", count, "median", "deviation", F.coalesce(far, F.lit(False)).alias("is_spike"))


def spike_lags(events: DataFrame, edits: DataFrame, max_lag: int = MAX_LAG_DAYS, **settings) -> DataFrame:
    """How edits follow events, for each lag of days from ``-max_lag`` to ``max_lag``.

    One row per lag: lag, r (correlation of a day's events with the edits ``lag`` days later,
    NULL if either does not vary), n_days (days on which both are known), event_spikes (spikes
    of events on such days) and answered (of these, those with a spike of edits after the lag).
    Both sides are reduced to one row per day before they are joined.
    """
    left = spikes(daily_counts(events, "event_count"), "event_count", **settings)
    right = spikes(daily_counts(edits, "edit_count"), "edit_count", **settings)
    lags = F.explode(F.sequence(F.lit(-max_lag), F.lit(max_lag))).alias("lag")
    left = left.select("date", "event_count", F.col("is_spike").alias("rose"), lags)
    left = left.withColumn("date", F.date_add("date", F.col("lag")))
    right = right.select("date", "edit_count", F.col("is_spike").alias("followed"))
    return (
        left.join(right, "date")
        .groupBy("lag")
        .agg(
            F.round(F.corr("event_count", "edit_count"), 6).alias("r"),
            F.count(F.lit(1)).alias("n_days"),
            F.count_if("rose").alias("event_spikes"),
            F.count_if(F.col("rose") & F.col("followed")).alias("answered"),
        )
    )


def place_spikes(events: DataFrame, **settings) -> DataFrame:
    """:func:`spikes` of the daily events of every place: country, date, event_count, ..."""
    place, day = F.col("Action_Geo_FullName").alias("country"), F.col("event_timestamp").cast("date").alias("date")
    daily = events.groupBy(place, day).agg(F.count(F.lit(1)).alias("event_count"))
    return spikes(daily, "event_count", ["country"], **settings)
