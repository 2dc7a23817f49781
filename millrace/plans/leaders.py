"""Rankings over any range of days from short summaries, with stated error.

A summary holds, per period, the ``size`` values with most rows. For each it says how often the
value occurs at least and at most, and for the period how often any value left out may occur
(``rest``). Summaries of any periods merge into those of longer ones, and into a ranking,
without the rows behind them: what a period does not list occurs in it 0 to ``rest`` times. A
place of the ranking is ``settled`` if no count within the bounds would change it.

A period is reduced to its values, map side first, and to ``size`` of them per task, before
any are ordered; a ranking orders 2k + 1 values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.schemas import UNKNOWN

SIZE = 1000


def _longest(counted: DataFrame, size: int) -> DataFrame:
    """Cut (period, value, least, most, rest) to the ``size`` greatest ``most`` of a period."""
    order = Window.partitionBy("period").orderBy(F.desc("most"), F.asc("value"))
    ranked = counted.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= size + 1)
    left_out = F.max(F.when(F.col("_rank") > size, F.col("most"))).over(Window.partitionBy("period"))
    ranked = ranked.withColumn("rest", F.greatest("rest", F.coalesce(left_out, F.lit(0))))
    return ranked.filter(F.col("_rank") <= size).drop("_rank")


def summarise(rows: DataFrame, value: Column, period: Column, size: int = SIZE) -> DataFrame:
    """One summary per period: period, value, least, most (equal here), rest.

    NULL is a value and a period like any other; of equal counts the smaller value is listed.
    An empty table gives an empty summary.
    """
    counts = rows.groupBy(period.alias("period"), value.alias("value")).agg(F.count(F.lit(1)).alias("least"))
    none = F.lit(0).cast("bigint").alias("rest")
    return _longest(counts.select("period", "value", "least", F.col("least").alias("most"), none), size)


def _added(summary: DataFrame, period: Column) -> DataFrame:
    """The summaries of each longer period as one, not cut."""
    held = summary.withColumn("_into", period)
    rests = held.groupBy("_into", "period").agg(F.max("rest").alias("rest"))
    rests = rests.groupBy(F.col("_into").alias("_of")).agg(F.sum("rest").alias("_all"))
    sums = held.groupBy("_into", "value").agg(
        F.sum("least").alias("least"), F.sum(F.col("most") - F.col("rest")).alias("_over")
    )
    both = sums.join(rests, F.col("_into").eqNullSafe(F.col("_of")))
    most = (F.col("_over") + F.col("_all")).alias("most")
    return both.select(F.col("_into").alias("period"), "value", "least", most, F.col("_all").alias("rest"))


def merge(summary: DataFrame, period: Column, size: int = SIZE) -> DataFrame:
    """Summaries of longer periods, ``period`` being an expression over the shorter ones."""
    return _longest(_added(summary, period), size)


def ranking(summary: DataFrame, k: int = 10) -> DataFrame:
    """The first k values over all periods of ``summary``: value, least, most, settled.

    They are ordered by ``least``, ties by the smaller value. The rank of a settled row is that
    of its value among all rows behind the summary, where ties go to the smaller value too.
    """
    added = _added(summary, F.lit(0)).select("value", "least", "most", "rest")
    first = added.orderBy(F.desc("least"), F.asc("value")).limit(k)
    # Whatever the first r <= k are, the strongest of the others is among the k + 1 strongest.
    strongest = added.orderBy(F.desc("most"), F.asc("value")).limit(k + 1)
    few = first.union(strongest).distinct()
    order = Window.orderBy(F.desc("least"), F.asc("value"))
    after = order.rowsBetween(1, Window.unboundedFollowing)
    rival = F.min(F.struct(-F.col("most"), F.col("value"))).over(after)
    mine = F.struct(-F.col("least"), F.col("value"))
    parted = (F.col("rest") == 0) | (F.col("least") > F.col("rest"))
    few = few.withColumn("_rank", F.row_number().over(order))
    few = few.withColumn("_parted", parted & F.coalesce(mine < rival, F.lit(True)))
    few = few.withColumn("settled", F.col("_parted") & F.lag("_parted", 1, True).over(order))
    return few.filter(F.col("_rank") <= k).orderBy("_rank").select("value", "least", "most", "settled")


def place_summary(events: DataFrame, size: int = SIZE) -> DataFrame:
    """Summary of the places of each day's events, the day as ``period``."""
    place = F.col("Action_Geo_FullName")
    return summarise(events.filter(place != UNKNOWN), place, F.col("event_timestamp").cast("date"), size)


def top_places_of(summary: DataFrame, k: int = 10, start=None, end=None) -> DataFrame:
    """:func:`~millrace.plans.marts.top_places` of some days, both ends included, from their
    summaries: country, event_count (at least), most, settled."""
    day = F.col("period")
    if start is not None:
        summary = summary.filter(day >= F.lit(start).cast("date"))
    if end is not None:
        summary = summary.filter(day <= F.lit(end).cast("date"))
    return ranking(summary, k).withColumnsRenamed({"value": "country", "least": "event_count"})
