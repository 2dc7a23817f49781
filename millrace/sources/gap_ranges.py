"""Missing deliveries as ranges: a hole of any length is one row.

The calendar is not written out. Landed slots are put beside their successors within each
day, days beside the next day of their month that has slots, and months beside the next such
month; so no ordering ever holds more than the slots of a day, the days of a month or the
months there are, and a hole of years costs as much as a single missing slot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sources.intervals import STEP_MINUTES

_DAY_MINUTES = 24 * 60
_ORIGIN = "1970-01-01"


def _number(slot: Column, minutes: int) -> Column:
    """Slots since a fixed day, by the clock that timestamps without zone show."""
    days = F.datediff(F.to_date(slot), F.lit(_ORIGIN).cast("date")).cast("long")
    return F.floor((days * _DAY_MINUTES + F.hour(slot) * 60 + F.minute(slot)) / F.lit(minutes)).cast("long")


def _slot(number: Column, minutes: int) -> Column:
    total = number * minutes
    days, rest = F.floor(total / _DAY_MINUTES).cast("int"), F.pmod(total, F.lit(_DAY_MINUTES)).cast("int")
    return F.lit(_ORIGIN).cast("timestamp_ntz") + F.make_dt_interval(days=days, mins=rest)


def gap_ranges(bounds: DataFrame, landed: DataFrame, minutes: int = STEP_MINUTES) -> DataFrame:
    """Runs of slots from ``start`` to ``end`` (one row, both included) that did not arrive.

    Columns: first, last (timestamps without zone) and n, the slots missing. ``landed`` has a
    row or more per ``slot``; slots outside the bounds and NULL ones do not count. ``minutes``
    divides a day.
    """
    if _DAY_MINUTES % minutes:
        raise ValueError("the step must divide a day")
    start, end = _number(F.col("start"), minutes), _number(F.col("end"), minutes)
    span = bounds.filter("start <= end").select(start.alias("k0"), end.alias("k1"))
    known = landed.filter(F.col("slot").isNotNull()).select(_number(F.col("slot"), minutes).alias("k")).distinct()
    inside = known.filter((F.col("k") >= span.select("k0").scalar()) & (F.col("k") <= span.select("k1").scalar()))
    # What lies just outside the bounds counts as there.
    edges = span.select(F.explode(F.array(F.col("k0") - 1, F.col("k1") + 1)).alias("k")).distinct()
    day = F.floor(F.col("k") * minutes / _DAY_MINUTES).cast("int")
    present = inside.unionByName(edges).withColumn("day", day)

    def beside(rows: DataFrame, group: list[str], order: str) -> DataFrame:
        """The last slot of each row and the first of the next one of its group."""
        following = F.lead("low").over(Window.partitionBy(*group).orderBy(order))
        return rows.select(F.col("high").alias("a"), following.alias("b"))

    def summed(rows: DataFrame, by: Column, name: str) -> DataFrame:
        return rows.groupBy(by.alias(name)).agg(F.min("low").alias("low"), F.max("high").alias("high"))

    slots = present.select("day", F.col("k").alias("low"), F.col("k").alias("high"))
    days = summed(slots, F.col("day"), "day")
    date = F.date_add(F.lit(_ORIGIN).cast("date"), F.col("day"))
    days = days.withColumn("month", F.year(date) * 12 + F.month(date))
    months = summed(days, F.col("month"), "month").withColumn("all", F.lit(0))
    pairs = beside(slots, ["day"], "low").unionByName(beside(days, ["month"], "day")).unionByName(beside(months, ["all"], "month"))
    n = (F.col("b") - F.col("a") - 1).alias("n")
    return pairs.filter(F.col("b") > F.col("a") + 1).select(
        _slot(F.col("a") + 1, minutes).alias("first"), _slot(F.col("b") - 1, minutes).alias("last"), n
    )
