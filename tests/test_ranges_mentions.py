"""Gaps as ranges, and mentions of all places at once."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import edits, plan
from pyspark.sql import functions as F

from millrace.operators import clean_edits
from millrace.plans.mentions import mentions_by_place
from millrace.sources.gap_ranges import gap_ranges

STEP = timedelta(minutes=15)


def frames(spark, start, end, slots):
    bounds = spark.createDataFrame([(start, end)], "start timestamp_ntz, end timestamp_ntz")
    return bounds, spark.createDataFrame([(s,) for s in slots], "slot timestamp_ntz")


def runs(start, end, slots):
    there, out, at = set(slots), [], start
    while at <= end:
        if at not in there:
            if out and out[-1][1] == at - STEP:
                out[-1] = (out[-1][0], at, out[-1][2] + 1)
            else:
                out.append((at, at, 1))
        at += STEP
    return out


def found(spark, start, end, slots):
    return [tuple(r) for r in gap_ranges(*frames(spark, start, end, slots)).orderBy("first").collect()]


def test_ranges_against_a_walk_over_the_calendar(spark):
    pick, start = random.Random(1), datetime(2024, 2, 27, 13, 15)
    end = start + 1500 * STEP
    slots = [start + pick.randrange(-50, 1550) * STEP for _ in range(900)] + [None, start - timedelta(days=4000)]
    slots = [s for s in slots if s is None or not datetime(2024, 3, 3) <= s < datetime(2024, 3, 6, 7)] * 2
    assert found(spark, start, end, slots) == runs(start, end, slots)


def test_long_holes_and_single_slots(spark):
    day = datetime(1999, 12, 31, 23, 45)
    late = datetime(2024, 5, 5)
    assert found(spark, day, late, [day, late]) == [(day + STEP, late - STEP, (late - day) // STEP - 1)]
    assert found(spark, day, day + 2 * STEP, [day, day + 2 * STEP]) == [(day + STEP, day + STEP, 1)]
    assert found(spark, day, late, []) == [(day, late, (late - day) // STEP + 1)]
    assert found(spark, day, day, [day]) == [] and found(spark, late, day, [late]) == []
    before = datetime(1960, 1, 1)
    assert found(spark, before, before + 3 * STEP, [before]) == [(before + STEP, before + 3 * STEP, 3)]
    none = spark.createDataFrame([(None, None)], "start timestamp_ntz, end timestamp_ntz")
    assert gap_ranges(none, frames(spark, day, day, [day])[1]).count() == 0
    with pytest.raises(ValueError, match="divide"):
        gap_ranges(none, none, minutes=7)


def test_mentions_against_like(spark):
    pick = random.Random(2)
    words = ["NATION_1", "NATION_12", "NATIONX1", "Unknown", "a%b", "aXXb", "Côte", "é", "ab", "", "page"]
    rows = [
        {"id": i, "title": " ".join(pick.choice(words) for _ in range(pick.randrange(4))) + "!", "timestamp": 1720000000 + 40000 * (i % 9)}
        for i in range(400)
    ]
    rows += [{"id": 900 + i, "title": None if i % 2 else "NATION_1 hot", "timestamp": 1720000000} for i in range(300)]
    silver = clean_edits(edits(spark, rows))
    names = ["NATION_1", "NATION_12", "a%b", "Côte", "é", "_", "%", "", "no such place", "Unknown", "page!", None, "NATION_1"]
    places = spark.createDataFrame([(n,) for n in names], "country string")
    first, last = "2024-07-04", "2024-07-06"
    got = mentions_by_place(silver, places, first, last)
    pairs = silver.withColumn("date", F.col("event_timestamp").cast("date")).join(
        places.distinct(), F.expr("title LIKE concat('%', country, '%')")
    )
    want = pairs.filter(F.col("date").between(first, last)).groupBy("country", "date").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 20
    shown = plan(got)
    assert "Cartesian" not in shown and "NestedLoop" not in shown
    assert mentions_by_place(silver, places.filter("country IS NULL"), first, last).count() == 0
