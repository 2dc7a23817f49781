"""Rankings from short summaries: bounds, ranks that are settled, merging."""

import random
from collections import Counter

import pytest
from helpers import plan
from pyspark.sql import functions as F

from millrace.plans import leaders as L

KINDS = "day int, place string"


def drawn(seed, n=3000):
    pick = random.Random(seed)
    places = [None, *(f"p{i:02d}" for i in range(60))]
    weights = [5, *(200 / (i + 1) for i in range(60))]
    return [(pick.choice([None, *range(12)]), pick.choices(places, weights)[0]) for _ in range(n)]


def order(item):
    value, n = item
    return (-n, value is not None, value or "")


def exact(rows):
    return sorted(Counter(p for _, p in rows).items(), key=order)


def checked(summary, rows, k):
    """The ranking, after a comparison of its bounds and settled ranks with the rows."""
    got, want = L.ranking(summary, k).collect(), exact(rows)
    counts = dict(want)
    for rank, r in enumerate(got):
        assert r.least <= counts[r.value] <= r.most
        assert not r.settled or want[rank][0] == r.value
    assert [(r.least, r.value) for r in got] == sorted(((r.least, r.value) for r in got), key=lambda x: order(x[::-1]))
    return got


@pytest.mark.parametrize("size", [1, 5, 15, 100])
def test_bounds_and_settled_ranks(spark, size):
    rows = drawn(size)
    days = L.summarise(spark.createDataFrame(rows, KINDS), F.col("place"), F.col("day"), size)
    longer = L.merge(days, F.floor(F.col("period") / 5), size)
    twice = L.merge(longer, F.lit("all"), size)
    for summary in (days, longer, twice):
        assert summary.groupBy("period").count().filter(F.col("count") > size).count() == 0
        got = checked(summary, rows, 8)
        if size == 100:  # nothing left out: the exact ranking
            assert [(r.value, r.least) for r in got] == exact(rows)[:8]
            assert all(r.settled and r.least == r.most for r in got)
    if size == 15:
        assert sum(r.settled for r in checked(days, rows, 8)) >= 2


def test_every_value_left_out_stays_below_the_rest(spark):
    rows = drawn(7)
    counts = Counter(rows)
    listed = {}
    for r in L.summarise(spark.createDataFrame(rows, KINDS), F.col("place"), F.col("day"), 4).collect():
        listed.setdefault(r.period, {})[r.value] = (r.least, r.most, r.rest)
    for (day, place), n in counts.items():
        rest = next(iter(listed[day].values()))[2]
        assert listed[day][place] == (n, n, rest) if place in listed[day] else n <= rest


def test_ties_go_to_the_smaller_value(spark):
    rows = [(d, p) for d in range(3) for p in "dcba"]
    days = L.summarise(spark.createDataFrame(rows, KINDS), F.col("place"), F.col("day"), 9)
    assert [tuple(r) for r in L.ranking(days, 2).collect()] == [("a", 3, 3, True), ("b", 3, 3, True)]
    # b may be as frequent as a, and comes after it; what is not listed may be named anyhow.
    cut = L.summarise(spark.createDataFrame(rows, KINDS), F.col("place"), F.col("day"), 1)
    assert [tuple(r) for r in L.ranking(cut, 2).collect()] == [("a", 3, 3, False)]


def test_empty_tables(spark):
    none = L.summarise(spark.createDataFrame([], KINDS), F.col("place"), F.col("day"))
    assert none.collect() == [] and L.merge(none, F.lit(1)).collect() == [] and L.ranking(none).collect() == []


def test_days_are_cut_before_they_are_ordered_together(spark):
    text = plan(L.summarise(spark.range(10).selectExpr("id AS day", "id AS place"), F.col("place"), F.col("day"), 5))
    assert "WindowGroupLimit" in text and "Python" not in text and "Cartesian" not in text
