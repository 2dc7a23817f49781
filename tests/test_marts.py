import datetime as dt
from collections import Counter

import pytest
from helpers import edits, events
from pyspark.sql import functions as F

from millrace.operators import clean_edits, clean_events, create_masked_view, mask_events
from millrace.plans import (
    daily_correlation,
    daily_events,
    daily_mentions,
    edits_per_minute,
    last_month_places,
    peak_hours,
    place_list,
    sql_daily_events,
    sql_daily_mentions,
    sql_edits_per_minute,
    sql_place_list,
    sql_top_places,
    top_country_codes,
    top_event_types,
    top_places,
    top_users,
    total,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def silver_events(spark):
    data = []
    for name, day, n in (
        ("Cote d'Ivoire", 20240705, 3),
        ("Cote d'Ivoire", 20240706, 2),
        ("Aland", 20240601, 5),
        ("Zed", 20240706, 1),
        (None, 20240706, 9),
    ):
        data += [{"Action_Geo_FullName": name, "SQL_Date": day, "Action_Geo_Country_Code": name and name[:2]}] * n
    return clean_events(events(spark, data)).cache()


@pytest.fixture(scope="module")
def silver_edits(spark):
    data = [
        {"id": 1, "timestamp": 1720000000, "title": "NATION_1 page", "user": "a"},
        {"id": 2, "timestamp": 1720000019, "title": "NATIONX1 page", "user": "b"},
        {"id": 3, "timestamp": 1720000020, "title": "Other", "user": "b"},
        {"id": 4, "timestamp": 1720090000, "title": "about NATION_1", "user": "a"},
        {"id": 5, "timestamp": 1720090000, "title": "NATION_1", "user": "a", "wiki": "dewiki"},
    ]
    return clean_edits(edits(spark, data), wiki=None).cache()


def test_rankings_break_ties_by_key(spark, silver_events):
    assert rows(top_places(silver_events, 2)) == [("Aland", 5), ("Cote d'Ivoire", 5)]
    assert rows(top_places(silver_events, 1)) == [("Aland", 5)]
    assert rows(top_country_codes(silver_events)) == [("Al", 5), ("Co", 5), ("Ze", 1)]
    assert rows(top_event_types(silver_events)) == [("057", 20)]


def test_place_list_is_sorted_and_has_unknown(silver_events):
    assert rows(place_list(silver_events)) == [("Aland",), ("Cote d'Ivoire",), ("Unknown",), ("Zed",)]


def test_daily_events(silver_events):
    name = "Cote d'Ivoire"
    daily = daily_events(silver_events, name, "2024-07-05", dt.date(2024, 7, 6))
    assert rows(daily) == [(dt.date(2024, 7, 5), 3), (dt.date(2024, 7, 6), 2)]
    assert rows(total(daily, "event_count")) == [(5,)]
    assert rows(daily_events(silver_events, name, "2024-07-06", "2024-07-06")) == [(dt.date(2024, 7, 6), 2)]
    empty = daily_events(silver_events, name, "1999-01-01", "1999-02-01")
    assert rows(empty) == [] and rows(total(empty, "event_count")) == [(0,)]


def test_last_month_counts_back_from_the_latest_event(silver_events):
    assert rows(last_month_places(silver_events)) == [("Cote d'Ivoire", 5), ("Zed", 1)]


def test_edits_per_minute(silver_edits):
    got = rows(edits_per_minute(silver_edits))
    assert got == [
        (dt.datetime(2024, 7, 3, 9, 46), 2),
        (dt.datetime(2024, 7, 3, 9, 47), 1),
        (dt.datetime(2024, 7, 4, 10, 46), 1),
    ]


def test_daily_mentions(silver_edits):
    args = ("NATION_1", "2024-07-01", "2024-07-31")
    assert rows(daily_mentions(silver_edits, *args)) == [(dt.date(2024, 7, 3), 2), (dt.date(2024, 7, 4), 1)]
    assert rows(daily_mentions(silver_edits, *args, literal=True)) == [
        (dt.date(2024, 7, 3), 1),
        (dt.date(2024, 7, 4), 1),
    ]
    assert rows(daily_mentions(silver_edits, "x'y", *args[1:])) == []


def test_hours_and_users(silver_edits):
    assert rows(peak_hours(silver_edits)) == [(9, 3), (10, 1)]
    assert rows(top_users(silver_edits)) == [("a", 2), ("b", 2)]
    assert rows(top_users(silver_edits, wiki="dewiki")) == [("a", 1)]


def test_recent_users_only(spark):
    data = [{"user": "old", "timestamp": 1700000000}] * 3 + [{"user": "new", "timestamp": 1720000000}]
    assert rows(top_users(clean_edits(edits(spark, data)), months=1)) == [("new", 1)]


def test_sql_gives_the_same(spark, silver_events, silver_edits):
    silver_events.createOrReplaceTempView("mart_events")
    silver_edits.createOrReplaceTempView("mart_edits")
    name, days = "Cote d'Ivoire", ("2024-07-05", "2024-07-06")
    word = ("NATION_1", "2024-07-01", "2024-07-31")
    assert rows(sql_top_places(spark, "mart_events", 2)) == rows(top_places(silver_events, 2))
    assert rows(sql_place_list(spark, "mart_events")) == rows(place_list(silver_events))
    assert rows(sql_daily_events(spark, "mart_events", name, *days)) == rows(
        daily_events(silver_events, name, *days)
    )
    assert rows(sql_daily_mentions(spark, "mart_edits", *word)) == rows(daily_mentions(silver_edits, *word))
    assert rows(sql_edits_per_minute(spark, "mart_edits")) == rows(edits_per_minute(silver_edits))


def test_correlation_over_common_days(spark):
    left, right = {1: 2, 2: 5, 3: 1, 9: 7}, {1: 4, 2: 10, 3: 2, 8: 1}
    ev = [{"SQL_Date": 20240700 + d} for d, n in left.items() for _ in range(n)]
    ed = [{"timestamp": 1719792000 + (d - 1) * 86400} for d, n in right.items() for _ in range(n)]
    out = daily_correlation(clean_events(events(spark, ev)), clean_edits(edits(spark, ed)))
    assert rows(out) == [(1.0, 3)]


def test_hot_key_counts(spark):
    """A third of the rows under one key, the rest spread; checked by brute force."""
    ids = range(30000)
    names = ["hot" if i % 3 == 0 else f"p{i % 997}" for i in ids]
    df = spark.createDataFrame([(n,) for n in names], "Action_Geo_FullName string").repartition(16)
    want = sorted(Counter(names).items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    assert rows(top_places(df)) == want


def test_stored_view_over_stored_tables(spark, silver_events):
    """Three-part names and a view kept in the catalog."""
    spark.sql("CREATE DATABASE IF NOT EXISTS marts")
    silver_events.write.mode("overwrite").saveAsTable("marts.silver")
    spark.sql("SELECT current_user() AS user, 'readers' AS grp").write.mode("overwrite").saveAsTable(
        "marts.members"
    )
    name = "spark_catalog.marts.silver"
    assert rows(sql_top_places(spark, name, 1)) == [("Aland", 5)]
    for group, seen in (("readers", "Unknown"), ("others", "Restricted")):
        view = create_masked_view(
            spark, "marts.secure", name, "spark_catalog.marts.members", group, temporary=False
        )
        assert {r["SOURCEURL"] for r in view.collect()} == {seen}
    assert spark.catalog.getTable("marts.secure").tableType == "VIEW"


def test_masked_view(spark, silver_events):
    silver_events.withColumn("Source_URL", F.lit("http://x")).createOrReplaceTempView("mask_events")
    user = spark.sql("SELECT current_user()").first()[0]
    people = [(user, "readers"), ("somebody else", "compliance's")]
    spark.createDataFrame(people, "user string, grp string").createOrReplaceTempView("mask_members")
    seen = {}
    for group in ("readers", "compliance's", "none"):
        view = create_masked_view(spark, "masked", "mask_events", "mask_members", group)
        assert view.columns == ["Year", "Action_Geo_FullName", "event_timestamp", "SOURCEURL"]
        seen[group] = {r["SOURCEURL"] for r in view.collect()}
        frame = mask_events(spark.table("mask_events"), spark.table("mask_members"), group)
        assert {r["SOURCEURL"] for r in frame.collect()} == seen[group]
    assert seen == {"readers": {"http://x"}, "compliance's": {"Restricted"}, "none": {"Restricted"}}
