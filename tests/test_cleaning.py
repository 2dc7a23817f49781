import datetime as dt

from helpers import edits, events
from pyspark.sql import functions as F

from millrace.functions import contains_text, drop_bad_utf8, like_text
from millrace.operators import clean_edits, clean_events, fill_unknown
from millrace.schemas import EVENT_FILLED, RESCUED


def test_clean_events_fills_and_dates(spark):
    rows = [
        {"Global_Event_ID": 1, "Actor1_Name": "", "Source_URL": None},
        {"Global_Event_ID": 2, "SQL_Date": 20241399},
        {"Global_Event_ID": 3, "SQL_Date": None},
    ]
    out = {r["Global_Event_ID"]: r for r in clean_events(events(spark, rows)).collect()}
    assert out[1]["Actor1_Name"] == "" and out[1]["Source_URL"] == "Unknown"
    assert out[1]["event_timestamp"] == dt.date(2024, 7, 5)
    assert out[1]["Event_Code"] == "057"
    assert out[2]["event_timestamp"] is None and out[3]["event_timestamp"] is None
    assert all(out[3][c] is not None for c in EVENT_FILLED)


def test_clean_edits_flattens(spark):
    rows = [
        {"id": 1, "length": (5, None), "meta": (None, "d", "secret", 7, 1, "r", None, None, "x")},
        {"id": 2, "title": None, "length": None},
        {"id": 3, "wiki": "dewiki"},
        {"id": 4, "wiki": None},
    ]
    bronze = edits(spark, rows).withColumn(RESCUED, F.lit("{}"))
    out = {r["id"]: r for r in clean_edits(bronze).collect()}
    assert set(out) == {1, 2}
    assert (out[1]["length_new"], out[1]["length_old"]) == (5, None)
    assert (out[1]["meta_request"], out[1]["meta_offset"], out[1]["meta_domain"]) == ("r", 7, "Unknown")
    assert out[2]["title"] == "Unknown" and out[2]["length_new"] is None
    assert out[2]["$schema"] is None
    assert out[1]["event_timestamp"] == dt.datetime(2024, 7, 3, 9, 46, 40)
    assert clean_edits(bronze, wiki=None).count() == 4


def test_fill_leaves_other_columns(spark):
    df = spark.createDataFrame([(None, None, None)], "a string, b string, n int")
    assert fill_unknown(df, ["a"]).first() == ("Unknown", None, None)


def test_text_matching(spark):
    df = spark.createDataFrame([("NATION_1 page",), ("NATIONX1 page",), ("100% sure",), (None,)], "t string")
    t = F.col("t")
    hits = lambda c: [r[0] for r in df.filter(c).collect()]
    assert hits(contains_text(t, "NATION_1")) == ["NATION_1 page"]
    assert hits(like_text(t, "NATION_1")) == ["NATION_1 page", "NATIONX1 page"]
    assert hits(contains_text(t, "0% s")) == ["100% sure"]


def test_bad_bytes_are_dropped_and_good_ones_kept(spark):
    df = spark.sql("SELECT CAST(X'61FF62' AS STRING) AS s UNION ALL SELECT '� ok'")
    got = {r[0] for r in df.select(drop_bad_utf8(F.col("s"))).collect()}
    assert got == {"ab", "� ok"}
