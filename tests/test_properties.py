"""Random rows, judged by a second, plain-Python reading of the rules."""

import random
from collections import Counter

from helpers import events
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import yyyymmdd_to_date
from millrace.operators import EVENT_RULES, clean_events, gate, reject, rule_metrics, with_failures
from millrace.plans import top_places

RANGES = {
    "Quad_Class": (1, 4),
    "Goldstein_Scale": (-10.0, 10.0),
    "Num_Mentions": (0, None),
    "Num_Sources": (0, None),
    "Num_Articles": (0, None),
}
for _p in ("Actor1", "Actor2", "Action"):
    RANGES |= {f"{_p}_Geo_Lat": (-90.0, 90.0), f"{_p}_Geo_Long": (-180.0, 180.0), f"{_p}_Geo_Type": (0, 5)}


def failures(row):
    out = set()
    if row["Global_Event_ID"] is None:
        out.add("valid_global_event_id")
    if row["SQL_Date"] is None or not 19000101 <= row["SQL_Date"] <= 99991231:
        out.add("valid_sql_date")
    if row["Is_Root_Event"] not in (0, 1):
        out.add("valid_is_root_event")
    for column, (low, high) in RANGES.items():
        value = row[column]
        if value is not None and (value < low or (high is not None and value > high)):
            out.add(f"valid_{column.lower()}")
    return out


def random_row(rng, i):
    row = {
        "Global_Event_ID": rng.choice([i] * 20 + [None]),
        "SQL_Date": rng.choice([20240101, 18991231, 99991231, 100000101, None] + [20240229] * 10),
        "Is_Root_Event": rng.choice([0, 1] * 10 + [2, -1, None]),
        "Date_Added": i,
    }
    for column, (low, high) in RANGES.items():
        inside = low + 1
        choices = [inside] * 30 + [low, low - 1, None]
        row[column] = rng.choice(choices + ([] if high is None else [high, high + 1]))
    return row


def test_rules_against_plain_python(spark):
    rng = random.Random(7)
    rows = [random_row(rng, i) for i in range(1500)]
    want = {r["Date_Added"]: failures(r) for r in rows}
    silver = clean_events(events(spark, rows))
    got = with_failures(silver, EVENT_RULES).select("Date_Added", "failed_rules").collect()
    assert {r[0]: set(r[1]) for r in got} == want
    kept = {r[0] for r in gate(silver, EVENT_RULES).select("Date_Added").collect()}
    lost = {r[0] for r in reject(silver, EVENT_RULES).select("Date_Added").collect()}
    assert kept == {k for k, f in want.items() if not f} and kept | lost == set(want) and not kept & lost
    totals = Counter(name for f in want.values() for name in f)
    assert all(r["failed"] == totals[r["rule"]] for r in rule_metrics(silver, EVENT_RULES).collect())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", "c", "Unknown", None]), max_size=60), st.integers(1, 4))
def test_ranking(spark, names, k):
    df = spark.createDataFrame([(n,) for n in names], "Action_Geo_FullName string")
    counts = Counter(n for n in names if n not in (None, "Unknown"))
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:k]
    assert [tuple(r) for r in top_places(df, k).collect()] == want


def test_dates_against_plain_python(spark):
    import datetime as dt

    rng = random.Random(3)
    numbers = [rng.randrange(19000000, 21000000) for _ in range(3000)] + [0, -5, 2024, 202401011]

    def parse(n):
        try:
            return dt.datetime.strptime(f"{n:08d}" if 10**7 <= n < 10**8 else "x", "%Y%m%d").date()
        except ValueError:
            return None

    df = spark.createDataFrame([(n,) for n in numbers], "n int")
    got = df.select("n", yyyymmdd_to_date(F.col("n"))).collect()
    assert {r[0]: r[1] for r in got} == {n: parse(n) for n in numbers}
