import pytest
from helpers import edits, events
from pyspark.sql import functions as F

from millrace.operators import (
    EDIT_RULES,
    EVENT_RULES,
    EVENT_WARNINGS,
    clean_edits,
    clean_events,
    gate,
    quarantine_metrics,
    reject,
    rule_metrics,
    with_failures,
)
from millrace.operators.quality import FAILED_RULES

# column, rule, values on the bounds, values one step outside
BOUNDS = [
    ("SQL_Date", "valid_sql_date", [19000101, 99991231, 20241399], [19000100, 99991232]),
    ("Quad_Class", "valid_quad_class", [1, 4, None], [0, 5]),
    ("Goldstein_Scale", "valid_goldstein_scale", [-10.0, 10.0, None], [-10.5, 10.5]),
    ("Is_Root_Event", "valid_is_root_event", [0, 1], [-1, 2, None]),
    ("Num_Mentions", "valid_num_mentions", [0, None], [-1]),
    ("Num_Sources", "valid_num_sources", [0, None], [-1]),
    ("Num_Articles", "valid_num_articles", [0, None], [-1]),
]
for place in ("Actor1", "Actor2", "Action"):
    low = place.lower()
    BOUNDS += [
        (f"{place}_Geo_Lat", f"valid_{low}_geo_lat", [-90.0, 90.0, None], [-90.5, 90.5]),
        (f"{place}_Geo_Long", f"valid_{low}_geo_long", [-180.0, 180.0, None], [-180.5, 180.5]),
        (f"{place}_Geo_Type", f"valid_{low}_geo_type", [0, 5, None], [-1, 6]),
    ]


def test_rule_names():
    assert len(EVENT_RULES) == 18 and len(EDIT_RULES) == 3
    assert {r for _, r, _, _ in BOUNDS} | {"valid_global_event_id", "valid_event_code"} == set(EVENT_RULES)


def test_every_event_rule_at_its_bounds(spark):
    rows, expected = [], {}
    for column, rule, inside, outside in BOUNDS:
        for value in inside + outside:
            i = len(rows) + 1
            rows.append({"Global_Event_ID": i, column: value})
            expected[i] = [] if value in inside else [rule]
    rows.append({"Global_Event_ID": None})
    expected[None] = ["valid_global_event_id"]
    rows.append({"Global_Event_ID": 0, "SQL_Date": None})
    expected[0] = ["valid_sql_date"]
    silver = clean_events(events(spark, rows))

    judged = with_failures(silver, EVENT_RULES).collect()
    assert {r["Global_Event_ID"]: r[FAILED_RULES] for r in judged} == expected
    kept = {r[0] for r in gate(silver, EVENT_RULES).select("Global_Event_ID").collect()}
    assert kept == {i for i, failed in expected.items() if not failed}
    rejected = {r["Global_Event_ID"]: r[FAILED_RULES] for r in reject(silver, EVENT_RULES).collect()}
    assert rejected == {i: failed for i, failed in expected.items() if failed}

    counts = {r["rule"]: r["failed"] for r in rule_metrics(silver, EVENT_RULES).collect()}
    for name in EVENT_RULES:
        assert counts[name] == sum(name in failed for failed in expected.values())


def test_missing_code_passes_after_the_fill_only(spark):
    raw = events(spark, [{"Event_Code": None}])
    assert gate(clean_events(raw), EVENT_RULES).first()["Event_Code"] == "Unknown"
    assert reject(raw, EVENT_RULES).first()[FAILED_RULES] == ["valid_event_code"]


def test_edit_rules(spark):
    rows = [
        {"id": 1},
        {"id": None},
        {"id": 3, "timestamp": 0},
        {"id": 4, "timestamp": None},
        {"id": 5, "title": ""},
        {"id": 6, "title": None},
    ]
    silver = clean_edits(edits(spark, rows))
    assert {r["id"] for r in gate(silver, EDIT_RULES).collect()} == {1, 6}
    counts = {r["rule"]: r["failed"] for r in rule_metrics(silver, EDIT_RULES).collect()}
    assert counts == {"valid_id": 1, "valid_timestamp": 2, "non_empty_title": 1}


def test_unreadable_date_is_counted_but_kept(spark):
    silver = clean_events(events(spark, [{"SQL_Date": 20241399}, {}]))
    assert rule_metrics(silver, EVENT_WARNINGS).first()["failed"] == 1
    assert gate(silver, EVENT_RULES).count() == 2


def test_row_with_several_failures_counts_under_each(spark):
    silver = clean_events(events(spark, [{"Quad_Class": 9, "Num_Sources": -2}]))
    counts = quarantine_metrics(reject(silver, EVENT_RULES)).collect()
    assert {(r["rule"], r["failed"]) for r in counts} == {
        ("valid_quad_class", 1),
        ("valid_num_sources", 1),
    }


@pytest.mark.parametrize("rules", [{}, {"odd": "Num_Mentions % 2 = 1"}])
def test_rules_are_the_callers_choice(spark, rules):
    df = events(spark, [{"Num_Mentions": n} for n in (1, 2, None)])
    kept, rejected = gate(df, rules).count(), reject(df, rules).count()
    assert (kept, rejected) == ((1, 2) if rules else (3, 0))


def test_failures_on_given_tables(spark):
    """Counts for a feed with bad values at known ids."""
    from catalogue import adapters as A

    sf = "/root/testdata/sf0.001"
    kept = gate(clean_events(A.dirty_events_feed(spark, sf)), EVENT_RULES)
    row = kept.agg(
        F.count("*"), F.sum("Global_Event_ID"), F.count_if(F.col("event_timestamp").isNull())
    ).first()
    assert tuple(row) == (864, 427087, 9)
