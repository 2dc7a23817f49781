"""Chains by table name, and the counts a stream notes batch by batch."""

import zipfile

from helpers import events
from pyspark.sql import functions as F
from test_sources import packed

from millrace.operators import EVENT_RULES, clean_events, gate, rule_metrics
from millrace.operators.quality import EVENT_WARNINGS
from millrace.streaming import (
    ARCHIVED_EVENTS,
    EVENTS,
    BatchMetrics,
    RunOptions,
    observed_rule_counts,
    read_batch_metrics,
    run_feeds,
    run_named_feeds,
)


def land(spark, path, first, last):
    rows = [{"Global_Event_ID": i, "Quad_Class": 1 + i % 5, "SQL_Date": 20240701 + i % 3} for i in range(first, last)]
    df = events(spark, rows)
    df.write.mode("append").option("sep", "\t").csv(path)
    return df


def test_a_chain_by_names(spark, tmp_path):
    raw, checkpoints = str(tmp_path / "raw"), str(tmp_path / "cp")
    spark.sql(f"CREATE DATABASE named LOCATION '{tmp_path}/named'")
    options = RunOptions(quarantine=True, partition_silver_by=["event_timestamp"])
    for k in range(3):
        land(spark, raw, 50 * k, 50 * k + 50)
        names = run_named_feeds(spark, [(EVENTS, raw)], "named", checkpoints, options)["events"]
        assert spark.table(names["bronze"]).count() == 50 * (k + 1)
        assert spark.table(names["silver"]).count() == 40 * (k + 1)
        assert spark.table(names["quarantine"]).count() == 10 * (k + 1)
    assert names["silver"] == "named.events_silver"
    assert "every rule" in spark.catalog.getTable(names["silver"]).description
    assert [c.name for c in spark.catalog.listColumns(names["silver"]) if c.isPartition] == ["event_timestamp"]
    want = gate(clean_events(spark.table(names["bronze"])), EVENT_RULES)
    assert spark.table(names["silver"]).select(*want.columns).exceptAll(want).count() == 0


def test_a_chain_without_rows_and_with_faults(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    spark.sql(f"CREATE DATABASE faulty LOCATION '{tmp_path}/faulty'")
    run = lambda: run_named_feeds(spark, [(ARCHIVED_EVENTS, str(tmp_path / "raw"))], "faulty", str(tmp_path / "cp"))["events"]
    assert spark.table(run()["silver"]).count() == 0
    (tmp_path / "raw" / "a.zip").write_bytes(packed(zipfile.ZIP_BZIP2, ["a.CSV", "b.CSV"], ["a.CSV"]))
    names = run()
    bronze = spark.table(names["bronze"])
    assert bronze.filter("readable").count() == 2000
    assert bronze.filter("NOT readable").select("_unreadable.member").first()[0] == "a.CSV"
    assert spark.table(names["silver"]).count() == gate(clean_events(bronze.filter("readable")), EVENT_RULES).count()


def test_counts_of_a_stream_are_kept_by_batch(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    options = RunOptions(observe=True, source={"maxFilesPerTrigger": "1"})
    whole = land(spark, raw, 0, 60).unionByName(land(spark, raw, 60, 90))
    for _ in range(2):  # the second run has nothing new
        tables = run_feeds(spark, [(EVENTS, raw)], out, options)["events"]
    want = rule_metrics(clean_events(whole), EVENT_RULES | EVENT_WARNINGS)
    assert sorted(map(tuple, tables.read_metrics(spark).collect())) == sorted(map(tuple, want.collect()))
    kept = read_batch_metrics(spark, tables.metrics)
    assert kept.select("batch").distinct().count() > 1
    assert kept.filter("metric = 'rows_in'").agg(F.sum("value")).first()[0] == 90
    land(spark, raw, 90, 120)
    run_feeds(spark, [(EVENTS, raw)], out, options)
    assert read_batch_metrics(spark, tables.metrics).filter("metric = 'rows_in'").agg(F.sum("value")).first()[0] == 120


def test_a_repeated_batch_counts_once(spark, tmp_path):
    class Counts:
        def __init__(self, **values):
            self.values = values

        def asDict(self):
            return self.values

    class Progress:
        id, batchId = "q", 4

        def __init__(self, **values):
            self.observedMetrics = {"events": Counts(**values)}

    metrics = BatchMetrics(spark, str(tmp_path / "m"))
    for value in (3, 7):
        metrics.note(Progress(rows_in=10, bad=value, none=None))
    kept = read_batch_metrics(spark, str(tmp_path / "m"))
    assert observed_rule_counts(kept, "events").collect() == [("bad", 7)] and kept.count() == 2
    assert observed_rule_counts(kept, "other").count() == 0
