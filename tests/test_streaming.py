import zipfile
from dataclasses import replace

import pytest
from helpers import edits, events, plan
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_sources import packed

from millrace.operators import EVENT_RULES, clean_edits, clean_events, gate, quarantine_metrics, reject
from millrace.plans import edits_per_minute
from millrace.sources import read_edits
from millrace.streaming import (
    ARCHIVED_EVENTS,
    EDITS,
    EDITS_WITH_RESCUED,
    EVENTS,
    EVENTS_WITH_CORRUPT,
    TRANSCRIBED_EDITS,
    RunOptions,
    minutes,
    publish,
    read_minute_counts,
    rule_counts,
    run_feeds,
    start_minute_counts,
)
from millrace.streaming.medallion import judged, start_append


def dirty(spark, first, last):
    """Ids ``first`` to ``last``; every third has a bad class, every fifth a bad scale."""
    return events(
        spark,
        [
            {
                "Global_Event_ID": i,
                "Quad_Class": 9 if i % 3 == 0 else 1,
                "Goldstein_Scale": 11.0 if i % 5 == 0 else 0.5,
                "Actor1_Name": None if i % 2 else "NAME",
            }
            for i in range(first, last)
        ],
    )


def drop(df, folder, name):
    df.write.option("sep", "\t").csv(f"{folder}/{name}")


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_stream_equals_batch_and_takes_only_new_files(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    drop(dirty(spark, 0, 60), raw, "d=1")
    options = RunOptions(quarantine=True)
    tables = run_feeds(spark, [(EVENTS, f"{raw}/*")], out, options)["events"]
    want = clean_events(dirty(spark, 0, 60))
    assert as_set(tables.read_silver(spark)) == as_set(gate(want, EVENT_RULES))
    assert tables.read_silver(spark).schema == want.schema

    run_feeds(spark, [(EVENTS, f"{raw}/*")], out, options)
    assert tables.read_bronze(spark).count() == 60

    drop(dirty(spark, 60, 100), raw, "d=2")
    run_feeds(spark, [(EVENTS, f"{raw}/*")], out, options)
    want = clean_events(dirty(spark, 0, 100))
    kept, rejected = tables.read_silver(spark), tables.read_quarantine(spark)
    assert as_set(kept) == as_set(gate(want, EVENT_RULES))
    assert rejected.count() == reject(want, EVENT_RULES).count()
    assert tables.read_bronze(spark).count() == 100 == kept.count() + rejected.count()

    failed = {"valid_quad_class": 34, "valid_goldstein_scale": 20}
    assert dict(map(tuple, quarantine_metrics(rejected).collect())) == failed
    counts = dict(map(tuple, rule_counts(spark, tables).collect()))
    assert {k: n for k, n in counts.items() if n} == failed


def test_small_micro_batches_give_the_same(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    drop(dirty(spark, 0, 200).repartition(7), raw, "d=1")
    options = RunOptions(source={"maxFilesPerTrigger": "2"}, partition_silver_by=["event_timestamp"])
    tables = run_feeds(spark, [(EVENTS, f"{raw}/*")], out, options)["events"]
    want = gate(clean_events(dirty(spark, 0, 200)), EVENT_RULES)
    assert as_set(tables.read_silver(spark).select(want.columns)) == as_set(want)
    assert "PartitionFilters: [isnotnull(event_timestamp" in tables.read_silver(spark).filter(
        "event_timestamp = DATE'2024-07-05'"
    )._jdf.queryExecution().executedPlan().toString()


def test_other_file_format(spark, tmp_path):
    raw = str(tmp_path / "raw")
    drop(dirty(spark, 0, 10), raw, "d=1")
    options = RunOptions(table_format="orc", quarantine=True)
    tables = run_feeds(spark, [(EVENTS, f"{raw}/*")], str(tmp_path / "out"), options)["events"]
    assert tables.read_silver(spark).count() + tables.read_quarantine(spark).count() == 10


def test_failed_run_is_finished_by_the_next(spark, tmp_path):
    """A rule that fails at run time stops the run; nothing is lost or doubled."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    drop(dirty(spark, 0, 60).repartition(6), raw, "d=1")
    broken = replace(EVENTS, rules={"bad": "if(Global_Event_ID = 41, raise_error('x'), true)"})
    options = RunOptions(source={"maxFilesPerTrigger": "1"})
    with pytest.raises(StreamingQueryException):
        run_feeds(spark, [(broken, f"{raw}/*")], out, options)
    assert not spark.streams.active
    tables = run_feeds(spark, [(EVENTS, f"{raw}/*")], out, options)["events"]
    seen = [r[0] for r in tables.read_silver(spark).select("Global_Event_ID").collect()]
    good = {i for i in range(60) if i % 3 and i % 5}
    assert good <= set(seen) and len(seen) == len(set(seen))
    assert tables.read_bronze(spark).count() == 60


def test_gate_before_cleaning(spark):
    raw = events(spark, [{"Event_Code": None}, {}])
    kept, dropped = judged(raw, EVENTS, before_cleaning=True)
    assert kept.count() == 1 and len(kept.columns) == 60
    assert dropped.first()["failed_rules"] == ["valid_event_code"]
    kept, dropped = judged(raw, EVENTS, before_cleaning=False)
    assert kept.count() == 2 and dropped.count() == 0


def test_empty_input_and_both_feeds(spark, tmp_path):
    for name in ("events", "edits"):
        (tmp_path / name).mkdir()
    inputs = [(EVENTS, str(tmp_path / "events")), (EDITS, str(tmp_path / "edits"))]
    tables = run_feeds(spark, inputs, str(tmp_path / "out"))
    assert tables["events"].read_silver(spark).count() == 0
    edits(spark, [{"id": 1}, {"id": 2, "title": ""}]).write.mode("append").json(inputs[1][1])
    tables = run_feeds(spark, inputs, str(tmp_path / "out"))
    assert [r["id"] for r in tables["edits"].read_silver(spark).collect()] == [1]
    assert tables["events"].read_bronze(spark).count() == 0


def test_transcripts_as_a_feed(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.txt").write_text('event: message\ndata: {"id":1,"title":"A","wiki":"enwiki","timestamp":9}\n')
    tables = run_feeds(spark, [(TRANSCRIBED_EDITS, str(raw))], str(tmp_path / "out"))
    assert tables["edits"].read_silver(spark).select("id", "meta_dt").first() == (1, "Unknown")
    assert tables["edits"].read_unreadable(spark).count() == 0


def test_every_payload_is_in_bronze_or_unreadable(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    for k, bad in enumerate(("not json", "{'id':2}", '{"id":3} x', "")):
        (raw / f"{k}.txt").write_text(f'data: {{"id":{k},"timestamp":9}}\n:beat\ndata: {bad}\n')
        tables = run_feeds(spark, [(TRANSCRIBED_EDITS, str(raw))], out)["edits"]
    assert tables.read_bronze(spark).count() == 4
    bad = tables.read_unreadable(spark).collect()
    assert sorted(r.text for r in bad) == ["", "not json", '{"id":3} x', "{'id':2}"]
    assert all(r.source.endswith(".txt") and r.error for r in bad)


def test_archives_as_a_feed_are_read_once(spark, tmp_path):
    """Rows and faults of landed archives come from one stream; a second run adds nothing."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    (raw / "a.zip").write_bytes(packed(zipfile.ZIP_DEFLATED, ["a.CSV", "b.CSV", "c.CSV"], ["b.CSV"]))
    (raw / "bad.zip").write_bytes(b"no archive")
    for _ in range(2):
        tables = run_feeds(spark, [(ARCHIVED_EVENTS, str(raw))], out)["events"]
    assert [p.name for p in (tmp_path / "out" / "_checkpoints" / "events").iterdir() if p.name not in ("bronze", "silver")] == []
    assert tables.read_bronze(spark).count() == 4000 and tables.read_bronze(spark).schema == EVENTS.schema
    bad = {(r.source.split("/")[-1], r.member) for r in tables.read_unreadable(spark).collect()}
    assert bad == {("a.zip", "b.CSV"), ("bad.zip", None)}
    assert "readable" in plan(tables.read_bronze(spark)).split("PartitionFilters")[1].splitlines()[0]


def test_feeds_of_one_name_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="events"):
        run_feeds(spark, [(EVENTS, "a"), (ARCHIVED_EVENTS, "b")], str(tmp_path / "out"))


def test_a_failing_feed_stops_its_siblings(spark, tmp_path):
    raw = str(tmp_path / "raw")
    drop(dirty(spark, 0, 20), raw, "d=1")
    broken = replace(EVENTS, name="other", rules={"bad": "raise_error('x') IS NULL"})
    with pytest.raises(StreamingQueryException):
        run_feeds(spark, [(EVENTS, f"{raw}/*"), (broken, f"{raw}/*")], str(tmp_path / "out"))
    assert not spark.streams.active


def test_bronze_can_keep_leftovers(spark, tmp_path):
    for name, line in (
        ("events", "1\t20240705\n"),
        ("edits", '{"id":1,"title":"A","wiki":"enwiki","timestamp":9,"extra":true}\n'),
    ):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a").write_text(line)
    inputs = [
        (EVENTS_WITH_CORRUPT, str(tmp_path / "events")),
        (EDITS_WITH_RESCUED, str(tmp_path / "edits")),
    ]
    tables = run_feeds(spark, inputs, str(tmp_path / "out"))
    assert tables["events"].read_bronze(spark).first()["_corrupt_record"] == "1\t20240705"
    edit = tables["edits"]
    assert edit.read_bronze(spark).first()["_rescued_data"] == '{"extra":"true"}'
    assert len(edit.read_silver(spark).columns) == 36 and edit.read_silver(spark).count() == 1


def test_minute_counts_before_the_first_edit(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    stream = read_edits(spark, str(tmp_path / "raw"), stream=True)
    start_minute_counts(stream, str(tmp_path / "o"), str(tmp_path / "cp")).awaitTermination()
    assert read_minute_counts(spark, str(tmp_path / "o")).count() == 0


def test_published_tables(spark, tmp_path):
    raw = str(tmp_path / "raw")
    drop(dirty(spark, 0, 10), raw, "d=1")
    tables = run_feeds(spark, [(EVENTS, f"{raw}/*")], str(tmp_path / "out"))["events"]
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    names = publish(spark, tables, "lake")
    assert names == publish(spark, tables, "lake")
    assert names["silver"] == "lake.events_silver"
    assert spark.table("spark_catalog.lake.events_silver").count() == tables.read_silver(spark).count()
    assert spark.table("lake.events_bronze").count() == 10
    assert "every rule" in spark.catalog.getTable("lake.events_silver").description
    drop(dirty(spark, 10, 20), raw, "d=2")
    run_feeds(spark, [(EVENTS, f"{raw}/*")], str(tmp_path / "out"))
    publish(spark, tables, "lake")
    assert spark.table("lake.events_bronze").count() == 20
    assert spark.table("lake.events_silver").count() == tables.read_silver(spark).count()


def test_progress_reports_failures(spark, tmp_path):
    raw = str(tmp_path / "raw")
    drop(dirty(spark, 0, 90), raw, "d=1")
    stream = EVENTS.read(spark, f"{raw}/*", stream=True)
    kept, _ = judged(stream, EVENTS, before_cleaning=False, observe=True)
    query = start_append(kept, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    seen = [p.observedMetrics["events"] for p in query.recentProgress if p.observedMetrics]
    assert sum(m["rows_in"] for m in seen) == 90
    assert sum(m["valid_quad_class"] for m in seen) == 30
    assert sum(m["valid_goldstein_scale"] for m in seen) == 18


@pytest.mark.parametrize("per_trigger", [1, 3])
def test_minute_counts_keep_late_edits(spark, tmp_path, per_trigger):
    raw = str(tmp_path / "raw")
    seconds = [1720000000 + 7 * i for i in range(300)] + [1600000000, 1720000001]
    df = edits(spark, [{"id": i, "timestamp": s} for i, s in enumerate(seconds)])
    df.repartition(5).write.json(raw)
    stream = read_edits(spark, raw, stream=True, options={"maxFilesPerTrigger": per_trigger})
    for _ in range(2):
        start_minute_counts(stream, str(tmp_path / "o"), str(tmp_path / "cp")).awaitTermination()
    edits(spark, [{"id": 900, "timestamp": 1500000000}]).write.mode("append").json(raw)
    start_minute_counts(stream, str(tmp_path / "o"), str(tmp_path / "cp")).awaitTermination()
    got = read_minute_counts(spark, str(tmp_path / "o"))
    want = edits_per_minute(clean_edits(read_edits(spark, raw)))
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    assert got.agg(F.sum("cnt")).first()[0] == 303


def count_late_edits(spark, tmp_path, drops):
    """Ten edits a drop, the last drop long before the others; a run after each."""
    raw, out, cp = str(tmp_path / "raw"), str(tmp_path / "o"), str(tmp_path / "cp")
    for k in range(drops):
        first = 1_400_000_000 if k == drops - 1 else 1_720_000_000 + 40 * k
        rows = [{"id": 10 * k + i, "timestamp": first + 13 * i} for i in range(10)]
        edits(spark, rows).coalesce(1).write.mode("append").json(raw)
        start_minute_counts(read_edits(spark, raw, stream=True), out, cp).awaitTermination()
    got = [tuple(r) for r in read_minute_counts(spark, out).collect()]
    assert got == [tuple(r) for r in edits_per_minute(read_edits(spark, raw)).collect()]
    return sum(n for _, n in got)


def test_minute_counts_need_no_marker_file(spark, tmp_path, conf):
    spark.sparkContext._jsc.hadoopConfiguration().set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        assert count_late_edits(spark, tmp_path, 3) == 30
        assert not list((tmp_path / "o").rglob("_SUCCESS"))
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_minute_counts_are_merged_now_and_then(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(minutes, "FOLDERS", 2)
    assert count_late_edits(spark, tmp_path, 6) == 60
    (own,) = (tmp_path / "o").iterdir()
    assert len(list(own.iterdir())) <= 3 and any(p.name.endswith("-all") for p in own.iterdir())


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    raw, out, cp = str(tmp_path / "raw"), str(tmp_path / "o"), str(tmp_path / "cp")
    edits(spark, [{"id": i, "timestamp": 60 * (i % 4)} for i in range(20)]).write.json(raw)
    stream = read_edits(spark, raw, stream=True, options={"maxFilesPerTrigger": 1})
    start_minute_counts(stream, out, cp).awaitTermination()
    want = read_minute_counts(spark, out).collect()
    last = max(int(p.name) for p in (tmp_path / "cp" / "commits").iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    start_minute_counts(stream, out, cp).awaitTermination()
    assert read_minute_counts(spark, out).collect() == want


def test_counts_of_another_checkpoint_are_not_added_to(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "o")
    edits(spark, [{"id": 1, "timestamp": 60}]).write.json(raw)
    stream = read_edits(spark, raw, stream=True)
    start_minute_counts(stream, out, str(tmp_path / "cp")).awaitTermination()
    with pytest.raises(Exception, match="another checkpoint"):
        start_minute_counts(stream, out, str(tmp_path / "lost")).awaitTermination()


def test_minute_counts_of_silver_with_missing_times(spark, tmp_path):
    df = edits(spark, [{"id": i, "timestamp": t, "wiki": "enwiki"} for i, t in enumerate([60, 61, None, 200])])
    df.write.json(str(tmp_path / "raw"))
    stream = read_edits(spark, str(tmp_path / "raw"), stream=True)
    start_minute_counts(stream, str(tmp_path / "o"), str(tmp_path / "cp")).awaitTermination()
    want = edits_per_minute(df)
    got = read_minute_counts(spark, str(tmp_path / "o"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_the_state_of_minute_counts_has_few_partitions(spark, tmp_path, conf):
    conf("spark.sql.shuffle.partitions", "40")
    raw, out, cp = str(tmp_path / "raw"), str(tmp_path / "o"), tmp_path / "cp"
    edits(spark, [{"id": i, "timestamp": 60 * i} for i in range(100)]).write.json(raw)
    for _ in range(2):
        start_minute_counts(read_edits(spark, raw, stream=True), out, str(cp)).awaitTermination()
    assert len([p for p in (cp / "state" / "0").iterdir() if p.name.isdigit()]) == minutes.STATE_PARTITIONS
    assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    assert sorted(r.cnt for r in read_minute_counts(spark, out).collect()) == [1] * 100
