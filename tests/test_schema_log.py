"""A schema that takes up rescued fields."""

import json

import pytest
from pyspark.sql import types as T

from millrace.schemas import EDIT_SCHEMA, RESCUED
from millrace.streaming.medallion import run_feeds
from millrace.streaming.schema_log import SchemaLog, grown_edits, propose

BASE = (
    T.StructType()
    .add("id", T.LongType())
    .add("title", T.StringType())
    .add("length", T.StructType().add("old", T.LongType()).add("new", T.LongType()))
)


def rescued(spark, *leftovers):
    rows = [(json.dumps(f) if f is not None else None,) for f in leftovers]
    return spark.createDataFrame(rows, f"{RESCUED} string")


def kinds(growth):
    return growth.schema.simpleString()


def test_types_that_give_the_text_back(spark):
    found = propose(
        rescued(spark, None, {"n": "1", "z": "007", "d": "1.5", "b": "true", "mixed": "1"}, {"n": "-3", "d": "2.0", "mixed": "x", "none": None}),
        BASE,
    )
    added = "b:boolean,d:double,mixed:string,n:bigint,z:string"
    assert kinds(found) == f"struct<id:bigint,title:string,length:struct<old:bigint,new:bigint>,{added}>"
    assert found.conflicts == []


def test_nested_names_and_conflicts(spark):
    found = propose(
        rescued(
            spark,
            {"length": json.dumps({"new": "long", "unit": "km"})},
            {"id": "x", "Title": "t", "Extra": "1", "length": json.dumps({"unit": "m"})},
            {"extra": "1", RESCUED.upper(): "a"},
            {"extra": "2", "length": "5"},
        ),
        BASE,
    )
    assert found.added == [("extra",), ("length", "unit")]
    assert "length:struct<old:bigint,new:bigint,unit:string>" in kinds(found)
    assert ("id",) in found.conflicts and ("length", "new") in found.conflicts and ("length",) in found.conflicts
    assert ("Title",) in found.conflicts and ("Extra",) in found.conflicts


def test_fields_that_wait_for_the_next_version(spark, tmp_path):
    log = SchemaLog(str(tmp_path / "log"), BASE)
    rows = rescued(spark, *[{f"f{i}": "1", "often": "2"} for i in range(30)])
    first = propose(rows, BASE, most=3)
    assert first.added == [("f0",), ("f1",), ("often",)]
    assert len(propose(rows, first.schema, most=100).added) == 28
    assert log.version(spark) == 0 and log.read(spark) == BASE
    log.append(spark, first.schema)
    assert log.version(spark) == 1 and log.read(spark) == first.schema and log.read(spark, 0) == BASE
    # What the older rows hold as text fits the columns that were made for it.
    again = log.grow(spark, rescued(spark, {"often": "2"}))
    assert (again.added, again.conflicts, log.version(spark)) == ([], [], 1)


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    log = SchemaLog(str(tmp_path / "log"), BASE)
    log.append(spark, BASE)
    monkeypatch.setattr(SchemaLog, "version", lambda self, spark: 0)
    with pytest.raises(Exception, match="exists"):
        log.append(spark, BASE)


def test_a_field_becomes_a_column_in_the_run_after(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    raw.mkdir()
    log = SchemaLog(f"{lake}/_schemas/edits", EDIT_SCHEMA)
    base = {"title": "t", "wiki": "enwiki", "user": "u", "timestamp": 1720000000}
    drops = [{}, {"extra": 5, "meta": {"zzz": "q"}}, {"extra": 6, "meta": {"zzz": "r"}}, {"extra": "six"}]
    for i, more in enumerate(drops):
        (raw / f"{i}.json").write_text(json.dumps({"id": i} | base | more))
        tables = run_feeds(spark, [(grown_edits(spark, log), str(raw))], lake)
        log.grow(spark, tables["edits"].read_bronze(spark))
    rows = {r.id: r for r in tables["edits"].read_bronze(spark).collect()}
    assert [rows[i].extra for i in range(4)] == [None, None, 6, None]
    assert rows[2].meta.zzz == "r" and rows[2][RESCUED] is None
    assert json.loads(rows[1][RESCUED])["extra"] == "5" and json.loads(rows[3][RESCUED]) == {"extra": "six"}
    assert log.version(spark) == 1
    assert log.grow(spark, tables["edits"].read_bronze(spark)).conflicts == [("extra",)]
    assert tables["edits"].read_silver(spark).count() == 4


def test_rescued_fields_are_read_by_one_job(spark):
    rows = rescued(spark, *[{f"f{i % 5}": str(i), "id": "x"} for i in range(40)])
    spark.sparkContext.setJobGroup("propose", "propose")
    try:
        found = propose(rows, BASE, most=3)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    ran = [tracker.getJobInfo(j).stageIds for j in tracker.getJobIdsForGroup("propose")]
    scans = [s for stages in ran for s in stages if (info := tracker.getStageInfo(s)) and info.numCompletedTasks > 1]
    assert len(scans) == 1
    assert [p for (p,) in found.added] == ["f0", "f1", "f2"] and found.conflicts == [("id",)]
