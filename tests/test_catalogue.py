"""Every registered query against the same result from an independent SQL engine."""

import pytest

import __spark_entry__ as entry_points
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    fn, sql = entry_points.queries()[name], entry_points.oracle_sql()[name]
    assert compare(spark, con, SF, name, fn, sql) == "ok"


def test_flagship(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 10 and rows[0].event_count >= rows[-1].event_count


def test_folders_are_listed_by_few_tasks(spark, tmp_path, conf):
    conf(entry_points.LISTING_KEY, "10000")
    spark.range(200).selectExpr("string(id) AS value", "id AS part").write.partitionBy("part").text(str(tmp_path / "t"))
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        rows = entry_points._in_utc(lambda s, d: s.read.format("binaryFile").load(f"{d}/t"))(spark, str(tmp_path))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < max(tracker.getStageInfo(s).numTasks for s in stages) <= max(32, 4 * spark.sparkContext.defaultParallelism)
    assert rows.count() == 200
