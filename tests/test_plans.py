"""What Spark makes of the queries: pushdown, pruning, shuffles, skew."""

import re

import pytest
from helpers import edits, events, plan
from pyspark.sql import functions as F

from catalogue import adapters as A
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES
from check import compare, connect
from millrace.operators import (
    EVENT_RULES,
    clean_edits,
    clean_events,
    gate,
    mask_events,
    reject,
    rule_metrics,
)
from millrace.plans import daily_events, daily_mentions, edits_per_minute, top_places
from millrace.schemas import EVENT_SCHEMA
from millrace.sources import first_events, gaps, manifest

SF = "/root/testdata/sf0.001"
JIT_LIMIT = 8000  # bytes of code above which the JVM does not compile a method


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    events(spark, [{}]).write.parquet(f"{root}/bronze")
    clean_events(events(spark, [{}])).write.parquet(f"{root}/events")
    clean_edits(edits(spark, [{}])).write.parquet(f"{root}/edits")
    return lambda name: spark.read.parquet(f"{root}/{name}")


def read_schema(df):
    return re.findall(r"ReadSchema: struct<(.*)>", plan(df))


def generated_sizes(spark, df):
    debug = spark._jvm.org.apache.spark.sql.execution.debug
    module = getattr(getattr(debug, "package$"), "MODULE$")
    stages = module.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]


def test_silver_chain_stays_in_one_compiled_stage(spark, stored):
    silver = gate(clean_events(stored("bronze")), EVENT_RULES)
    assert "Exchange" not in plan(silver)
    sizes = generated_sizes(spark, silver)
    assert len(sizes) == 1 and 0 < sizes[0] < JIT_LIMIT
    assert all(n < JIT_LIMIT for n in generated_sizes(spark, reject(clean_events(stored("bronze")), EVENT_RULES)))
    pushed = plan(silver)
    assert "GreaterThanOrEqual(SQL_Date,19000101)" in pushed and "IsNotNull(Global_Event_ID)" in pushed


def test_rule_counts_read_judged_columns_only(stored):
    (columns,) = read_schema(rule_metrics(clean_events(stored("bronze")), EVENT_RULES))
    assert len(columns.split(",")) <= 17 and "Source_URL" not in columns


def test_top_places_reads_one_column_and_never_sorts_all(stored):
    p = plan(top_places(stored("events")))
    assert read_schema(top_places(stored("events"))) == ["Action_Geo_FullName:string"]
    assert "TakeOrderedAndProject" in p and "Not(EqualTo(Action_Geo_FullName,Unknown))" in p
    assert p.count("hashpartitioning") == 1 and "partial_count" in p


def test_day_ranges_reach_the_scan(stored):
    p = plan(daily_events(stored("events"), "X", "2024-07-01", "2024-07-31"))
    assert "GreaterThanOrEqual(event_timestamp,2024-07-01)" in p and "EqualTo(Action_Geo_FullName,X)" in p
    p = plan(daily_mentions(stored("edits"), "X", "2024-07-01", "2024-07-31", literal=True))
    assert "GreaterThanOrEqual(event_timestamp,2024-07-01" in p and "StringContains(title,X)" in p
    assert "LessThan(event_timestamp,2024-08-01" in p


def test_edits_per_minute_counts_before_the_shuffle(stored):
    df = edits_per_minute(stored("edits"))
    assert "partial_count" in plan(df) and "EqualTo(wiki,enwiki)" in plan(df)
    assert sorted(c.split(":")[0] for c in read_schema(df)[0].split(",")) == ["timestamp", "wiki"]


def test_bounded_replay_funnels_keys_only(spark, stored):
    df = first_events(stored("events"), "Global_Event_ID", 100)
    merged = [s for s in read_schema(df) if s == "Global_Event_ID:bigint"]
    assert merged and plan(df).count("TakeOrderedAndProject") >= 2


def test_membership_is_one_subquery(spark, stored):
    members = spark.createDataFrame([("a", "g")], "user string, grp string")
    p = plan(mask_events(stored("events"), members, "g"))
    assert "Join" not in p and "Subquery" in p


def test_gaps_reduce_landed_rows_before_the_join(spark):
    landed = spark.range(1000).select(
        F.expr("TIMESTAMP_NTZ'2025-07-01 03:00:00' + make_dt_interval(0, id % 2)").alias("slot"), "id"
    )
    p = plan(gaps(manifest(spark, "20250701030000", "20250701040000"), landed))
    assert "LeftAnti" in p and p.count("HashAggregate") >= 2


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The given tables, but one user owns a third of all events."""
    root = str(tmp_path_factory.mktemp("skewed"))
    for name in ("customer", "nation"):
        A.table(spark, SF, name).write.parquet(f"{root}/{name}.parquet")
    ev = A.table(spark, "/root/testdata/sf0.01", "events")
    known = A.table(spark, SF, "customer").agg(F.max("c_custkey")).first()[0]
    user = F.when(F.col("event_id") % 3 == 0, F.lit(8)).otherwise(F.col("user_id") % (known + 1))
    ev.withColumn("user_id", user.cast("bigint")).repartition(8).write.parquet(f"{root}/events.parquet")
    return root


SKEW_QUERIES = ["q18_top_places", "q28_top_users", "q30_daily_correlation", "q09_medallion_edits"]


@pytest.mark.parametrize("name", SKEW_QUERIES)
def test_hot_user_without_broadcast(spark, conf, skewed, name):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    con = connect(skewed, ("events", "customer", "nation"), glob=True)
    assert compare(spark, con, skewed, name, QUERIES[name], ORACLES[name]) == "ok"


def test_hot_partition_is_split(spark, conf, skewed):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    df = A.events_feed(spark, skewed)
    df.collect()
    assert "skewed" in plan(df) or "skew=true" in plan(df)


def test_schema_is_never_inferred_from_data(spark, tmp_path):
    from millrace.sources import read_events

    (tmp_path / "raw").mkdir()
    assert read_events(spark, str(tmp_path / "raw")).schema == EVENT_SCHEMA
