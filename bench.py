"""Times the query catalogue and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the warm runs of
which the median counts. The tables are first put into the shape of the two feeds, untimed:
raw files as a delivery would bring them, and stored bronze and silver tables. Timed are the
operators on those: ingestion from the landed files on, the gates on bronze, the marts on
silver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalogue import adapters  # noqa: E402
from catalogue import queries as Q  # noqa: E402
from millrace import sources as S  # noqa: E402
from millrace import streaming  # noqa: E402
from millrace.functions.table_functions import register_table_functions  # noqa: E402
from millrace.operators import EVENT_RULES, clean_edits, clean_events, gate, reject, rule_metrics  # noqa: E402
from millrace.plans import marts  # noqa: E402
from millrace.storage import new_dir  # noqa: E402
from millrace.streaming import EDITS, EVENTS, FeedTables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="millrace-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def run(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(build, runs: int) -> float:
    run(build)
    run(build)
    return round(statistics.median(run(build) for _ in range(runs)), 3)


def stored(spark: SparkSession) -> tuple[FeedTables, FeedTables, object]:
    """Bronze and silver of both feeds, and a bronze table with bad rows."""
    root = new_dir(spark, "bench")
    events, edits = FeedTables(root, EVENTS), FeedTables(root, EDITS)
    adapters.events_feed(spark, SF_DIR).write.parquet(events.bronze)
    adapters.edits_feed(spark, SF_DIR).write.parquet(edits.bronze)
    gate(clean_events(events.read_bronze(spark)), EVENTS.rules).write.parquet(events.silver)
    gate(clean_edits(edits.read_bronze(spark)), EDITS.rules).write.parquet(edits.silver)
    adapters.dirty_events_feed(spark, SF_DIR).write.parquet(f"{root}/dirty")
    return events, edits, spark.read.schema(EVENTS.schema).parquet(f"{root}/dirty")


def stored_queries(spark: SparkSession) -> dict:
    ev, ed, dirty = stored(spark)
    events, edits = (lambda: ev.read_silver(spark)), (lambda: ed.read_silver(spark))
    days = (Q.FIRST_DAY, Q.LAST_DAY)
    return {
        "clean_and_gate_events": lambda: gate(clean_events(dirty), EVENT_RULES),
        "clean_and_gate_edits": lambda: gate(clean_edits(ed.read_bronze(spark)), EDITS.rules),
        "rule_metrics": lambda: rule_metrics(clean_events(dirty), EVENT_RULES),
        "rejected_rows": lambda: reject(clean_events(dirty), EVENT_RULES),
        "top_places": lambda: marts.top_places(events()),
        "top_country_codes": lambda: marts.top_country_codes(events()),
        "edits_per_minute": lambda: marts.edits_per_minute(edits()),
        "place_list": lambda: marts.place_list(events()),
        "daily_events": lambda: marts.daily_events(events(), Q.PLACE, *days),
        "daily_mentions": lambda: marts.daily_mentions(edits(), Q.WORD, *days),
        "total": lambda: marts.total(marts.daily_events(events(), Q.PLACE, *days), "event_count"),
        "top_event_types": lambda: marts.top_event_types(events()),
        "peak_hours": lambda: marts.peak_hours(edits()),
        "top_users": lambda: marts.top_users(edits()),
        "last_month_places": lambda: marts.last_month_places(events()),
        "daily_correlation": lambda: marts.daily_correlation(events(), edits()),
    }


def landed_queries(spark: SparkSession) -> dict:
    events, edits = adapters.events_feed(spark, SF_DIR), adapters.edits_feed(spark, SF_DIR)
    tsv = adapters.land_tsv(events, new_dir(spark, "bench-tsv"))
    json_lines = adapters.land_json(edits, new_dir(spark, "bench-json"))
    transcript = adapters.land_text(adapters.sse_lines(edits), new_dir(spark, "bench-sse"))
    archives = adapters.land_archives(events, new_dir(spark, "bench-zip"))
    register_table_functions(spark)
    S.read_lines(spark, transcript).createOrReplaceTempView("bench_lines")

    def stream(source: DataFrame) -> DataFrame:
        out = new_dir(spark, "bench-out")
        streaming.start_append(source, f"{out}/table", f"{out}/checkpoint").awaitTermination()
        return S.read_table(spark, f"{out}/table", schema=source.schema).select(source.columns[0])

    def feed(kind, raw: str) -> DataFrame:
        tables = streaming.run_feeds(spark, [(kind, raw)], new_dir(spark, "bench-lake"))
        return tables[kind.name].read_silver(spark).select("event_timestamp")

    def minutes() -> DataFrame:
        out = new_dir(spark, "bench-min")
        source = S.read_edits(spark, json_lines, stream=True)
        streaming.start_minute_counts(source, f"{out}/t", f"{out}/c").awaitTermination()
        return streaming.read_minute_counts(spark, f"{out}/t")

    def batches() -> DataFrame:
        out = new_dir(spark, "bench-batches")
        S.write_payload_batches(S.sse_payloads(S.read_lines(spark, transcript)), out, 10_000)
        return spark.read.text(out)

    return {
        "tsv_read": lambda: S.read_events(spark, tsv),
        "tsv_read_with_corrupt": lambda: S.read_events(spark, tsv, corrupt=True),
        "json_read": lambda: S.read_edits(spark, json_lines),
        "json_read_with_rescue": lambda: S.read_edits(spark, json_lines, rescue=True),
        "sse_parse": lambda: S.read_sse(spark, transcript),
        "sse_table_function": lambda: spark.sql(
            "SELECT e.id, e.title FROM parse_sse(TABLE(SELECT value FROM bench_lines)) e"
        ),
        "archives_to_events": lambda: S.read_archived_events(spark, archives),
        "payload_batches": batches,
        "landing_gaps": lambda: Q.q05_landing_gaps(spark, SF_DIR),
        "tsv_stream_to_bronze": lambda: stream(S.read_events(spark, tsv, stream=True)),
        "json_stream_to_bronze": lambda: stream(S.read_edits(spark, json_lines, stream=True)),
        "event_feed_run": lambda: feed(EVENTS, tsv),
        "edit_feed_run": lambda: feed(EDITS, json_lines),
        "minute_counts_stream": minutes,
    }


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for prepare in (stored_queries, landed_queries):
        for name, build in prepare(spark).items():
            times[name] = median(build, RUNS)
    line = {
        "metric": "sum of median warm query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
