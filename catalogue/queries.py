"""One query per operator of the library, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import adapters as A
from millrace.functions.table_functions import register_table_functions
from millrace.functions.times import epoch_to_timestamp, yyyymmdd_to_date
from millrace.operators import cleaning, masking, quality
from millrace.plans import leaders, marts, mentions, spikes, sql
from millrace.schemas import (
    CORRUPT,
    EDIT_SCHEMA,
    EDIT_FILLED,
    EDIT_FLATTENED,
    EDIT_STRUCTS,
    EVENT_DROPPED,
    EVENT_FILLED,
    EVENT_SCHEMA,
    RESCUED,
)
from millrace.sources import archives, gap_ranges, intervals, readers, replay, sinks, sse
from millrace.storage import new_dir
from millrace.streaming import medallion, minutes, named, replaced, schema_log

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Columns of the event feed that the given tables supply values for.
EVENT_VALUE_COLUMNS = [
    "Global_Event_ID",
    "SQL_Date",
    "Month_Year",
    "Year",
    "Fraction_Date",
    "Actor1_Code",
    "Actor1_Name",
    "Actor1_Country_Code",
    "Is_Root_Event",
    "Event_Code",
    "Event_Base_Code",
    "Event_Root_Code",
    "Quad_Class",
    "Goldstein_Scale",
    "Num_Mentions",
    "Num_Sources",
    "Num_Articles",
    "Avg_Tone",
    "Action_Geo_Type",
    "Action_Geo_FullName",
    "Action_Geo_Country_Code",
    "Action_Geo_Lat",
    "Action_Geo_Long",
    "Action_Geo_Feature_ID",
    "Date_Added",
    "Source_URL",
]

PLACE = "NATION_3"
WORD = "NATION_1"
FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-20"
EMPTY_FIRST, EMPTY_LAST = "1999-01-01", "1999-01-31"
DAY_PLACES, WEEK_PLACES = 20, 12  # places that a summary lists
AUDITORS = "compliance_auditors"
NOT_RENEWED = "15"  # minute of the members that come once


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _no_zone(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def _silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate(cleaning.clean_events(A.events_feed(spark, sf_dir)), quality.EVENT_RULES)


def _silver_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate(cleaning.clean_edits(A.edits_feed(spark, sf_dir)), quality.EDIT_RULES)


def _dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_events(A.dirty_events_feed(spark, sf_dir))


def _dirty_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_edits(A.dirty_edits_feed(spark, sf_dir))


def _ingest(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream to the end of its input and read what it wrote."""
    out = new_dir(spark, label)
    medallion.start_append(stream, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return readers.read_table(spark, f"{out}/table", schema=stream.schema)


# --- scans and landing ----------------------------------------------------------------


@query
def q01_tsv_stream_ingest(spark, sf_dir):
    raw = A.land_tsv(A.events_feed(spark, sf_dir), new_dir(spark, "q01-raw"))
    bronze = _ingest(spark, readers.read_events(spark, raw, stream=True), "q01")
    return bronze.select(*EVENT_VALUE_COLUMNS)


@query
def q02_json_stream_ingest(spark, sf_dir):
    raw = A.land_json(A.edits_feed(spark, sf_dir), new_dir(spark, "q02-raw"))
    bronze = _ingest(spark, readers.read_edits(spark, raw, stream=True), "q02")
    return bronze.select(
        "id",
        "title",
        "user",
        "wiki",
        "bot",
        "timestamp",
        F.col("meta.dt").alias("meta_dt"),
        F.col("meta.partition").alias("meta_partition"),
        F.col("length.new").alias("length_new"),
        F.col("revision.old").alias("revision_old"),
    )


def _transcript(spark, sf_dir, label) -> DataFrame:
    raw = A.land_text(A.sse_lines(A.edits_feed(spark, sf_dir)), new_dir(spark, label))
    return sse.read_lines(spark, raw)


@query
def q03_sse_parse(spark, sf_dir):
    parsed = sse.parse_sse(_transcript(spark, sf_dir, "q03-raw"))
    return sse.readable(parsed).select(
        "id", "title", "user", "timestamp", F.col("revision.new").alias("revision_new")
    )


@query
def q03_sse_corrupt(spark, sf_dir):
    parsed = sse.parse_sse(_transcript(spark, sf_dir, "q03c-raw"))
    return sse.unreadable(parsed).select(F.col(CORRUPT).alias("payload"))


def _calendar(spark, sf_dir) -> DataFrame:
    slot = intervals.slot_of(F.col("ts"))
    events = A.table(spark, sf_dir, "events")
    bounds = events.agg(F.min(slot).alias("start"), F.max(slot).alias("end"))
    return intervals.manifest_between(bounds)


@query
def q04_interval_manifest(spark, sf_dir):
    return _calendar(spark, sf_dir).select("stamp", "file_name")


@query
def q05_landing_gaps(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    landed = events.select(intervals.slot_of(F.col("ts")).alias("slot"))
    return intervals.gaps(_calendar(spark, sf_dir), landed).select("stamp")


@query
def q05_landing_gaps_files(spark, sf_dir):
    """Missing deliveries told from the files of a landing folder."""
    folder = A.land_archives(A.events_feed(spark, sf_dir), new_dir(spark, "q05-raw"))
    landed = intervals.landed_deliveries(spark, folder)
    return intervals.gaps(_calendar(spark, sf_dir), landed).select("stamp")


# Days of which no delivery counts as landed, so that there is a long hole too.
HOLE_FIRST, HOLE_LAST = "2024-01-08", "2024-01-11"


@query
def q05_gap_ranges(spark, sf_dir):
    """Missing deliveries as ranges, with a hole of days among single slots."""
    slot = intervals.slot_of(F.col("ts"))
    events = A.table(spark, sf_dir, "events")
    bounds = events.agg(F.min(slot).alias("start"), F.max(slot).alias("end"))
    hole = F.to_date("ts").between(F.lit(HOLE_FIRST).cast("date"), F.lit(HOLE_LAST).cast("date"))
    return gap_ranges.gap_ranges(bounds, events.filter(~hole).select(slot.alias("slot")))


def _unpacked(spark, sf_dir, label) -> DataFrame:
    folder = A.land_archives(A.events_feed(spark, sf_dir), new_dir(spark, label))
    return archives.unzip(archives.read_archives(spark, folder))


@query
def q06_zip_extract(spark, sf_dir):
    rows = archives.member_events(_unpacked(spark, sf_dir, "q06-raw"))
    return rows.select("member", *EVENT_VALUE_COLUMNS)


@query
def q06_member_store(spark, sf_dir):
    lines = archives.members(_unpacked(spark, sf_dir, "q06s-raw"))
    store = new_dir(spark, "q06-members")
    # What is stored under a member's name is replaced by the second delivery of it.
    sinks.write_members(lines.withColumn("value", F.lit("0\tsuperseded")), store)
    sinks.write_members(lines, store)
    return readers.read_events(spark, store).select(
        "Global_Event_ID", "Event_Code", "Action_Geo_FullName"
    )


@query
def q06_replaced_member(spark, sf_dir):
    """Bronze behind a member store, of which all but some members are delivered anew."""
    lines = archives.members(_unpacked(spark, sf_dir, "q06m-raw"))
    store, out = new_dir(spark, "q06m-members"), new_dir(spark, "q06m")
    bronze = replaced.ReplaceableTable(out, readers.read_events, EVENT_SCHEMA, mirror=True)
    sinks.write_members(lines.withColumn("value", F.lit("0\tsuperseded")), store)
    bronze.take_up(spark, store)
    sinks.write_members(lines.filter(F.substring("member", 11, 2) != NOT_RENEWED), store)
    bronze.take_up(spark, store)
    return bronze.current(spark).select("Global_Event_ID", "Event_Code", "Action_Geo_FullName")


@query
def q06_unreadable_archives(spark, sf_dir):
    bad = archives.unreadable_archives(_unpacked(spark, sf_dir, "q06u-raw"))
    return bad.select(A.archive_name(F.col("archive")).alias("archive"))


@query
def q06_damaged_members(spark, sf_dir):
    """What archives with a damaged member among sound ones give, by member."""
    folder = A.land_member_archives(A.events_feed(spark, sf_dir), new_dir(spark, "q06d-raw"))
    lines = archives.unzip(archives.read_archives(spark, folder))
    good = archives.member_events(lines).select("member", "Global_Event_ID", "Event_Code", F.lit(False).alias("damaged"))
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("Global_Event_ID", "long"), ("Event_Code", "string"))]
    bad = archives.unreadable_archives(lines).select("member", *nothing, F.lit(True).alias("damaged"))
    return good.unionByName(bad)


@query
def q07_batched_json_sink(spark, sf_dir):
    path = new_dir(spark, "q07")
    events = A.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    sinks.write_json_batches(events, path, batch_size=1000)
    back = spark.read.schema(events.schema).json(path)
    return back.select("event_id", "ts", "user_id", "event_type", "value", "props")


@query
def q07_transcript_to_json_batches(spark, sf_dir):
    """A transcript landed as JSON-lines files, then read as such."""
    path = new_dir(spark, "q07t")
    payloads = sse.sse_payloads(_transcript(spark, sf_dir, "q07t-raw"))
    sinks.write_payload_batches(payloads, path, batch_size=1000)
    return readers.read_edits(spark, path).select("id", "title", "wiki")


@query
def q08_bounded_replay(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    return replay.first_events(events, "event_id", batch_size=100, max_batches=10).select(
        "event_id", "user_id", "event_type"
    )


# --- medallion ------------------------------------------------------------------------


@query
def q09_medallion_events(spark, sf_dir):
    raw, out = new_dir(spark, "q09-raw"), new_dir(spark, "q09")
    feed = A.events_feed(spark, sf_dir)
    even = F.col("Global_Event_ID") % 2 == 0
    for name, drop in (("first", feed.filter(even)), ("second", feed.filter(~even))):
        A.land_tsv(drop, f"{raw}/{name}")
        tables = medallion.run_feeds(spark, [(medallion.EVENTS, f"{raw}/*")], out)
    # A run without new files must add nothing.
    tables = medallion.run_feeds(spark, [(medallion.EVENTS, f"{raw}/*")], out)
    return tables["events"].read_silver(spark).select(
        *EVENT_VALUE_COLUMNS, "Actor2_Name", "event_timestamp"
    )


@query
def q09_medallion_edits(spark, sf_dir):
    raw = A.land_json(A.edits_feed(spark, sf_dir), new_dir(spark, "q09e-raw"))
    tables = medallion.run_feeds(spark, [(medallion.EDITS, raw)], new_dir(spark, "q09e"))
    return tables["edits"].read_silver(spark).select(
        "id", "title", "user", "meta_dt", "meta_request", "length_new",
        _no_zone(F.col("event_timestamp")).alias("event_timestamp"),
    )


@query
def q09_medallion_archives(spark, sf_dir):
    """From landed archives to silver."""
    raw = A.land_archives(A.events_feed(spark, sf_dir), new_dir(spark, "q09a-raw"))
    tables = medallion.run_feeds(spark, [(medallion.ARCHIVED_EVENTS, raw)], new_dir(spark, "q09a"))
    return tables["events"].read_silver(spark).select(*EVENT_VALUE_COLUMNS, "event_timestamp")


@query
def q09_medallion_transcripts(spark, sf_dir):
    """From landed feed transcripts to silver."""
    lines = A.sse_lines(A.edits_feed(spark, sf_dir))
    raw = A.land_text(lines, new_dir(spark, "q09t-raw"))
    feed = medallion.TRANSCRIBED_EDITS
    tables = medallion.run_feeds(spark, [(feed, raw)], new_dir(spark, "q09t"))
    return tables["edits"].read_silver(spark).select("id", "title", "user", "timestamp")


@query
def q09_archives_unreadable(spark, sf_dir):
    """What a feed run over archives could not unpack; a second run adds nothing."""
    raw = A.land_archives(A.events_feed(spark, sf_dir), new_dir(spark, "q09u-raw"))
    out = new_dir(spark, "q09u")
    for _ in range(2):
        tables = medallion.run_feeds(spark, [(medallion.ARCHIVED_EVENTS, raw)], out)
    bad = tables["events"].read_unreadable(spark)
    return bad.select(A.archive_name(F.col("source")).alias("archive"), "member", "text")


@query
def q09_transcripts_unreadable(spark, sf_dir):
    """Payloads of a feed run over transcripts that are no JSON object."""
    raw = A.land_text(A.sse_lines(A.edits_feed(spark, sf_dir)), new_dir(spark, "q09v-raw"))
    feed = medallion.TRANSCRIBED_EDITS
    tables = medallion.run_feeds(spark, [(feed, raw)], new_dir(spark, "q09v"))
    return tables["edits"].read_unreadable(spark).select("text", "error")


@query
def q09_published_tables(spark, sf_dir):
    """Silver by its catalog name after each of two runs; the names follow the files."""
    raw, out, database = new_dir(spark, "q09p-raw"), new_dir(spark, "q09p"), f"q09_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_dir(spark, 'q09p-names')}'")
    feed = A.events_feed(spark, sf_dir)
    even = F.col("Global_Event_ID") % 2 == 0
    for name, drop in (("first", feed.filter(even)), ("second", feed.filter(~even))):
        A.land_tsv(drop, f"{raw}/{name}")
        tables = medallion.run_feeds(spark, [(medallion.EVENTS, f"{raw}/*")], out)
        names = medallion.publish(spark, tables["events"], database)
        spark.table(names["silver"]).isEmpty()  # a reader between the runs
    top = sql.sql_top_places(spark, names["silver"])
    return top.withColumn("n_silver", spark.table(names["silver"]).agg(F.count(F.lit(1))).scalar())


@query
def q09_named_chain(spark, sf_dir):
    """Two runs from files to silver by table names alone, a reader between them."""
    raw, out, database = new_dir(spark, "q09n-raw"), new_dir(spark, "q09n"), f"q09n_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{out}/names'")
    feed = A.events_feed(spark, sf_dir)
    even = F.col("Global_Event_ID") % 2 == 0
    for name, drop in (("first", feed.filter(even)), ("second", feed.filter(~even))):
        A.land_tsv(drop, f"{raw}/{name}")
        names = named.run_named_feeds(spark, [(medallion.EVENTS, f"{raw}/*")], database, f"{out}/checkpoints")
        spark.table(names["events"]["silver"]).isEmpty()
    silver = names["events"]["silver"]
    return sql.sql_top_places(spark, silver).withColumn("n_silver", spark.table(silver).agg(F.count(F.lit(1))).scalar())


# --- cleaning -------------------------------------------------------------------------


@query
def q10_drop_columns(spark, sf_dir):
    return A.events_feed(spark, sf_dir).drop(*EVENT_DROPPED, RESCUED)


@query
def q11_fill_unknown(spark, sf_dir):
    filled = cleaning.fill_unknown(A.events_feed(spark, sf_dir), EVENT_FILLED)
    return filled.select("Global_Event_ID", *EVENT_FILLED)


@query
def q11_fill_unknown_edits(spark, sf_dir):
    flat = cleaning.flatten(A.edits_feed(spark, sf_dir), EDIT_FLATTENED)
    return cleaning.fill_unknown(flat, EDIT_FILLED).select("id", *EDIT_FILLED)


@query
def q12_flatten_edits(spark, sf_dir):
    edits = cleaning.keep_value(A.edits_feed(spark, sf_dir), "wiki", "enwiki")
    flat = cleaning.flatten(edits, EDIT_FLATTENED).drop(*EDIT_STRUCTS)
    return flat.select("id", "wiki", *EDIT_FLATTENED)


@query
def q13_gate_events(spark, sf_dir):
    kept = quality.gate(_dirty_events(spark, sf_dir), quality.EVENT_RULES)
    return kept.select("Global_Event_ID", "SQL_Date", "Event_Code", "event_timestamp")


@query
def q13_gate_edits(spark, sf_dir):
    kept = quality.gate(_dirty_edits(spark, sf_dir), quality.EDIT_RULES)
    return kept.select("id", "title", "timestamp")


@query
def q14_rule_metrics(spark, sf_dir):
    rules = quality.EVENT_RULES | quality.EVENT_WARNINGS
    return quality.rule_metrics(_dirty_events(spark, sf_dir), rules)


@query
def q14_rule_metrics_edits(spark, sf_dir):
    return quality.rule_metrics(_dirty_edits(spark, sf_dir), quality.EDIT_RULES)


@query
def q14_quarantine_metrics(spark, sf_dir):
    """Failure counts of a streamed run, from the rows it set aside."""
    raw = A.land_tsv(A.dirty_events_feed(spark, sf_dir), new_dir(spark, "q14-raw"))
    options = medallion.RunOptions(quarantine=True)
    tables = medallion.run_feeds(spark, [(medallion.EVENTS, raw)], new_dir(spark, "q14"), options)
    return quality.quarantine_metrics(tables["events"].read_quarantine(spark))


@query
def q14_stream_metrics(spark, sf_dir):
    """Failure counts that a streamed run noted batch by batch; a second run adds nothing."""
    raw, out = new_dir(spark, "q14s-raw"), new_dir(spark, "q14s")
    A.land_tsv(A.dirty_events_feed(spark, sf_dir), raw)
    options = medallion.RunOptions(observe=True, source={"maxFilesPerTrigger": "3"})
    for _ in range(2):
        tables = medallion.run_feeds(spark, [(medallion.EVENTS, raw)], out, options)
    return tables["events"].read_metrics(spark)


@query
def q15_rejected_rows(spark, sf_dir):
    bad = quality.reject(_dirty_events(spark, sf_dir), quality.EVENT_RULES)
    return bad.select(
        (F.col("Action_Geo_Feature_ID") + 5000).alias("event_id"),
        F.size(quality.FAILED_RULES).alias("n_failed"),
        F.concat_ws(",", quality.FAILED_RULES).alias("failed_rules"),
    )


@query
def q16_yyyymmdd_to_date(spark, sf_dir):
    return A.dirty_events_feed(spark, sf_dir).select(
        (F.col("Action_Geo_Feature_ID") + 5000).alias("event_id"),
        "SQL_Date",
        yyyymmdd_to_date(F.col("SQL_Date")).alias("event_date"),
    )


@query
def q17_epoch_to_timestamp(spark, sf_dir):
    ts = epoch_to_timestamp(F.col("timestamp"))
    return A.edits_feed(spark, sf_dir).select("id", _no_zone(ts).alias("edit_ts"))


# --- marts ----------------------------------------------------------------------------


@query
def q18_top_places(spark, sf_dir):
    return marts.top_places(_silver_events(spark, sf_dir))


@query
def q18_top_places_sql(spark, sf_dir):
    _silver_events(spark, sf_dir).createOrReplaceTempView("q18_events")
    return sql.sql_top_places(spark, "q18_events")


@query
def q18_top_places_sketch(spark, sf_dir):
    kept = new_dir(spark, "q18-days")
    leaders.place_summary(_silver_events(spark, sf_dir), DAY_PLACES).write.parquet(kept)
    return leaders.top_places_of(spark.read.parquet(kept), 10, FIRST_DAY, LAST_DAY)


@query
def q18_weekly_sketch(spark, sf_dir):
    days = leaders.place_summary(_silver_events(spark, sf_dir), DAY_PLACES)
    weeks = leaders.merge(days, F.trunc("period", "week"), WEEK_PLACES)
    return weeks.select(F.col("period").alias("week"), F.col("value").alias("country"), "least", "most", "rest")


@query
def q19_top_country_codes(spark, sf_dir):
    return marts.top_country_codes(_silver_events(spark, sf_dir))


@query
def q20_edits_per_minute(spark, sf_dir):
    counts = marts.edits_per_minute(_silver_edits(spark, sf_dir))
    return counts.select(_no_zone(F.col("minute_ts")).alias("minute_ts"), "cnt")


@query
def q20_edits_per_minute_sql(spark, sf_dir):
    _silver_edits(spark, sf_dir).createOrReplaceTempView("q20_edits")
    counts = sql.sql_edits_per_minute(spark, "q20_edits")
    return counts.select(_no_zone(F.col("minute_ts")).alias("minute_ts"), "cnt")


def _members(spark, sf_dir, with_me: bool) -> DataFrame:
    """Customers as users and their segments as groups, plus possibly the caller."""
    customer = A.table(spark, sf_dir, "customer")
    members = customer.select(F.col("c_name").alias("user"), F.col("c_mktsegment").alias("grp"))
    me = spark.range(1).select(F.current_user().alias("user"), F.lit(AUDITORS).alias("grp"))
    return members.unionByName(me) if with_me else members


def _masked(spark, sf_dir, label: str, with_me: bool) -> DataFrame:
    _silver_events(spark, sf_dir).createOrReplaceTempView(f"{label}_events")
    _members(spark, sf_dir, with_me).createOrReplaceTempView(f"{label}_members")
    return masking.create_masked_view(
        spark, f"{label}_secure", f"{label}_events", f"{label}_members", AUDITORS
    )


@query
def q21_masked_view(spark, sf_dir):
    return _masked(spark, sf_dir, "q21a", with_me=False)


@query
def q21_masked_view_member(spark, sf_dir):
    return _masked(spark, sf_dir, "q21b", with_me=True)


@query
def q21_masked_frame(spark, sf_dir):
    members = _members(spark, sf_dir, with_me=False)
    return masking.mask_events(_silver_events(spark, sf_dir), members, AUDITORS)


@query
def q22_place_list(spark, sf_dir):
    return marts.place_list(_silver_events(spark, sf_dir))


@query
def q22_place_list_sql(spark, sf_dir):
    _silver_events(spark, sf_dir).createOrReplaceTempView("q22_events")
    return sql.sql_place_list(spark, "q22_events")


@query
def q23_daily_events(spark, sf_dir):
    return marts.daily_events(_silver_events(spark, sf_dir), PLACE, FIRST_DAY, LAST_DAY)


@query
def q23_daily_events_sql(spark, sf_dir):
    _silver_events(spark, sf_dir).createOrReplaceTempView("q23_events")
    return sql.sql_daily_events(spark, "q23_events", PLACE, FIRST_DAY, LAST_DAY)


@query
def q24_daily_mentions(spark, sf_dir):
    return marts.daily_mentions(_silver_edits(spark, sf_dir), WORD, FIRST_DAY, LAST_DAY)


@query
def q24_daily_mentions_literal(spark, sf_dir):
    edits = _silver_edits(spark, sf_dir)
    return marts.daily_mentions(edits, WORD, FIRST_DAY, LAST_DAY, literal=True)


@query
def q24_daily_mentions_sql(spark, sf_dir):
    _silver_edits(spark, sf_dir).createOrReplaceTempView("q24_edits")
    return sql.sql_daily_mentions(spark, "q24_edits", WORD, FIRST_DAY, LAST_DAY)


@query
def q24_mentions_all_places(spark, sf_dir):
    places = marts.place_list(_silver_events(spark, sf_dir))
    return mentions.mentions_by_place(_silver_edits(spark, sf_dir), places, FIRST_DAY, LAST_DAY)


@query
def q25_totals(spark, sf_dir):
    events, edits = _silver_events(spark, sf_dir), _silver_edits(spark, sf_dir)
    parts = {
        "events": (marts.daily_events(events, PLACE, FIRST_DAY, LAST_DAY), "event_count"),
        "edits": (marts.daily_mentions(edits, WORD, FIRST_DAY, LAST_DAY), "edit_count"),
        "no events": (marts.daily_events(events, PLACE, EMPTY_FIRST, EMPTY_LAST), "event_count"),
    }
    out = None
    for label, (daily, count) in parts.items():
        row = marts.total(daily, count).select(F.lit(label).alias("feed"), "total")
        out = row if out is None else out.unionByName(row)
    return out


@query
def q26_top_event_types(spark, sf_dir):
    return marts.top_event_types(_silver_events(spark, sf_dir))


@query
def q27_peak_hours(spark, sf_dir):
    return marts.peak_hours(_silver_edits(spark, sf_dir))


@query
def q28_top_users(spark, sf_dir):
    return marts.top_users(_silver_edits(spark, sf_dir))


@query
def q28_recent_users(spark, sf_dir):
    return marts.top_users(_silver_edits(spark, sf_dir), months=1)


@query
def q29_last_month_places(spark, sf_dir):
    return marts.last_month_places(_silver_events(spark, sf_dir))


@query
def q30_daily_correlation(spark, sf_dir):
    return marts.daily_correlation(_silver_events(spark, sf_dir), _silver_edits(spark, sf_dir))


@query
def q30_spike_lags(spark, sf_dir):
    return spikes.spike_lags(_silver_events(spark, sf_dir), _silver_edits(spark, sf_dir), threshold=1)


@query
def q30_place_spikes(spark, sf_dir):
    return spikes.place_spikes(_silver_events(spark, sf_dir))


# --- table functions, streaming counts, odd rows --------------------------------------


@query
def q31_sse_table_function(spark, sf_dir):
    register_table_functions(spark)
    _transcript(spark, sf_dir, "q31-raw").createOrReplaceTempView("q31_lines")
    return spark.sql(
        """
        SELECT e.id, e.title, e.user, e.timestamp, e.revision.new AS revision_new
        FROM parse_sse(TABLE(SELECT value FROM q31_lines)) e
        """
    )


@query
def q31_sse_raw_json(spark, sf_dir):
    register_table_functions(spark)
    _transcript(spark, sf_dir, "q31r-raw").createOrReplaceTempView("q31_raw_lines")
    raw = spark.sql("SELECT d.data FROM sse_data(TABLE(SELECT value FROM q31_raw_lines)) d")
    # A record's own text is long; of the others all of it is compared.
    whole = F.length("data") > 100
    return raw.select(
        F.when(whole, F.get_json_object("data", "$.id").cast("bigint")).alias("id"),
        F.when(whole, F.get_json_object("data", "$.wiki")).alias("wiki"),
        F.when(~whole, F.col("data")).alias("other"),
    )


@query
def q32_edits_per_minute_stream(spark, sf_dir):
    """Per-minute counts over silver, as a stream behind the feed run."""
    raw = A.land_json(A.edits_feed(spark, sf_dir), new_dir(spark, "q32-raw"))
    out = new_dir(spark, "q32")
    tables = medallion.run_feeds(spark, [(medallion.EDITS, raw)], f"{out}/lake")
    silver = tables["edits"].read_silver(spark, stream=True, options={"maxFilesPerTrigger": "2"})
    minutes.start_minute_counts(silver, f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    counts = minutes.read_minute_counts(spark, f"{out}/counts")
    return counts.select(_no_zone(F.col("minute_ts")).alias("minute_ts"), "cnt")


@query
def q33_rescued_fields(spark, sf_dir):
    """Unknown fields at the top and inside ``meta``, and a misfit inside ``length``."""
    edits, i = A.edits_feed(spark, sf_dir), F.col("id")
    extra = edits.withColumn("extra", F.when(i % 3 == 0, i)).withColumn("note", F.when(i % 5 == 0, F.lit("seen")))
    extra = extra.withColumn("meta", F.col("meta").withField("zzz", F.when(i % 7 == 0, i)))
    misfit = F.when(i % 11 == 0, F.lit("long")).alias("new")
    extra = extra.withColumn("length", F.struct(misfit, F.col("length.old").alias("old")))
    raw = A.land_json(extra, new_dir(spark, "q33-raw"))
    bronze = readers.read_edits(spark, raw, rescue=True)
    return bronze.select("id", "title", F.col("meta.dt").alias("meta_dt"), F.col(RESCUED).alias("rescued"))


@query
def q33_schema_growth(spark, sf_dir):
    """Fields that appear in the second drop of three are columns in the third."""
    edits, i = A.edits_feed(spark, sf_dir), F.col("id")
    raw, lake = new_dir(spark, "q33g-raw"), new_dir(spark, "q33g")
    log = schema_log.SchemaLog(f"{lake}/_schemas/edits", EDIT_SCHEMA)
    for drop in range(3):
        rows = edits.filter(i % 3 == drop)
        if drop:
            rows = rows.withColumn("extra", F.when(i % 2 == 0, i)).withColumn("note", F.concat(F.lit("n"), i))
            rows = rows.withColumn("meta", F.col("meta").withField("zzz", i % 5 == 0))
        rows.write.mode("append").json(raw)
        tables = medallion.run_feeds(spark, [(schema_log.grown_edits(spark, log), raw)], lake)
        log.grow(spark, tables["edits"].read_bronze(spark))
    bronze = tables["edits"].read_bronze(spark)
    left = F.from_json(F.col(RESCUED), "extra string, note string, meta string")
    return bronze.select(
        "id",
        "extra",
        "note",
        F.col("meta.zzz").alias("zzz"),
        left["extra"].alias("rescued_extra"),
        left["note"].alias("rescued_note"),
        F.get_json_object(left["meta"], "$.zzz").alias("rescued_zzz"),
    )


def _malformed(spark, sf_dir, label) -> DataFrame:
    """Export lines of which some are short, long or hold a letter in a number."""
    events = A.events_feed(spark, sf_dir)
    line, i = A.tsv_line(events), F.col("Global_Event_ID")
    spoiled = (
        F.when(i % 11 == 0, F.substring_index(line, "\t", 30))
        .when(i % 13 == 0, F.concat(line, F.lit("\tsurplus")))
        .when(i % 17 == 0, F.concat(F.lit("x"), line))
        .otherwise(line)
    )
    raw = A.land_text(events.select(spoiled.alias("value")), new_dir(spark, label))
    return readers.read_events(spark, raw, corrupt=True)


@query
def q34_malformed_rows(spark, sf_dir):
    """What each line gave; a stored copy, as the corrupt text depends on the columns read."""
    path = new_dir(spark, "q34")
    _malformed(spark, sf_dir, "q34-raw").write.parquet(path)
    rows = readers.read_table(spark, path)
    return rows.select(
        "Global_Event_ID",
        (F.col("Action_Geo_Feature_ID") + 5000).alias("event_id"),
        "Event_Code",
        "Date_Added",
        F.col(CORRUPT).isNotNull().alias("is_corrupt"),
        F.regexp_extract(CORRUPT, "^x?([0-9]+)\t", 1).alias("corrupt_id"),
    )
