"""The same results as SQL over the given tables, for an independent engine.

The texts read the given tables directly; nothing the library wrote takes part.
"""

from __future__ import annotations

from catalogue.adapters import (
    BROKEN_EVERY,
    DAMAGED_EVERY,
    EVENTS_PER_ARCHIVE,
    MEMBERS,
    NO_JSON_EVERY,
    SINGLE_QUOTES_EVERY,
    TRAILING_TEXT_EVERY,
)
from catalogue.queries import (
    DAY_PLACES,
    EMPTY_FIRST,
    EMPTY_LAST,
    EVENT_VALUE_COLUMNS,
    FIRST_DAY,
    HOLE_FIRST,
    HOLE_LAST,
    LAST_DAY,
    NOT_RENEWED,
    PLACE,
    WEEK_PLACES,
    WORD,
)
from millrace.schemas import EVENT_SCHEMA

# Columns that are dropped, and columns whose missing values become Unknown.
EVENT_DROPPED = """
    Actor1_Type2_Code Actor2_Type2_Code
""".split()
EVENT_FILLED = """
    Actor1_Code Actor1_Name Actor1_Country_Code Actor1_Known_Group_Code Actor1_Ethnic_Code
    Actor1_Religion1_Code Actor1_Religion2_Code Actor1_Religion3_Code Actor1_Type1_Code
    Actor1_Type3_Code Actor2_Code Actor2_Name Actor2_Known_Group_Code Actor2_Ethnic_Code
    Actor2_Religion1_Code Actor2_Religion2_Code Actor2_Religion3_Code Actor2_Type1_Code
    Event_Code Event_Base_Code Event_Root_Code Actor1_Geo_FullName Actor1_Geo_Country_Code
    Actor1_Geo_ADM1_Code Actor1_Geo_Geonames_ID Actor2_Geo_FullName Actor2_Geo_Country_Code
    Actor2_Geo_ADM1_Code Actor2_Geo_Geonames_ID Action_Geo_FullName Action_Geo_Country_Code
    Action_Geo_ADM1_Code Action_Geo_Geonames_ID Source_URL
""".split()
EDIT_FILLED = """
    comment log_action log_action_comment log_params log_type notify_url parsedcomment
    server_name server_script_path server_url title title_url type user wiki meta_domain
    meta_dt meta_request meta_stream meta_topic meta_uri
""".split()

_SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}

_DAY = "(year(ts) * 10000 + month(ts) * 100 + day(ts))"

_ACTIVITY = """activity AS (
  SELECT e.*, c.c_name, c.c_mktsegment, n.n_name, n.n_nationkey
  FROM events e
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_EVENT_VALUES = {
    "Global_Event_ID": "event_id",
    "SQL_Date": f"CAST({_DAY} AS INTEGER)",
    "Month_Year": "CAST(year(ts) * 100 + month(ts) AS INTEGER)",
    "Year": "CAST(year(ts) AS INTEGER)",
    "Fraction_Date": "CAST(year(ts) AS DOUBLE) + CAST(dayofyear(ts) AS DOUBLE) / 365",
    "Is_Root_Event": "CAST(event_id % 2 AS INTEGER)",
    "Event_Code": "event_type",
    "Event_Base_Code": "substr(event_type, 1, 3)",
    "Event_Root_Code": "substr(event_type, 1, 2)",
    "Quad_Class": "CAST(1 + event_id % 4 AS INTEGER)",
    "Goldstein_Scale": "least(value, CAST(500.0 AS DOUBLE)) / 50",
    "Num_Mentions": "CAST(event_id % 10 AS INTEGER)",
    "Num_Sources": "CAST(event_id % 3 AS INTEGER)",
    "Num_Articles": "CAST(event_id % 7 AS INTEGER)",
    "Avg_Tone": "value / 100 - 2",
    "Action_Geo_Type": "CAST(event_id % 6 AS INTEGER)",
    "Action_Geo_Lat": "CAST(event_id % 181 - 90 AS DOUBLE)",
    "Action_Geo_Long": "CAST(event_id % 361 - 180 AS DOUBLE)",
    "Action_Geo_Feature_ID": "event_id - 5000",
    "Date_Added": f"CAST({_DAY} AS BIGINT) * 1000000 + hour(ts) * 10000 + minute(ts) * 100"
    " + CAST(second(ts) AS INTEGER)",
    "Source_URL": "CASE WHEN event_id % 20 = 0 THEN NULL"
    " ELSE concat('http://news.example/', CAST(event_id AS VARCHAR)) END",
}
_JOINED_VALUES = {
    "Actor1_Code": "c_mktsegment",
    "Actor1_Name": "c_name",
    "Actor1_Country_Code": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE n_name END",
    "Action_Geo_FullName": "CASE WHEN event_id % 50 = 0 THEN NULL ELSE n_name END",
    "Action_Geo_Country_Code": "CASE WHEN event_id % 40 = 0 THEN NULL"
    " ELSE concat('C', CAST(n_nationkey AS VARCHAR)) END",
}
_DIRTY_VALUES = {
    "Global_Event_ID": "CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_id END",
    "SQL_Date": "CAST(CASE WHEN event_id % 103 = 0 THEN 18991231 WHEN event_id % 107 = 0 THEN NULL"
    f" WHEN event_id % 109 = 0 THEN 20241399 ELSE {_DAY} END AS INTEGER)",
    "Event_Code": "CASE WHEN event_id % 139 = 0 THEN NULL ELSE event_type END",
    "Quad_Class": "CAST(CASE WHEN event_id % 113 = 0 THEN 0 WHEN event_id % 127 = 0 THEN 5"
    " WHEN event_id % 17 = 0 THEN NULL ELSE 1 + event_id % 4 END AS INTEGER)",
    "Goldstein_Scale": "CASE WHEN event_id % 131 = 0 THEN 10.5 WHEN event_id % 137 = 0 THEN -10.5"
    " WHEN event_id % 19 = 0 THEN NULL ELSE least(value, CAST(500.0 AS DOUBLE)) / 50 END",
    "Is_Root_Event": "CAST(CASE WHEN event_id % 149 = 0 THEN 2 WHEN event_id % 151 = 0 THEN NULL"
    " ELSE event_id % 2 END AS INTEGER)",
    "Num_Mentions": "CASE WHEN event_id % 191 = 0 THEN -1 WHEN event_id % 31 = 0 THEN NULL"
    " ELSE event_id % 10 END",
    "Num_Sources": "CASE WHEN event_id % 193 = 0 THEN -1 WHEN event_id % 31 = 0 THEN NULL"
    " ELSE event_id % 3 END",
    "Num_Articles": "CASE WHEN event_id % 197 = 0 THEN -1 WHEN event_id % 31 = 0 THEN NULL"
    " ELSE event_id % 7 END",
}
for _place, (_lat, _long, _high, _low) in {
    "Actor1": (157, 167, 177, 178),
    "Actor2": (163, 173, 183, 184),
    "Action": (167, 177, 187, 188),
}.items():
    _DIRTY_VALUES[f"{_place}_Geo_Lat"] = (
        f"CASE WHEN event_id % {_lat} = 0 THEN 90.5 WHEN event_id % 23 = 0 THEN NULL"
        " ELSE event_id % 181 - 90 END"
    )
    _DIRTY_VALUES[f"{_place}_Geo_Long"] = (
        f"CASE WHEN event_id % {_long} = 0 THEN -180.5 WHEN event_id % 29 = 0 THEN NULL"
        " ELSE event_id % 361 - 180 END"
    )
    _DIRTY_VALUES[f"{_place}_Geo_Type"] = (
        f"CASE WHEN event_id % {_high} = 0 THEN 6 WHEN event_id % {_low} = 0 THEN -1"
        " ELSE event_id % 6 END"
    )


def _columns(values: dict[str, str]) -> str:
    out = []
    for f in EVENT_SCHEMA:
        kind = _SQL_TYPES[f.dataType.simpleString()]
        out.append(f"CAST({values.get(f.name, 'NULL')} AS {kind}) AS {f.name}")
    return ",\n    ".join(out)


_FEED = f"feed AS (\n  SELECT {_columns(_EVENT_VALUES | _JOINED_VALUES)}\n  FROM activity)"
_DIRTY = f"dirty AS (\n  SELECT event_id, {_columns(_EVENT_VALUES | _DIRTY_VALUES)}\n  FROM events)"

# Fixed rules of the event feed, as one condition per rule name; NULL means failed.
_RULES = {
    "valid_global_event_id": "Global_Event_ID IS NOT NULL",
    "valid_event_code": "coalesce(Event_Code, 'Unknown') IS NOT NULL",
    "valid_sql_date": "SQL_Date BETWEEN 19000101 AND 99991231",
    "valid_quad_class": "coalesce(Quad_Class, 1) BETWEEN 1 AND 4",
    "valid_goldstein_scale": "coalesce(Goldstein_Scale, 0) BETWEEN -10 AND 10",
    "valid_is_root_event": "Is_Root_Event IN (0, 1)",
}
for _p in ("Actor1", "Actor2", "Action"):
    _RULES[f"valid_{_p.lower()}_geo_lat"] = f"coalesce(abs({_p}_Geo_Lat), 0) <= 90"
    _RULES[f"valid_{_p.lower()}_geo_long"] = f"coalesce(abs({_p}_Geo_Long), 0) <= 180"
for _c in ("Num_Mentions", "Num_Sources", "Num_Articles"):
    _RULES[f"valid_{_c.lower()}"] = f"coalesce({_c}, 0) >= 0"
for _p in ("Actor1", "Actor2", "Action"):
    _RULES[f"valid_{_p.lower()}_geo_type"] = f"coalesce({_p}_Geo_Type, 0) IN (0, 1, 2, 3, 4, 5)"
_PASS = " AND ".join(f"({r})" for r in _RULES.values())


def _failed(rule: str) -> str:
    return f"coalesce(NOT ({rule}), TRUE)"


_DATE = "CAST(try_strptime(CAST(SQL_Date AS VARCHAR), '%Y%m%d') AS DATE)"


def _filled(columns) -> str:
    return ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in columns)


_REPLACED = f"* EXCLUDE ({', '.join(EVENT_DROPPED)}) REPLACE ({_filled(EVENT_FILLED)})"
_SILVER_EVENTS = f"""silver AS (
  SELECT {_REPLACED}, {_DATE} AS event_timestamp FROM feed WHERE {_PASS})"""

_EDIT_VALUES = """
    CASE WHEN event_id % 4 = 0 THEN 'dewiki' ELSE 'enwiki' END AS wiki,
    CASE WHEN event_id % 90 = 0 THEN NULL WHEN event_id % 91 = 0 THEN ''
         ELSE concat(n_name, ' page ', CAST(event_id AS VARCHAR)) END AS title,
    concat('u', CAST(user_id AS VARCHAR)) AS "user",
    event_type AS type,
    event_id % 3 = 0 AS bot,
    CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS length_new,
    CAST(NULL AS BIGINT) AS length_old,
    event_id AS revision_new,
    event_id - 1 AS revision_old,
    'en.example' AS meta_domain,
    CAST((year(ts) * 10000 + month(ts) * 100 + day(ts)) AS VARCHAR) AS meta_dt,
    event_id AS meta_offset,
    event_id % 3 AS meta_partition,
    CAST(NULL AS VARCHAR) AS meta_request,
    CAST(NULL AS VARCHAR) AS meta_stream,
    CAST(NULL AS VARCHAR) AS meta_topic,
    CAST(NULL AS VARCHAR) AS meta_uri"""
_EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"
_EDITS = f"""edits AS (
  SELECT event_id AS id, {_EPOCH} AS timestamp, {_EDIT_VALUES}
  FROM activity)"""
_DIRTY_EDITS = f"""dirty_edits AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE event_id END AS id,
    CASE WHEN event_id % 103 = 0 THEN 0 WHEN event_id % 107 = 0 THEN NULL ELSE {_EPOCH} END AS timestamp,
    {_EDIT_VALUES}
  FROM activity)"""
_SILVER_EDITS = """silver_edits AS (
  SELECT * REPLACE (coalesce(title, 'Unknown') AS title),
    make_timestamp(timestamp * 1000000) AS event_timestamp
  FROM edits
  WHERE wiki = 'enwiki' AND id IS NOT NULL AND timestamp > 0
    AND length(coalesce(title, 'Unknown')) > 0)"""

_SLOT = "time_bucket(INTERVAL '15 minutes', ts, TIMESTAMP '2024-01-01 00:00:00')"
_CALENDAR = f"""calendar AS (
  SELECT unnest(generate_series(min({_SLOT}), max({_SLOT}), INTERVAL '15 minutes')) AS slot
  FROM events)"""
_STAMP = "strftime(slot, '%Y%m%d%H%M%S')"
_ARCHIVE = f"""strftime(TIMESTAMP '2024-01-01 00:00:00'
    + (event_id // {EVENTS_PER_ARCHIVE}) * INTERVAL '15 minutes', '%Y%m%d%H%M%S')"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_WITH_FEED = _with(_ACTIVITY, _FEED)
_WITH_SILVER = _with(_ACTIVITY, _FEED, _SILVER_EVENTS)
_WITH_EDITS = _with(_ACTIVITY, _EDITS)
_WITH_SILVER_EDITS = _with(_ACTIVITY, _EDITS, _SILVER_EDITS)
_WITH_DIRTY = _with(_DIRTY)

_VALUES = ", ".join(EVENT_VALUE_COLUMNS)

_TOP_PLACES = """
SELECT Action_Geo_FullName AS country, count(*) AS event_count
FROM silver WHERE Action_Geo_FullName <> 'Unknown' {more}
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
_PER_MINUTE = """
SELECT date_trunc('minute', make_timestamp(timestamp * 1000000)) AS minute_ts, count(*) AS cnt
FROM {edits} WHERE wiki = 'enwiki' GROUP BY 1"""
_DAILY_EVENTS = f"""
SELECT event_timestamp AS date, count(*) AS event_count FROM silver
WHERE Action_Geo_FullName = '{PLACE}'
  AND event_timestamp BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'
GROUP BY 1"""
_DAILY_MENTIONS = """
SELECT CAST(event_timestamp AS DATE) AS date, count(*) AS edit_count FROM silver_edits
WHERE {hit} AND CAST(event_timestamp AS DATE) BETWEEN DATE '%s' AND DATE '%s'
GROUP BY 1""" % (FIRST_DAY, LAST_DAY)
_LIKE = f"title LIKE '%{WORD}%'"
_MASKED = """
SELECT Year, Action_Geo_FullName, event_timestamp, {url} AS SOURCEURL FROM silver"""
_PLACE_LIST = "SELECT DISTINCT Action_Geo_FullName AS country FROM silver"


def _rule_counts(table: str, rules: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {_failed(rule)}) AS failed FROM {table}"
        for name, rule in rules.items()
    )


_EDIT_RULES = {
    "valid_id": "id IS NOT NULL",
    "valid_timestamp": "timestamp > 0",
    "non_empty_title": "coalesce(title, 'Unknown') <> ''",
}
_WARNED = _RULES | {"readable_sql_date": f"SQL_Date IS NULL OR {_DATE} IS NOT NULL"}
_EN_DIRTY = "(SELECT * FROM dirty_edits WHERE wiki = 'enwiki')"
_N_FAILED = " + ".join(f"CAST({_failed(r)} AS INTEGER)" for r in _RULES.values())
_FAILED_NAMES = ", ".join(f"CASE WHEN {_failed(r)} THEN '{n}' END" for n, r in _RULES.items())
_NULL_TEXT = ", ".join(
    f"'Unknown' AS {c}"
    for c in EDIT_FILLED
    if c not in ("title", "type", "user", "wiki", "meta_domain", "meta_dt")
    and not c.startswith("meta_")
)

_OTHER_PAYLOADS = f"""
SELECT concat('not json ', CAST(event_id AS VARCHAR)) AS payload, NULL AS lenient_id
FROM activity WHERE event_id % {NO_JSON_EVERY} = 0
UNION ALL SELECT concat('{{''id'':', CAST(event_id AS VARCHAR), '}}'), event_id
FROM activity WHERE event_id % {SINGLE_QUOTES_EVERY} = 0
UNION ALL SELECT concat('{{"id":', CAST(event_id AS VARCHAR), '}} trailing'), event_id
FROM activity WHERE event_id % {TRAILING_TEXT_EVERY} = 0"""

ORACLES: dict[str, str] = {
    "q01_tsv_stream_ingest": _WITH_FEED + f"SELECT {_VALUES} FROM feed",
    "q02_json_stream_ingest": _WITH_EDITS
    + 'SELECT id, title, "user", wiki, bot, timestamp, meta_dt, meta_partition, length_new,'
    " revision_old FROM edits",
    "q03_sse_parse": _WITH_EDITS + 'SELECT id, title, "user", timestamp, revision_new FROM edits',
    "q03_sse_corrupt": _with(_ACTIVITY) + f"SELECT payload FROM ({_OTHER_PAYLOADS})",
    "q04_interval_manifest": _with(_CALENDAR)
    + f"SELECT {_STAMP} AS stamp, concat({_STAMP}, '.export.CSV.zip') AS file_name FROM calendar",
    "q05_landing_gaps": _with(_CALENDAR)
    + f"""SELECT {_STAMP} AS stamp FROM calendar
        WHERE slot NOT IN (SELECT {_SLOT} FROM events)""",
    "q05_landing_gaps_files": _with(_CALENDAR)
    + f"""SELECT {_STAMP} AS stamp FROM calendar
        WHERE {_STAMP} NOT IN (SELECT {_ARCHIVE} FROM events)""",
    "q06_zip_extract": _WITH_FEED.replace("FROM activity)", ", event_id FROM activity)")
    + f"SELECT concat({_ARCHIVE}, '.export.CSV') AS member, {_VALUES} FROM feed",
    "q06_member_store": _WITH_FEED
    + "SELECT Global_Event_ID, Event_Code, Action_Geo_FullName FROM feed",
    "q06_unreadable_archives": f"""SELECT DISTINCT concat({_ARCHIVE}, '.broken.zip') AS archive
        FROM events WHERE (event_id // {EVENTS_PER_ARCHIVE}) % {BROKEN_EVERY} = 0""",
    "q06_damaged_members": _WITH_FEED.replace("FROM activity)", ", event_id FROM activity)")
    + f""", placed AS (
        SELECT concat({_ARCHIVE}, '.', substr('{"".join(MEMBERS)}', event_id % {len(MEMBERS)} + 1, 1), '.CSV') AS member,
               Global_Event_ID, Event_Code,
               (event_id // {EVENTS_PER_ARCHIVE}) % {DAMAGED_EVERY} = 0 AND event_id % {len(MEMBERS)} = 1 AS damaged
        FROM feed)
        SELECT * FROM placed WHERE NOT damaged
        UNION ALL SELECT DISTINCT member, NULL, NULL, TRUE FROM placed WHERE damaged""",
    "q07_batched_json_sink": """SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type,
        value, props FROM events""",
    "q07_transcript_to_json_batches": _WITH_EDITS
    # The landed text is read by the ordinary JSON reader, which is lenient.
    + f"""SELECT id, title, wiki FROM edits
        UNION ALL SELECT lenient_id, NULL, NULL FROM ({_OTHER_PAYLOADS})""",
    "q08_bounded_replay": """SELECT event_id, user_id, event_type FROM events
        ORDER BY event_id LIMIT 1000""",
    "q09_medallion_events": _WITH_SILVER
    + f"SELECT {_VALUES}, Actor2_Name, event_timestamp FROM silver",
    "q09_medallion_edits": _WITH_SILVER_EDITS
    + """SELECT id, title, "user", meta_dt, 'Unknown' AS meta_request, length_new, event_timestamp
        FROM silver_edits""",
    "q09_medallion_archives": _WITH_SILVER + f"SELECT {_VALUES}, event_timestamp FROM silver",
    "q09_medallion_transcripts": _WITH_SILVER_EDITS
    + 'SELECT id, title, "user", timestamp FROM silver_edits',
    "q09_archives_unreadable": f"""SELECT DISTINCT concat({_ARCHIVE}, '.broken.zip') AS archive,
        NULL AS member, NULL AS text
        FROM events WHERE (event_id // {EVENTS_PER_ARCHIVE}) % {BROKEN_EVERY} = 0""",
    "q09_transcripts_unreadable": _with(_ACTIVITY)
    + f"SELECT payload AS text, 'no JSON object' AS error FROM ({_OTHER_PAYLOADS})",
    "q09_published_tables": _WITH_SILVER
    + f"SELECT *, (SELECT count(*) FROM silver) AS n_silver FROM ({_TOP_PLACES.format(more='')})",
    "q10_drop_columns": _WITH_FEED + f"SELECT * EXCLUDE ({', '.join(EVENT_DROPPED)}) FROM feed",
    "q11_fill_unknown": _WITH_FEED + f"SELECT Global_Event_ID, {_filled(EVENT_FILLED)} FROM feed",
    "q11_fill_unknown_edits": _WITH_EDITS
    + f"""SELECT id, coalesce(title, 'Unknown') AS title, type, "user", wiki, meta_domain, meta_dt,
        {_filled(c for c in EDIT_FILLED if c.startswith("meta_") and c not in ("meta_domain", "meta_dt"))},
        {_NULL_TEXT} FROM edits""",
    "q12_flatten_edits": _WITH_EDITS
    + """SELECT id, wiki, length_new, length_old, revision_new, revision_old, meta_domain, meta_dt,
        meta_offset, meta_partition, meta_request, meta_stream, meta_topic, meta_uri
        FROM edits WHERE wiki = 'enwiki'""",
    "q13_gate_events": _WITH_DIRTY
    + f"""SELECT Global_Event_ID, SQL_Date, coalesce(Event_Code, 'Unknown') AS Event_Code,
        {_DATE} AS event_timestamp FROM dirty WHERE {_PASS}""",
    "q13_gate_edits": _with(_ACTIVITY, _DIRTY_EDITS)
    + f"""SELECT id, coalesce(title, 'Unknown') AS title, timestamp FROM {_EN_DIRTY}
        WHERE {" AND ".join(_EDIT_RULES.values())}""",
    "q14_rule_metrics": _WITH_DIRTY + _rule_counts("dirty", _WARNED),
    "q14_rule_metrics_edits": _with(_ACTIVITY, _DIRTY_EDITS) + _rule_counts(_EN_DIRTY, _EDIT_RULES),
    "q14_quarantine_metrics": _WITH_DIRTY
    + f"SELECT * FROM ({_rule_counts('dirty', _RULES)}) WHERE failed > 0",
    "q15_rejected_rows": _WITH_DIRTY
    + f"""SELECT event_id, {_N_FAILED} AS n_failed, concat_ws(',', {_FAILED_NAMES}) AS failed_rules
        FROM dirty WHERE {_N_FAILED} > 0""",
    "q16_yyyymmdd_to_date": _WITH_DIRTY
    + f"SELECT event_id, SQL_Date, {_DATE} AS event_date FROM dirty",
    "q17_epoch_to_timestamp": "SELECT event_id AS id, date_trunc('second', ts) AS edit_ts FROM events",
    "q18_top_places": _WITH_SILVER + _TOP_PLACES.format(more=""),
    "q18_top_places_sql": _WITH_SILVER + _TOP_PLACES.format(more=""),
    "q19_top_country_codes": _WITH_SILVER
    + """SELECT Action_Geo_Country_Code AS country, count(*) AS events_count
        FROM silver WHERE Action_Geo_Country_Code <> 'Unknown'
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "q20_edits_per_minute": _WITH_SILVER_EDITS + _PER_MINUTE.format(edits="silver_edits"),
    "q20_edits_per_minute_sql": _WITH_SILVER_EDITS + _PER_MINUTE.format(edits="silver_edits"),
    "q21_masked_view": _WITH_SILVER + _MASKED.format(url="'Restricted'"),
    "q21_masked_view_member": _WITH_SILVER + _MASKED.format(url="Source_URL"),
    "q21_masked_frame": _WITH_SILVER + _MASKED.format(url="'Restricted'"),
    "q22_place_list": _WITH_SILVER + _PLACE_LIST,
    "q22_place_list_sql": _WITH_SILVER + _PLACE_LIST,
    "q23_daily_events": _WITH_SILVER + _DAILY_EVENTS,
    "q23_daily_events_sql": _WITH_SILVER + _DAILY_EVENTS,
    "q24_daily_mentions": _WITH_SILVER_EDITS + _DAILY_MENTIONS.format(hit=_LIKE),
    "q24_daily_mentions_literal": _WITH_SILVER_EDITS
    + _DAILY_MENTIONS.format(hit=f"contains(title, '{WORD}')"),
    "q24_daily_mentions_sql": _WITH_SILVER_EDITS + _DAILY_MENTIONS.format(hit=_LIKE),
    "q25_totals": _with(_ACTIVITY, _FEED, _SILVER_EVENTS, _EDITS, _SILVER_EDITS)
    + f"""SELECT 'events' AS feed, CAST(coalesce(sum(event_count), 0) AS BIGINT) AS total
        FROM ({_DAILY_EVENTS})
        UNION ALL SELECT 'edits', CAST(coalesce(sum(edit_count), 0) AS BIGINT)
        FROM ({_DAILY_MENTIONS.format(hit=_LIKE)})
        UNION ALL SELECT 'no events', count(*) FROM silver
        WHERE event_timestamp BETWEEN DATE '{EMPTY_FIRST}' AND DATE '{EMPTY_LAST}'""",
    "q26_top_event_types": _WITH_SILVER
    + """SELECT Event_Code AS event_code, count(*) AS event_count FROM silver
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "q27_peak_hours": _WITH_SILVER_EDITS
    + """SELECT CAST(hour(event_timestamp) AS INTEGER) AS hour, count(*) AS edit_count
        FROM silver_edits GROUP BY 1""",
    "q28_top_users": _WITH_SILVER_EDITS
    + """SELECT "user", count(*) AS edit_count FROM silver_edits
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "q28_recent_users": _WITH_SILVER_EDITS
    + """SELECT "user", count(*) AS edit_count FROM silver_edits
        WHERE CAST(event_timestamp AS DATE)
            >= (SELECT CAST(max(event_timestamp) AS DATE) - INTERVAL '1 month' FROM silver_edits)
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "q29_last_month_places": _WITH_SILVER
    + _TOP_PLACES.format(
        more="AND event_timestamp >= (SELECT max(event_timestamp) - INTERVAL '1 month' FROM silver)"
    ),
    "q30_daily_correlation": _with(_ACTIVITY, _FEED, _SILVER_EVENTS, _EDITS, _SILVER_EDITS)
    + """SELECT round(corr(a.n, b.n), 6) AS r, count(*) AS n_days
        FROM (SELECT event_timestamp AS d, count(*) AS n FROM silver GROUP BY 1) a
        JOIN (SELECT CAST(event_timestamp AS DATE) AS d, count(*) AS n
              FROM silver_edits GROUP BY 1) b ON a.d = b.d""",
    "q31_sse_table_function": _WITH_EDITS
    + 'SELECT id, title, "user", timestamp, revision_new FROM edits',
    "q31_sse_raw_json": _WITH_EDITS
    + f"""SELECT id, wiki, NULL AS other FROM edits
        UNION ALL SELECT NULL, NULL, payload FROM ({_OTHER_PAYLOADS})""",
    "q32_edits_per_minute_stream": _WITH_SILVER_EDITS + _PER_MINUTE.format(edits="silver_edits"),
    # Fields in the order of the record: nested objects follow the unknown names.
    "q33_rescued_fields": _WITH_EDITS
    + """SELECT id, title, meta_dt, CASE WHEN parts <> '' THEN concat('{', parts, '}') END AS rescued
        FROM (SELECT *, concat_ws(',',
            CASE WHEN id % 3 = 0 THEN concat('"extra":"', CAST(id AS VARCHAR), '"') END,
            CASE WHEN id % 5 = 0 THEN '"note":"seen"' END,
            CASE WHEN id % 11 = 0 THEN '"length":"{\\"new\\":\\"long\\"}"' END,
            CASE WHEN id % 7 = 0 THEN concat('"meta":"{\\"zzz\\":\\"', CAST(id AS VARCHAR), '\\"}"') END
          ) AS parts FROM edits)""",
    "q34_malformed_rows": _WITH_FEED.replace("FROM activity)", ", event_id FROM activity)")
    + """SELECT CASE WHEN short OR long OR NOT letter THEN event_id END AS Global_Event_ID,
          CASE WHEN NOT short THEN event_id END AS event_id,
          CASE WHEN Event_Code IS NOT NULL THEN Event_Code END AS Event_Code,
          CASE WHEN NOT short THEN Date_Added END AS Date_Added,
          short OR long OR letter AS is_corrupt,
          CASE WHEN short OR long OR letter THEN CAST(event_id AS VARCHAR) END AS corrupt_id
        FROM (SELECT *, event_id % 11 = 0 AS short, event_id % 13 = 0 AS long,
                event_id % 17 = 0 AS letter FROM feed)""",
}
ORACLES["q09_named_chain"] = ORACLES["q09_published_tables"]
ORACLES["q14_stream_metrics"] = ORACLES["q14_rule_metrics"]
ORACLES["q05_gap_ranges"] = (
    _with(_CALENDAR)
    + f""", missing AS (
        SELECT slot FROM calendar WHERE slot NOT IN (
            SELECT {_SLOT} FROM events WHERE CAST(ts AS DATE) NOT BETWEEN DATE '{HOLE_FIRST}' AND DATE '{HOLE_LAST}')),
    runs AS (SELECT slot, slot - row_number() OVER (ORDER BY slot) * INTERVAL '15 minutes' AS run FROM missing)
    SELECT min(slot) AS first, max(slot) AS last, count(*) AS n FROM runs GROUP BY run"""
)
ORACLES["q24_mentions_all_places"] = _with(_ACTIVITY, _FEED, _SILVER_EVENTS, _EDITS, _SILVER_EDITS) + f"""
    SELECT p.country, CAST(e.event_timestamp AS DATE) AS date, count(*) AS edit_count
    FROM ({_PLACE_LIST}) p JOIN silver_edits e ON e.title LIKE '%' || p.country || '%'
    WHERE p.country IS NOT NULL AND CAST(e.event_timestamp AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'
    GROUP BY 1, 2"""


ORACLES["q06_replaced_member"] = _WITH_FEED.replace("FROM activity)", ", event_id FROM activity)") + f"""
    SELECT CASE WHEN old THEN 0 ELSE Global_Event_ID END AS Global_Event_ID,
           CASE WHEN NOT old THEN Event_Code END AS Event_Code,
           CASE WHEN NOT old THEN Action_Geo_FullName END AS Action_Geo_FullName
    FROM (SELECT *, substr({_ARCHIVE}, 11, 2) = '{NOT_RENEWED}' AS old FROM feed)"""


def _spikes(daily: str, threshold: int) -> str:
    """CTEs that end in ``<daily>_rose`` for a CTE (place, d, n)."""
    return f"""{daily}_before AS (
        SELECT a.place, a.d, coalesce(p.n, 0) AS v
        FROM {daily} a CROSS JOIN generate_series(1, 14) k(k)
        LEFT JOIN {daily} p ON p.place = a.place AND p.d = a.d - CAST(k.k AS INTEGER)
        WHERE a.d - CAST(k.k AS INTEGER) >= (SELECT min(d) FROM {daily})),
    {daily}_middle AS (
        SELECT place, d, median(v) AS m FROM {daily}_before GROUP BY ALL HAVING count(*) >= 5),
    {daily}_apart AS (
        SELECT x.place, x.d, x.m, median(abs(y.v - x.m)) AS apart
        FROM {daily}_middle x JOIN {daily}_before y ON x.place = y.place AND x.d = y.d GROUP BY ALL),
    {daily}_rose AS (
        SELECT s.*, r.m, r.apart, coalesce(s.n - r.m >= {threshold} * greatest(r.apart, 1), FALSE) AS rose
        FROM {daily} s LEFT JOIN {daily}_apart r ON s.place = r.place AND s.d = r.d)"""


_BOTH_SILVER = _with(_ACTIVITY, _FEED, _SILVER_EVENTS, _EDITS, _SILVER_EDITS)
ORACLES["q30_spike_lags"] = f"""{_BOTH_SILVER},
    news AS (SELECT 0 AS place, CAST(event_timestamp AS DATE) AS d, count(*) AS n
             FROM silver WHERE event_timestamp IS NOT NULL GROUP BY ALL),
    wiki AS (SELECT 0 AS place, CAST(event_timestamp AS DATE) AS d, count(*) AS n
             FROM silver_edits WHERE event_timestamp IS NOT NULL GROUP BY ALL),
    {_spikes("news", 1)}, {_spikes("wiki", 1)}
    SELECT CAST(k.k AS INTEGER) AS lag, round(corr(a.n, b.n), 6) AS r, count(*) AS n_days,
           count(*) FILTER (a.rose) AS event_spikes, count(*) FILTER (a.rose AND b.rose) AS answered
    FROM generate_series(-3, 3) k(k) CROSS JOIN news_rose a
    JOIN wiki_rose b ON b.d = a.d + CAST(k.k AS INTEGER) GROUP BY 1"""
ORACLES["q30_place_spikes"] = f"""{_WITH_SILVER},
    news AS (SELECT Action_Geo_FullName AS place, CAST(event_timestamp AS DATE) AS d, count(*) AS n
             FROM silver WHERE event_timestamp IS NOT NULL GROUP BY ALL),
    {_spikes("news", 3)}
    SELECT place AS country, d AS date, n AS event_count, m AS median, apart AS deviation, rose AS is_spike
    FROM news_rose"""
ORACLES["q33_schema_growth"] = _WITH_EDITS + """
    SELECT id,
           CASE WHEN id % 3 = 2 AND id % 2 = 0 THEN id END AS extra,
           CASE WHEN id % 3 = 2 THEN concat('n', CAST(id AS VARCHAR)) END AS note,
           CASE WHEN id % 3 = 2 THEN id % 5 = 0 END AS zzz,
           CASE WHEN id % 3 = 1 AND id % 2 = 0 THEN CAST(id AS VARCHAR) END AS rescued_extra,
           CASE WHEN id % 3 = 1 THEN concat('n', CAST(id AS VARCHAR)) END AS rescued_note,
           CASE WHEN id % 3 = 1 THEN CASE WHEN id % 5 = 0 THEN 'true' ELSE 'false' END END AS rescued_zzz
    FROM edits"""
_PLACE_DAYS = f"""{_WITH_SILVER},
    daily AS (SELECT CAST(event_timestamp AS DATE) AS d, Action_Geo_FullName AS place, count(*) AS n
              FROM silver WHERE Action_Geo_FullName <> 'Unknown' GROUP BY ALL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY n DESC, place) AS r FROM daily),
    listed AS (SELECT * FROM placed WHERE r <= {DAY_PLACES}),
    rests AS (SELECT d, coalesce(max(n) FILTER (r > {DAY_PLACES}), 0) AS rest FROM placed GROUP BY d)"""
ORACLES["q18_top_places_sketch"] = f"""{_PLACE_DAYS},
    chosen AS (SELECT * FROM rests WHERE d BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'),
    bounds AS (
        SELECT p.place, sum(coalesce(l.n, 0)) AS least, sum(coalesce(l.n, c.rest)) AS most
        FROM (SELECT DISTINCT place FROM listed JOIN chosen USING (d)) p CROSS JOIN chosen c
        LEFT JOIN listed l ON l.d = c.d AND l.place = p.place GROUP BY 1),
    ordered AS (SELECT *, row_number() OVER (ORDER BY least DESC, place) AS r FROM bounds),
    parted AS (
        SELECT o.r, (o.least > t.unseen OR t.unseen = 0) AND NOT EXISTS (
            SELECT 1 FROM ordered b WHERE b.r > o.r AND (b.most > o.least OR b.most = o.least AND b.place < o.place)) AS ok
        FROM ordered o CROSS JOIN (SELECT sum(rest) AS unseen FROM chosen) t)
    SELECT place AS country, CAST(least AS BIGINT) AS event_count, CAST(most AS BIGINT) AS most,
           p.ok AND coalesce(q.ok, TRUE) AS settled
    FROM ordered o JOIN parted p ON p.r = o.r LEFT JOIN parted q ON q.r = o.r - 1 WHERE o.r <= 10"""
ORACLES["q18_weekly_sketch"] = f"""{_PLACE_DAYS},
    weeks AS (SELECT *, CAST(date_trunc('week', d) AS DATE) AS w FROM rests),
    bounds AS (
        SELECT c.w, p.place, sum(coalesce(l.n, 0)) AS least, sum(coalesce(l.n, c.rest)) AS most, sum(c.rest) AS unseen
        FROM (SELECT DISTINCT w, place FROM listed JOIN weeks USING (d)) p
        JOIN weeks c ON c.w IS NOT DISTINCT FROM p.w
        LEFT JOIN listed l ON l.d IS NOT DISTINCT FROM c.d AND l.place = p.place GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY most DESC, place) AS r FROM bounds),
    left_out AS (
        SELECT *, greatest(unseen, coalesce(max(most) FILTER (r > {WEEK_PLACES}) OVER (PARTITION BY w), 0)) AS rest
        FROM ranked)
    SELECT w AS week, place AS country, CAST(least AS BIGINT) AS least, CAST(most AS BIGINT) AS most,
           CAST(rest AS BIGINT) AS rest FROM left_out WHERE r <= {WEEK_PLACES}"""
