"""The given tables in the shape of the two feeds.

``events`` joined with its customer and nation supplies the values; columns the tables have
no counterpart for are typed NULLs. No join is hinted: Catalyst broadcasts a side whose size
it knows to be small and otherwise sorts and merges, where adaptive execution splits the
partition of a user who owns a large part of the events.
"""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import EDIT_SCHEMA, EVENT_SCHEMA
from millrace.sources.intervals import NAME_PATTERN, NAME_SUFFIX, STEP_MINUTES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the name and segment of their customer and the nation of that."""
    events = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    home = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return events.join(home, events.user_id == home.c_custkey)


def _shaped(df: DataFrame, schema: T.StructType, values: dict[str, str]) -> DataFrame:
    """``df`` projected to ``schema``; fields without an expression are typed NULLs."""
    return df.selectExpr(
        *[
            f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in schema
        ]
    )


_DAY = "(year(ts) * 10000 + month(ts) * 100 + day(ts))"

# Values that need the events table only.
_EVENT_VALUES = {
    "Global_Event_ID": "event_id",
    "SQL_Date": _DAY,
    "Month_Year": "year(ts) * 100 + month(ts)",
    "Year": "year(ts)",
    "Fraction_Date": "double(year(ts)) + double(dayofyear(ts)) / 365",
    "Is_Root_Event": "event_id % 2",
    "Event_Code": "event_type",
    "Event_Base_Code": "left(event_type, 3)",
    "Event_Root_Code": "left(event_type, 2)",
    "Quad_Class": "1 + event_id % 4",
    "Goldstein_Scale": "least(value, 500D) / 50",
    "Num_Mentions": "event_id % 10",
    "Num_Sources": "event_id % 3",
    "Num_Articles": "event_id % 7",
    "Avg_Tone": "value / 100 - 2",
    "Action_Geo_Type": "event_id % 6",
    "Action_Geo_Lat": "event_id % 181 - 90",
    "Action_Geo_Long": "event_id % 361 - 180",
    "Action_Geo_Feature_ID": "event_id - 5000",
    "Date_Added": f"{_DAY} * 1000000L + hour(ts) * 10000 + minute(ts) * 100 + second(ts)",
    "Source_URL": "if(event_id % 20 = 0, NULL, 'http://news.example/' || event_id)",
}
_EVENT_VALUES_JOINED = {
    "Actor1_Code": "c_mktsegment",
    "Actor1_Name": "c_name",
    "Actor1_Country_Code": "if(event_id % 5 = 0, NULL, n_name)",
    "Action_Geo_FullName": "if(event_id % 50 = 0, NULL, n_name)",
    "Action_Geo_Country_Code": "if(event_id % 40 = 0, NULL, 'C' || n_nationkey)",
}


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed event export rows."""
    return _shaped(_activity(spark, sf_dir), EVENT_SCHEMA, _EVENT_VALUES | _EVENT_VALUES_JOINED)


def _spoiled(cases: list[tuple[int, object]], otherwise: str) -> str:
    """The value of the first case whose divisor divides the event id."""
    branches = " ".join(
        f"WHEN event_id % {n} = 0 THEN {'NULL' if v is None else v}" for n, v in cases
    )
    return f"CASE {branches} ELSE {otherwise} END"


def dirty_events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows with values out of bounds at known ids."""
    bad = {
        "Global_Event_ID": [(101, None)],
        "SQL_Date": [(103, 18991231), (107, None), (109, 20241399)],
        "Event_Code": [(139, None)],
        "Quad_Class": [(113, 0), (127, 5), (17, None)],
        "Goldstein_Scale": [(131, "10.5D"), (137, "-10.5D"), (19, None)],
        "Is_Root_Event": [(149, 2), (151, None)],
        "Num_Mentions": [(191, -1), (31, None)],
        "Num_Sources": [(193, -1), (31, None)],
        "Num_Articles": [(197, -1), (31, None)],
    }
    values = _EVENT_VALUES | {c: _spoiled(cases, _EVENT_VALUES[c]) for c, cases in bad.items()}
    places = {
        "Actor1": (157, 167, 177, 178),
        "Actor2": (163, 173, 183, 184),
        "Action": (167, 177, 187, 188),
    }
    for place, (lat, long, high, low) in places.items():
        values |= {
            f"{place}_Geo_Lat": _spoiled([(lat, "90.5D"), (23, None)], "event_id % 181 - 90"),
            f"{place}_Geo_Long": _spoiled([(long, "-180.5D"), (29, None)], "event_id % 361 - 180"),
            f"{place}_Geo_Type": _spoiled([(high, 6), (low, -1)], "event_id % 6"),
        }
    return _shaped(table(spark, sf_dir, "events"), EVENT_SCHEMA, values)


_EDIT_VALUES = {
    "id": "event_id",
    "wiki": "if(event_id % 4 = 0, 'dewiki', 'enwiki')",
    "title": "CASE WHEN event_id % 90 = 0 THEN NULL WHEN event_id % 91 = 0 THEN ''"
    " ELSE n_name || ' page ' || event_id END",
    "user": "'u' || user_id",
    "type": "event_type",
    "bot": "event_id % 3 = 0",
    "timestamp": "unix_timestamp(CAST(ts AS TIMESTAMP))",
    "length": "struct(if(event_id % 6 = 0, NULL, floor(value)), NULL)",
    "revision": "struct(event_id, event_id - 1)",
    "meta": f"struct('en.example', string({_DAY}), NULL, event_id, event_id % 3,"
    " NULL, NULL, NULL, NULL)",
}


def edits_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed change-feed records."""
    return _shaped(_activity(spark, sf_dir), EDIT_SCHEMA, _EDIT_VALUES)


def dirty_edits_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-feed records with missing ids and times at known ids."""
    bad = {"id": [(101, None)], "timestamp": [(103, 0), (107, None)]}
    values = _EDIT_VALUES | {c: _spoiled(cases, _EDIT_VALUES[c]) for c, cases in bad.items()}
    return _shaped(_activity(spark, sf_dir), EDIT_SCHEMA, values)


# --- landed files ---------------------------------------------------------------------


def land_tsv(events: DataFrame, path: str) -> str:
    events.write.option("sep", "\t").csv(path)
    return path


def land_json(edits: DataFrame, path: str) -> str:
    edits.write.json(path)
    return path


def tsv_line(df: DataFrame) -> Column:
    return F.to_csv(F.struct(*df.columns), {"sep": "\t"})


# Which records get a second payload that is no JSON object, by kind, and which have a byte
# behind their payload that is no UTF-8.
NO_JSON_EVERY = 97
SINGLE_QUOTES_EVERY = 89
TRAILING_TEXT_EVERY = 83
BAD_BYTE_EVERY = 79


def sse_lines(edits: DataFrame) -> DataFrame:
    """Transcript lines of the records, with the other kinds of line a feed has.

    White space of several kinds, or none, stands between prefix and payload.
    """
    payload, i = F.to_json(F.struct(*edits.columns)), F.col("id")
    text = i.cast("string")
    bad_byte = F.when(i % BAD_BYTE_EVERY == 0, F.unhex(F.lit("FF")).cast("string")).otherwise(F.lit(""))
    prefix = F.when(i % 3 == 0, F.lit("data:")).when(i % 3 == 1, F.lit("data: ")).otherwise(F.lit("data:\t"))
    lines = F.array(
        F.lit("event: message"),
        F.concat(F.lit('id: [{"offset":'), text, F.lit("}]")),
        F.concat(prefix, payload, bad_byte),
        F.when(i % NO_JSON_EVERY == 0, F.concat(F.lit("data: not json "), text)),
        F.when(i % SINGLE_QUOTES_EVERY == 0, F.concat(F.lit("data: {'id':"), text, F.lit("}"))),
        F.when(i % TRAILING_TEXT_EVERY == 0, F.concat(F.lit('data: {"id":'), text, F.lit("} trailing"))),
        F.lit(""),
        F.lit(":heartbeat"),
    )
    return edits.select(F.explode(F.array_compact(lines)).alias("value"))


def land_text(lines: DataFrame, path: str) -> str:
    lines.write.text(path)
    return path


EVENTS_PER_ARCHIVE = 2000
BROKEN_EVERY = 2


def archive_stem(k: Column) -> Column:
    """The delivery time that archive ``k`` is named after, counted from a fixed day."""
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    step = F.make_dt_interval(mins=(k * STEP_MINUTES).cast("int"))
    return F.date_format(first + step, NAME_PATTERN)


def _zip(members: dict[str, str]) -> bytes:
    """A ZIP whose last byte is a line end: the text writer puts that byte back."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for name, body in members.items():
            z.writestr(zipfile.ZipInfo(name), body, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"\n"
    return buffer.getvalue()[:-1]


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    stem, k = rows["stem"].iloc[0], int(rows["k"].iloc[0])
    text = "\n".join(rows.sort_values("id")["value"]) + "\n"
    files = {stem + NAME_SUFFIX: _zip({f"{stem}.export.CSV": text, "readme.txt": "no data\n"})}
    if k % BROKEN_EVERY == 0:
        files[f"{stem}.broken.zip"] = b"no archive"
    return pd.DataFrame({"content": files.values(), "name": files.keys()})


def _land_packed(events: DataFrame, pack, path: str) -> str:
    k = F.floor(F.col("Global_Event_ID") / EVENTS_PER_ARCHIVE)
    (
        events.select(
            F.col("Global_Event_ID").alias("id"),
            k.alias("k"),
            archive_stem(k).alias("stem"),
            tsv_line(events).alias("value"),
        )
        .groupBy("k")
        .applyInPandas(pack, "content binary, name string")
        .select(F.col("content").cast("string"), "name")
        .write.partitionBy("name")
        .text(path)
    )
    return path


def land_archives(events: DataFrame, path: str) -> str:
    """ZIP archives of the export, ``EVENTS_PER_ARCHIVE`` consecutive ids each.

    Ids are unique, so no archive and no task holds more than that many rows. Each archive
    also has a member to be ignored; beside some archives lies a file that is no ZIP. The
    files are written by Spark, one per ``name=`` folder, so a lost task leaves nothing
    half-written.
    """
    return _land_packed(events, _pack, path)


DAMAGED_EVERY = 2
MEMBERS = ("a", "b", "c")
_CODECS = (zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA, zipfile.ZIP_STORED)


def _pack_members(rows: pd.DataFrame) -> pd.DataFrame:
    """An archive of three members, the second of which may be damaged in its middle."""
    stem, k = rows["stem"].iloc[0], int(rows["k"].iloc[0])
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for n, name in enumerate(MEMBERS):
            lines = rows[rows["id"] % len(MEMBERS) == n].sort_values("id")["value"]
            z.writestr(zipfile.ZipInfo(f"{stem}.{name}.CSV"), "\n".join(lines) + "\n", compress_type=_CODECS[k % len(_CODECS)])
        info = z.infolist()[1]
        z.comment = b"\n"
    data = bytearray(buffer.getvalue()[:-1])
    if k % DAMAGED_EVERY == 0:
        middle = info.header_offset + 30 + len(info.filename) + info.compress_size // 2
        data[middle] ^= 0x5A
    return pd.DataFrame({"content": [bytes(data)], "name": [stem + NAME_SUFFIX]})


def land_member_archives(events: DataFrame, path: str) -> str:
    """Archives of three members each, by id; in every ``DAMAGED_EVERY``th the second is damaged."""
    return _land_packed(events, _pack_members, path)


def archive_name(path: Column) -> Column:
    """The ``name=`` folder an archive was landed in."""
    return F.regexp_extract(path, "/name=([^/]+)/", 1)
