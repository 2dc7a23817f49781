"""Fixed schemas of the two feeds and the column lists derived from them.

Raw files are never inferred: an event export is bound by position, a change-feed
record by name. Everything else the library needs to know about columns (which ones
are null-filled, which structs are flattened) is derived from the schemas below.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, BOOLEAN = T.StringType(), T.BooleanType()
INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The columns that describe the place of each of the three roles.
_PLACE_ROLES = ("Actor1", "Actor2", "Action")
_PLACE = {
    "Geo_Type": INT,
    "Geo_FullName": STRING,
    "Geo_Country_Code": STRING,
    "Geo_ADM1_Code": STRING,
    "Geo_Geonames_ID": STRING,
    "Geo_Lat": DOUBLE,
    "Geo_Long": DOUBLE,
    "Geo_Feature_ID": LONG,
}

# Column names, order and types of the event export.
EVENT_SCHEMA = _struct(
    {
        "Global_Event_ID": LONG,
        "SQL_Date": INT,
        "Month_Year": INT,
        "Year": INT,
        "Fraction_Date": DOUBLE,
        "Actor1_Code": STRING,
        "Actor1_Name": STRING,
        "Actor1_Country_Code": STRING,
        "Actor1_Known_Group_Code": STRING,
        "Actor1_Ethnic_Code": STRING,
        "Actor1_Religion1_Code": STRING,
        "Actor1_Religion2_Code": STRING,
        "Actor1_Religion3_Code": STRING,
        "Actor1_Type1_Code": STRING,
        "Actor1_Type2_Code": STRING,
        "Actor1_Type3_Code": STRING,
        "Actor2_Code": STRING,
        "Actor2_Name": STRING,
        "Actor2_Known_Group_Code": STRING,
        "Actor2_Ethnic_Code": STRING,
        "Actor2_Religion1_Code": STRING,
        "Actor2_Religion2_Code": STRING,
        "Actor2_Religion3_Code": STRING,
        "Actor2_Type1_Code": STRING,
        "Actor2_Type2_Code": STRING,
        "Is_Root_Event": INT,
        "Event_Code": STRING,
        "Event_Base_Code": STRING,
        "Event_Root_Code": STRING,
        "Quad_Class": INT,
        "Goldstein_Scale": DOUBLE,
        "Num_Mentions": INT,
        "Num_Sources": INT,
        "Num_Articles": INT,
        "Avg_Tone": DOUBLE,
    }
    | {f"{role}_{name}": kind for role in _PLACE_ROLES for name, kind in _PLACE.items()}
    | {
        "Date_Added": LONG,
        "Source_URL": STRING,
    }
)

# Members and types of the nested objects of a change record.
_PAIR = _struct({
    "new": LONG,
    "old": LONG,
})
_META = _struct({
    "domain": STRING,
    "dt": STRING,
    "id": STRING,
    "offset": LONG,
    "partition": LONG,
    "request_id": STRING,
    "stream": STRING,
    "topic": STRING,
    "uri": STRING,
})

# Fields of a change record, in order.
EDIT_SCHEMA = _struct({
    "$schema": STRING,
    "bot": BOOLEAN,
    "comment": STRING,
    "id": LONG,
    "length": _PAIR,
    "log_action": STRING,
    "log_action_comment": STRING,
    "log_id": LONG,
    "log_params": STRING,
    "log_type": STRING,
    "meta": _META,
    "minor": BOOLEAN,
    "namespace": LONG,
    "notify_url": STRING,
    "parsedcomment": STRING,
    "patrolled": BOOLEAN,
    "revision": _PAIR,
    "server_name": STRING,
    "server_script_path": STRING,
    "server_url": STRING,
    "timestamp": LONG,
    "title": STRING,
    "title_url": STRING,
    "type": STRING,
    "user": STRING,
    "wiki": STRING,
})

CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"
UNKNOWN = "Unknown"

# Event columns that never carry data and are dropped when cleaning.
EVENT_DROPPED = ("Actor1_Type2_Code", "Actor2_Type2_Code")

EVENT_FILLED = tuple(
    f.name
    for f in EVENT_SCHEMA
    if isinstance(f.dataType, T.StringType) and f.name not in EVENT_DROPPED
)

# The struct members kept when a change record is flattened, by output
# column. ``meta.id`` has no output column and ``meta.request_id`` is renamed.
EDIT_FLATTENED = {
    "length_new": "length.new",
    "length_old": "length.old",
    "revision_new": "revision.new",
    "revision_old": "revision.old",
    "meta_domain": "meta.domain",
    "meta_dt": "meta.dt",
    "meta_offset": "meta.offset",
    "meta_partition": "meta.partition",
    "meta_request": "meta.request_id",
    "meta_stream": "meta.stream",
    "meta_topic": "meta.topic",
    "meta_uri": "meta.uri",
}
EDIT_STRUCTS = tuple(f.name for f in EDIT_SCHEMA if isinstance(f.dataType, T.StructType))


def _edit_filled() -> tuple[str, ...]:
    # ``$schema`` is the one string column that keeps its NULLs.
    top = [
        f.name
        for f in EDIT_SCHEMA
        if isinstance(f.dataType, T.StringType) and f.name != "$schema"
    ]
    flat = []
    for out, path in EDIT_FLATTENED.items():
        struct, member = path.split(".")
        if isinstance(EDIT_SCHEMA[struct].dataType[member].dataType, T.StringType):
            flat.append(out)
    return tuple(top + flat)


EDIT_FILLED = _edit_filled()


def with_corrupt(schema: T.StructType) -> T.StructType:
    """``schema`` plus the text column that receives rows which do not fit it."""
    return T.StructType(list(schema) + [T.StructField(CORRUPT, T.StringType(), True)])


def with_rescued(schema: T.StructType) -> T.StructType:
    """``schema`` plus the text column for fields that found no place in it."""
    return T.StructType(list(schema) + [T.StructField(RESCUED, T.StringType(), True)])


# What a feed run could not read, and why.
UNREADABLE_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in ("source", "member", "text", "error")])
# The column that holds it beside the rows that could be read.
UNREADABLE = "_unreadable"


def with_unreadable(schema: T.StructType) -> T.StructType:
    """``schema`` plus the column for what could not be read."""
    return T.StructType(list(schema) + [T.StructField(UNREADABLE, UNREADABLE_SCHEMA, True)])
