"""Raw to cleaned records. Row-wise only, so batch and stream share the code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import epoch_to_timestamp, yyyymmdd_to_date
from millrace.schemas import (
    CORRUPT,
    EDIT_FILLED,
    EDIT_FLATTENED,
    EDIT_STRUCTS,
    EVENT_DROPPED,
    EVENT_FILLED,
    RESCUED,
    UNKNOWN,
)


def fill_unknown(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NULL becomes ``Unknown`` in the given string columns; empty strings stay."""
    return df.fillna(UNKNOWN, subset=list(columns))


def keep_value(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def flatten(df: DataFrame, members: Mapping[str, str]) -> DataFrame:
    """Copy struct members to top-level columns, in one projection."""
    return df.withColumns({out: F.col(path) for out, path in members.items()})


def clean_events(raw: DataFrame) -> DataFrame:
    """Drop empty columns, fill missing text, add the event date."""
    df = raw.drop(*EVENT_DROPPED, CORRUPT, RESCUED)
    df = fill_unknown(df, EVENT_FILLED)
    return df.withColumn("event_timestamp", yyyymmdd_to_date(F.col("SQL_Date")))


def clean_edits(raw: DataFrame, wiki: str | None = "enwiki") -> DataFrame:
    """Keep one wiki (``None``: all), flatten, fill missing text, add the timestamp."""
    df = raw.drop(CORRUPT, RESCUED)
    if wiki is not None:
        df = keep_value(df, "wiki", wiki)
    df = flatten(df, EDIT_FLATTENED).drop(*EDIT_STRUCTS)
    df = fill_unknown(df, EDIT_FILLED)
    return df.withColumn("event_timestamp", epoch_to_timestamp(F.col("timestamp")))
