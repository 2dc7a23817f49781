"""Server-sent-event transcripts: text lines, of which only ``data:`` lines matter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import drop_bad_utf8
from millrace.schemas import CORRUPT, EDIT_SCHEMA, UNREADABLE, UNREADABLE_SCHEMA
from millrace.sources.readers import parse_json, stripped

# Fixed value: the prefix of a payload line.
DATA_PREFIX = "data:"


def read_lines(
    spark: SparkSession, path: str, *, stream: bool = False, options: dict | None = None
) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).options(**(options or {}))
    return reader.text(path)


def sse_payloads(lines: DataFrame, column: str = "value") -> DataFrame:
    """The JSON text of each payload line, one column ``data``.

    Blank lines, heartbeats, ``event:`` and ``id:`` lines are left out; the prefix goes with
    any white space around the payload, and bytes that are no UTF-8 are dropped.
    """
    return lines.filter(F.startswith(F.col(column), F.lit(DATA_PREFIX))).select(_payload(column).alias("data"))


def _payload(column: str):
    text = drop_bad_utf8(F.col(column))
    return stripped(F.substr(text, F.lit(len(DATA_PREFIX) + 1)))


def parse_sse(
    lines: DataFrame, column: str = "value", schema: T.StructType = EDIT_SCHEMA
) -> DataFrame:
    """Change records of a transcript plus ``_corrupt_record`` for unreadable payloads."""
    return parse_json(sse_payloads(lines, column), "data", corrupt=True, schema=schema)


def read_sse(
    spark: SparkSession,
    path: str,
    *,
    stream: bool = False,
    schema: T.StructType = EDIT_SCHEMA,
    options: dict | None = None,
) -> DataFrame:
    """The readable change records of landed transcripts; ``read_unreadable_payloads`` has the rest."""
    return readable(parse_sse(read_lines(spark, path, stream=stream, options=options), schema=schema))


def read_unreadable_payloads(
    spark: SparkSession, path: str, *, stream: bool = False, options: dict | None = None
) -> DataFrame:
    """Payloads of landed transcripts that are no JSON object: source, member (NULL), text, error."""
    lines = read_lines(spark, path, stream=stream, options=options)
    lines = lines.filter(F.startswith(F.col("value"), F.lit(DATA_PREFIX))).select(
        F.col("_metadata.file_path").alias("source"), _payload("value").alias("data")
    )
    bad = parse_json(lines, "data", corrupt=True).filter(F.col(CORRUPT).isNotNull())
    return bad.select(
        "source",
        F.lit(None).cast("string").alias("member"),
        F.col(CORRUPT).alias("text"),
        F.lit("no JSON object").alias("error"),
    ).select(*UNREADABLE_SCHEMA.names)


def read_sse_once(
    spark: SparkSession, path: str, *, stream: bool = False, options: dict | None = None
) -> DataFrame:
    """The change records of landed transcripts and, with ``_unreadable`` set, the payloads that are
    no JSON object: each line is parsed once."""
    lines = read_lines(spark, path, stream=stream, options=options)
    lines = lines.filter(F.startswith(F.col("value"), F.lit(DATA_PREFIX))).select(
        F.col("_metadata.file_path").alias("_source"), _payload("value").alias("data")
    )
    parsed = parse_json(lines, "data", corrupt=True)
    fault = F.struct(
        F.col("_source").alias("source"),
        F.lit(None).cast("string").alias("member"),
        F.col(CORRUPT).alias("text"),
        F.lit("no JSON object").alias("error"),
    )
    return parsed.select(*EDIT_SCHEMA.names, F.when(F.col(CORRUPT).isNotNull(), fault).alias(UNREADABLE))


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def unreadable(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
