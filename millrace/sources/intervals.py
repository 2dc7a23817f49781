"""The delivery calendar: which export files should exist and which are missing."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Delivery step, time pattern and name suffix of an export archive.
STEP_MINUTES = 15
NAME_PATTERN = "yyyyMMddHHmmss"
NAME_SUFFIX = ".export.CSV.zip"
_PY_PATTERN = "%Y%m%d%H%M%S"
_STAMP_IN_NAME = r"(?<![0-9])([0-9]{14})\.export\.CSV\.zip(?![^/])"
_STAMP_PARTS = r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)"


def _named(slots: DataFrame) -> DataFrame:
    stamp = F.date_format("slot", NAME_PATTERN)
    return slots.select("slot", stamp.alias("stamp"), F.concat(stamp, F.lit(NAME_SUFFIX)).alias("file_name"))


def manifest(spark: SparkSession, start: str, end: str, minutes: int = STEP_MINUTES) -> DataFrame:
    """Every expected delivery from ``start`` to ``end`` (``yyyyMMddHHmmss``, both included).

    Columns: slot, stamp, file_name. Rows are generated on the executors.
    """
    first = datetime.strptime(start, _PY_PATTERN)
    last = datetime.strptime(end, _PY_PATTERN)
    n = max((last - first) // timedelta(minutes=minutes) + 1, 0)
    origin = F.lit(first.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    step = F.make_dt_interval(mins=(F.col("id") * minutes).cast("int"))
    return _named(spark.range(n).select((origin + step).alias("slot")))


def manifest_between(bounds: DataFrame, minutes: int = STEP_MINUTES) -> DataFrame:
    """The same calendar for ``start`` and ``end`` columns of timestamps without zone.

    One row of bounds gives one array of slots; its size depends on the time span only.
    """
    step = F.expr(f"INTERVAL {int(minutes)} MINUTES")
    return _named(bounds.select(F.explode(F.sequence("start", "end", step)).alias("slot")))


def slot_of(ts: Column, minutes: int = STEP_MINUTES) -> Column:
    """The delivery slot that a timestamp without zone falls into."""
    midnight = F.date_trunc("day", ts).cast("timestamp_ntz")
    index = F.floor((F.hour(ts) * 60 + F.minute(ts)) / F.lit(minutes)).cast("int")
    return midnight + F.make_dt_interval(mins=index * minutes)


def _landed(spark: SparkSession, path: str, options: dict | None) -> DataFrame:
    files = spark.read.format("binaryFile").options(**(options or {})).load(path)
    stamp = F.regexp_extract("path", _STAMP_IN_NAME, 1)
    readable = F.regexp_replace(stamp, _STAMP_PARTS, "$1-$2-$3 $4:$5:$6")
    return files.select(readable.try_cast("timestamp_ntz").alias("slot"), F.col("path").alias("archive"))


def landed_deliveries(spark: SparkSession, path: str, options: dict | None = None) -> DataFrame:
    """Archives present in a landing folder: slot, archive. Contents are not read.

    The slot comes from the delivery time in the name; ``misnamed_files`` has the rest.
    """
    return _landed(spark, path, options).filter(F.col("slot").isNotNull())


def misnamed_files(spark: SparkSession, path: str, options: dict | None = None) -> DataFrame:
    """Files of a landing folder whose name holds no delivery time: archive."""
    return _landed(spark, path, options).filter(F.col("slot").isNull()).select("archive")


def gaps(expected: DataFrame, landed: DataFrame, key: str = "slot") -> DataFrame:
    """Expected deliveries that did not arrive.

    ``landed`` may hold any number of rows per key: it is reduced to its keys, map side
    first, before the join, so that a key with very many rows costs nothing extra.
    """
    return expected.join(landed.select(key).distinct(), key, "left_anti")
