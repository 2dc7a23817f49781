"""Writers of landed files and named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery


def write_json_batches(
    df: DataFrame, path: str, batch_size: int = 100, mode: str = "append"
) -> None:
    """JSON-lines files of at most ``batch_size`` rows each; every row is written."""
    df.write.mode(mode).option("maxRecordsPerFile", batch_size).json(path)


def write_payload_batches(
    payloads: DataFrame, path: str, batch_size: int = 100, mode: str = "append"
) -> None:
    """The same for one column of JSON text, which is stored as it came."""
    payloads.write.mode(mode).option("maxRecordsPerFile", batch_size).text(path)


def start_payload_batches(
    payloads: DataFrame, path: str, checkpoint: str, batch_size: int = 100
) -> StreamingQuery:
    """Land what is available of a stream of JSON text in files of ``batch_size``, then stop."""
    return (
        payloads.writeStream.format("text")
        .option("maxRecordsPerFile", batch_size)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def write_members(lines: DataFrame, path: str) -> None:
    """Store raw member lines under the name of their member.

    Members present in ``lines`` replace what was stored for them, all others stay. The
    lines of one archive are in one task already, so nothing is shuffled.
    """
    (
        lines.select("value", "member")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("member")
        .text(path)
    )


def publish_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    comment: str,
    table_format: str = "parquet",
) -> DataFrame:
    """Register written files as a named, commented catalog table."""
    spark.catalog.createTable(name, path=path, source=table_format, schema=schema, description=comment)
    return spark.table(name)
