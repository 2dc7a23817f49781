"""Feeds as chains of named tables: files to bronze to silver, each by its catalog name.

The tables are created with their comments and schemas before the first row, in the format of
the session's catalog; streams write into them and read from them by name, so nothing but the
raw folder and the checkpoints is a path. What a run has committed is what any reader of the
name sees: a streamed table lists the files of its own log, so no refresh is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from millrace.schemas import UNREADABLE, with_unreadable
from millrace.streaming.medallion import READABLE, Feed, RunOptions, _run, judged


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    comment: str,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """An empty table with a comment, unless there is one of that name."""
    columns = spark._jsparkSession.parseDataType(schema.json()).toDDL()
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {table_format}{parts} COMMENT '{text}'")


def start_into(
    df: DataFrame, name: str, checkpoint: str, table_format: str = "parquet", partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append what is available now to a named table, then stop."""
    writer = df.writeStream.format(table_format).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).toTable(name)


def names_of(feed: Feed, database: str) -> dict[str, str]:
    return {layer: f"{database}.{feed.name}_{layer}" for layer in ("bronze", "silver", "quarantine")}


def bronze_rows(feed: Feed, bronze: DataFrame) -> DataFrame:
    """The rows of a named bronze table that could be read."""
    return bronze.filter(READABLE).select(*[f"`{n}`" for n in feed.schema.names]) if feed.faults else bronze


def run_named_feeds(
    spark: SparkSession,
    inputs: Sequence[tuple[Feed, str]],
    database: str,
    checkpoints: str,
    options: RunOptions = RunOptions(),
) -> dict[str, dict[str, str]]:
    """One triggered run over (feed, raw folder) pairs; returns the table names by feed and layer."""
    kind, out = options.table_format, {}

    def bronze(feed: Feed, raw: str, names: dict[str, str]):
        rows, by = feed.read(spark, raw, stream=True, options=dict(options.source)), ()
        schema = feed.schema
        if feed.faults:
            rows, by = rows.withColumn(READABLE, F.col(UNREADABLE).isNull()), (READABLE,)
            schema = with_unreadable(schema).add(READABLE, T.BooleanType())
        create_table(spark, names["bronze"], schema, feed.bronze_comment, kind, by)
        return [start_into(rows, names["bronze"], f"{checkpoints}/{feed.name}/bronze", kind, by)]

    def silver(feed: Feed, names: dict[str, str]):
        stream = spark.readStream.options(**dict(options.source)).table(names["bronze"])
        kept, dropped = judged(bronze_rows(feed, stream), feed, options.gate_before_cleaning, options.observe)
        by = tuple(options.partition_silver_by)
        create_table(spark, names["silver"], feed.silver_schema(spark), feed.silver_comment, kind, by)
        running = [start_into(kept, names["silver"], f"{checkpoints}/{feed.name}/silver", kind, by)]
        if options.quarantine:
            create_table(spark, names["quarantine"], dropped.schema, "records that fail a rule", kind)
            running.append(start_into(dropped, names["quarantine"], f"{checkpoints}/{feed.name}/quarantine", kind))
        return running

    chains = []
    for feed, raw in inputs:
        names = out[feed.name] = names_of(feed, database)
        if not options.quarantine:
            del names["quarantine"]
        chains.append([lambda f=feed, r=raw, n=names: bronze(f, r, n), lambda f=feed, n=names: silver(f, n)])
    if len(out) < len(inputs):
        raise ValueError("feeds of one name in one run")
    _run(chains)
    return out
