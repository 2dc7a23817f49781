"""Edits per minute, kept up by a stateful stream.

The totals live in the state store of the query, one entry a minute, without a watermark: an
edit may come as late as it likes. A micro-batch hands on the minutes it changed, with their
new totals, and these are written to a folder of that batch. Totals only ever grow, so the
count of a minute is the largest that was written for it, and merging is idempotent: a batch
that is repeated writes the same totals again, a folder may be read half-written, twice or
beside its own summary, and no marker file tells what is complete. Every ``FOLDERS`` batches
the folders are merged into one.

Counts belong to the checkpoint that holds their state: they lie below the id of its query. A
query with another checkpoint would count from nothing again, and is refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from millrace.functions.times import epoch_to_timestamp, minute_of
from millrace.operators.cleaning import keep_value

COUNT_SCHEMA = "minute_ts timestamp, cnt bigint"
FOLDERS = 32
# Partitions of the state, at most: each is written anew by every micro-batch, and a minute is
# one short entry. What a checkpoint began with stays.
STATE_PARTITIONS = 16
_SUMMARY = "-all"


def minute_counts(edits: DataFrame) -> DataFrame:
    """minute_ts, cnt; an edit without a time counts under NULL."""
    minute = minute_of(epoch_to_timestamp(F.col("timestamp")))
    return edits.groupBy(minute.alias("minute_ts")).agg(F.count(F.lit(1)).alias("cnt"))


def _store(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    store, folder = _store(spark, path)
    if not store.exists(folder):
        return []
    names = [s.getPath().getName() for s in store.listStatus(folder)]
    return sorted(n for n in names if n[0] not in "._")


def _merged(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(COUNT_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
    return rows.groupBy("minute_ts").agg(F.max("cnt").alias("cnt"))


def _own_folder(spark: SparkSession, path: str, checkpoint: str) -> str:
    """The folder of the checkpoint's query; counts of another one are not added to."""
    query = spark.read.json(f"{checkpoint}/metadata").first()["id"]
    if others := [n for n in _names(spark, path) if n != query]:
        raise ValueError(f"{path} holds counts of another checkpoint ({others[0]}); go on with that one or clear the counts")
    return f"{path}/{query}"


def start_minute_counts(
    edits: DataFrame, path: str, checkpoint: str, wiki: str = "enwiki"
) -> StreamingQuery:
    """Count what is available now of a stream of edits (raw or silver), then stop."""

    own = None

    def put(changed: DataFrame, batch_id: int) -> None:
        nonlocal own
        spark, name = changed.sparkSession, f"{batch_id:020d}"
        own = own or _own_folder(spark, path, checkpoint)
        changed.write.mode("overwrite").parquet(f"{own}/{name}")
        older = [n for n in _names(spark, own) if n < name + _SUMMARY]
        if len(older) > FOLDERS:
            _merged(spark, own).write.mode("overwrite").parquet(f"{own}/{name}{_SUMMARY}")
            store, _ = _store(spark, own)
            for n in older:
                store.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{own}/{n}"), True)

    writer = (
        minute_counts(keep_value(edits, "wiki", wiki).select("timestamp"))
        .writeStream.foreachBatch(put)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    # A query takes its settings from the session when it starts.
    conf, key = edits.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(min(int(before), STATE_PARTITIONS)))
    try:
        return writer.start()
    finally:
        conf.set(key, before)


def read_minute_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts per minute over all micro-batches so far: minute_ts, cnt."""
    if not _names(spark, path):
        return spark.createDataFrame([], COUNT_SCHEMA)
    return _merged(spark, path).orderBy("minute_ts")
