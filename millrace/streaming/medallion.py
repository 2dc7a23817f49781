"""Raw files to bronze to silver, as triggered streams with checkpoints.

Every step is a file-source stream into a parquet table. A run takes up what arrived since
the last one and stops. The checkpoint makes each step exactly-once: a run killed half-way
is finished by the next one, and a second run without new files adds nothing. No step
shuffles; each output task writes what its input task read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from millrace.operators.cleaning import clean_edits, clean_events
from millrace.operators.quality import (
    EDIT_RULES,
    EVENT_RULES,
    EVENT_WARNINGS,
    Rules,
    gate,
    observed,
    reject,
    rule_metrics,
)
from millrace.schemas import (
    EDIT_SCHEMA,
    EVENT_SCHEMA,
    UNREADABLE,
    UNREADABLE_SCHEMA,
    with_corrupt,
    with_rescued,
    with_unreadable,
)
from millrace.sources.archives import read_archives_once
from millrace.sources.readers import read_edits, read_events, read_table
from millrace.sources.sinks import publish_table
from millrace.sources.sse import read_sse_once
from millrace.streaming.metrics import BatchMetrics, observed_rule_counts, read_batch_metrics

# The partition column of a bronze table that also holds what could not be read.
READABLE = "readable"


@dataclass(frozen=True)
class Feed:
    """How one feed is read, cleaned and judged; ``warnings`` are counted, but gate nothing.

    Where not every row of the landing format can be read (``faults``), ``read`` also gives
    those, in the column ``_unreadable``; both kinds go into one bronze table by one pass over
    the files, laid out apart. Readers of bronze see the rows that could be read.
    """

    name: str
    schema: T.StructType
    read: Callable[..., DataFrame]
    clean: Callable[[DataFrame], DataFrame]
    rules: Rules
    faults: bool = False
    warnings: Rules = field(default_factory=dict)
    bronze_comment: str = "raw records"
    silver_comment: str = "cleaned records that pass every rule"

    def silver_schema(self, spark: SparkSession) -> T.StructType:
        return self.clean(spark.createDataFrame([], self.schema)).schema


EVENTS = Feed("events", EVENT_SCHEMA, read_events, clean_events, EVENT_RULES, warnings=EVENT_WARNINGS)
EDITS = Feed("edits", EDIT_SCHEMA, read_edits, clean_edits, EDIT_RULES)

# The same feeds from other landing formats, and with the leftovers kept in bronze.
ARCHIVED_EVENTS = replace(EVENTS, read=read_archives_once, faults=True)
EVENTS_WITH_CORRUPT = replace(
    EVENTS, schema=with_corrupt(EVENT_SCHEMA), read=partial(read_events, corrupt=True)
)
TRANSCRIBED_EDITS = replace(EDITS, read=read_sse_once, faults=True)
EDITS_WITH_RESCUED = replace(
    EDITS, schema=with_rescued(EDIT_SCHEMA), read=partial(read_edits, rescue=True)
)


@dataclass(frozen=True)
class FeedTables:
    """Where the tables of one feed live below an output folder, and how to read them.

    A table can be read once a run has made its folder, even if that run had no rows.
    """

    root: str
    feed: Feed
    table_format: str = "parquet"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/{self.feed.name}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/{self.feed.name}"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine/{self.feed.name}"

    @property
    def bronze_schema(self) -> T.StructType:
        """What the bronze table holds, also what its readers are not shown."""
        if not self.feed.faults:
            return self.feed.schema
        return with_unreadable(self.feed.schema).add(READABLE, T.BooleanType())

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    def read_metrics(self, spark: SparkSession) -> DataFrame:
        """Failures per rule over the micro-batches that were observed: rule, failed."""
        return observed_rule_counts(read_batch_metrics(spark, self.metrics), self.feed.name)

    def checkpoint(self, step: str) -> str:
        return f"{self.root}/_checkpoints/{self.feed.name}/{step}"

    def _read(self, spark: SparkSession, path: str, schema: T.StructType, **kw) -> DataFrame:
        return read_table(spark, path, schema=schema, table_format=self.table_format, **kw)

    def read_bronze(self, spark: SparkSession, **kw) -> DataFrame:
        rows = self._read(spark, self.bronze, self.bronze_schema, **kw)
        return rows.filter(READABLE).select(*[F.col(f"`{n}`") for n in self.feed.schema.names]) if self.feed.faults else rows

    def read_silver(self, spark: SparkSession, **kw) -> DataFrame:
        return self._read(spark, self.silver, self.feed.silver_schema(spark), **kw)

    def read_unreadable(self, spark: SparkSession, **kw) -> DataFrame:
        """What the runs so far could not read: source, member, text, error."""
        if not self.feed.faults:
            return spark.createDataFrame([], UNREADABLE_SCHEMA)
        rows = self._read(spark, self.bronze, self.bronze_schema, **kw)
        return rows.filter(~F.col(READABLE)).select(f"{UNREADABLE}.*")

    def read_quarantine(self, spark: SparkSession, **kw) -> DataFrame:
        """Rejected rows with ``failed_rules``; raw columns if the gate came first."""
        return read_table(spark, self.quarantine, table_format=self.table_format, **kw)


@dataclass(frozen=True)
class RunOptions:
    """Settings of a run.

    ``source`` limits a micro-batch (``maxBytesPerTrigger`` or ``maxFilesPerTrigger``, not
    both), so that a backlog is worked off in pieces and a failure repeats one piece only.
    ``partition_silver_by`` lays silver out for pruning, for example by the event date.
    ``quarantine`` stores rejected rows, at the price of a second scan of bronze.
    ``observe`` reports failure counts in the query progress and keeps them by micro-batch
    (``FeedTables.read_metrics``); it separates cleaning and gate, so the gate no longer
    reaches the scan. The counts can also be had afterwards from bronze, which reads the
    judged columns only (``rule_counts``).
    ``gate_before_cleaning`` judges raw values, when missing text is not yet ``Unknown``.
    """

    table_format: str = "parquet"
    source: Mapping[str, str] = field(default_factory=lambda: {"maxBytesPerTrigger": str(1 << 40)})
    partition_silver_by: Sequence[str] = ()
    quarantine: bool = False
    observe: bool = False
    gate_before_cleaning: bool = False


def start_append(
    df: DataFrame,
    path: str,
    checkpoint: str,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
    query_name: str | None = None,
) -> StreamingQuery:
    """Append what is available now to a table, then stop."""
    writer = (
        df.writeStream.format(table_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start(path)


def _bronze(spark: SparkSession, raw_dir: str, tables: FeedTables, o: RunOptions) -> list[StreamingQuery]:
    """Bronze, in one pass over what arrived."""
    raw, by = tables.feed.read(spark, raw_dir, stream=True, options=dict(o.source)), ()
    if tables.feed.faults:
        raw, by = raw.withColumn(READABLE, F.col(UNREADABLE).isNull()), (READABLE,)
    return [start_append(raw, tables.bronze, tables.checkpoint("bronze"), o.table_format, by)]


def judged(raw: DataFrame, feed: Feed, before_cleaning: bool, observe: bool = False):
    """The rows of ``raw`` that reach silver, and those set aside."""
    shown = raw if before_cleaning else feed.clean(raw)
    watched = observed(shown, {**feed.rules, **({} if before_cleaning else feed.warnings)}, feed.name) if observe else shown
    kept = gate(watched, feed.rules)
    return (feed.clean(kept) if before_cleaning else kept), reject(shown, feed.rules)


def _silver(spark: SparkSession, tables: FeedTables, o: RunOptions):
    bronze = tables.read_bronze(spark, stream=True, options=dict(o.source))
    kept, dropped = judged(bronze, tables.feed, o.gate_before_cleaning, o.observe)
    running = [
        start_append(
            kept, tables.silver, tables.checkpoint("silver"), o.table_format, o.partition_silver_by
        )
    ]
    if o.quarantine:
        running.append(
            start_append(
                dropped, tables.quarantine, tables.checkpoint("quarantine"), o.table_format
            )
        )
    return running


_POLL_SECONDS = 0.1


def _run(chains: Sequence[Sequence[Callable[[], list[StreamingQuery]]]], metrics: BatchMetrics | None = None) -> None:
    """The steps of each chain one after the other, the chains side by side.

    If a query fails, all others are stopped; what they committed stays committed.
    """
    started: list[StreamingQuery] = []
    waiting = [list(steps) for steps in chains]
    running: list[list[StreamingQuery]] = [[] for _ in chains]
    try:
        while any(waiting) or any(running):
            for i, queries in enumerate(running):
                for query in queries:
                    if not query.isActive and query.exception() is not None:
                        raise query.exception()
                running[i] = [q for q in queries if q.isActive]
                if not running[i] and waiting[i]:
                    running[i] = waiting[i].pop(0)()
                    started += running[i]
            for query in [q for queries in running for q in queries][:1]:
                query.awaitTermination(_POLL_SECONDS)
    finally:
        for query in (q for queries in running for q in queries):
            query.stop()
        if metrics is not None:
            for query in started:
                metrics.settle(query)


def run_feeds(
    spark: SparkSession,
    inputs: Sequence[tuple[Feed, str]],
    out_dir: str,
    options: RunOptions = RunOptions(),
) -> dict[str, FeedTables]:
    """One triggered run over (feed, raw folder) pairs; the feeds run side by side.

    Feeds of one name would share tables and checkpoints, so a name may occur only once.
    """
    names = [feed.name for feed, _ in inputs]
    if len(set(names)) < len(names):
        raise ValueError(f"feeds of one name in one run: {sorted(n for n in set(names) if names.count(n) > 1)}")
    tables = {feed.name: FeedTables(out_dir, feed, options.table_format) for feed, _ in inputs}
    chains = [
        [partial(_bronze, spark, raw, tables[feed.name], options), partial(_silver, spark, tables[feed.name], options)]
        for feed, raw in inputs
    ]
    if not options.observe:
        _run(chains)
        return tables
    metrics = BatchMetrics(spark, f"{out_dir}/metrics")
    spark.streams.addListener(metrics)
    try:
        _run(chains, metrics)
    finally:
        spark.streams.removeListener(metrics)
    return tables


def rule_counts(spark: SparkSession, tables: FeedTables) -> DataFrame:
    """Failures per rule over everything that ever reached bronze: rule, failed."""
    feed = tables.feed
    return rule_metrics(feed.clean(tables.read_bronze(spark)), feed.rules)


def publish(spark: SparkSession, tables: FeedTables, database: str = "default") -> dict[str, str]:
    """Register bronze and silver as named, commented tables; returns their names.

    Call it after each run: a table that exists is made to see the files of the run.
    """
    feed, names = tables.feed, {}
    for layer, path, schema, comment in (
        ("bronze", tables.bronze, tables.bronze_schema, feed.bronze_comment),
        ("silver", tables.silver, feed.silver_schema(spark), feed.silver_comment),
    ):
        name = f"{database}.{feed.name}_{layer}"
        if spark.catalog.tableExists(name):
            spark.catalog.refreshTable(name)
        else:
            publish_table(spark, name, path, schema, comment, tables.table_format)
        names[layer] = name
    return names
