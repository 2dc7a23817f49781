"""Rule counts of a running stream, kept durably.

A listener takes the counts that a query observes from the progress of each micro-batch and
writes them to a small file named after the query and the batch. A batch that is repeated
replaces its own file, so it counts once; a restarted query goes on under the same id. What a
driver had no time to note before it was lost can be had from bronze (``rule_counts``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

METRICS_SCHEMA = "query string, batch bigint, observation string, metric string, value bigint"
ROWS_IN = "rows_in"


class BatchMetrics(StreamingQueryListener):
    """Notes the observed counts of all queries of a session below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._store = hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._store.mkdirs(hadoop.Path(self.path))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.note(event.progress)

    def note(self, progress) -> None:
        """Write the counts of one micro-batch, once it is complete."""
        query, batch = str(progress.id), progress.batchId
        rows = [
            {"query": query, "batch": batch, "observation": name, "metric": metric, "value": value}
            for name, counts in (progress.observedMetrics or {}).items()
            for metric, value in counts.asDict().items()
            if value is not None
        ]
        if not rows:
            return
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        # Written aside and renamed: a reader never sees half a file.
        aside, name = path(f"{self.path}/.{query}-{batch}"), path(f"{self.path}/{query}-{batch:020d}.json")
        out = self._store.create(aside, True)
        out.write(bytearray("\n".join(map(json.dumps, rows)).encode()))
        out.close()
        self._store.delete(name, False)
        self._store.rename(aside, name)

    def settle(self, query: StreamingQuery) -> None:
        """Note what the listener may not have been told yet of a query that has ended."""
        for progress in query.recentProgress:
            self.note(progress)


def read_batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Counts per query, micro-batch and metric."""
    return spark.read.schema(METRICS_SCHEMA).json(path)


def observed_rule_counts(metrics: DataFrame, observation: str) -> DataFrame:
    """Failures per rule over all micro-batches noted: rule, failed."""
    rows = metrics.filter((F.col("observation") == observation) & (F.col("metric") != ROWS_IN))
    return rows.groupBy(F.col("metric").alias("rule")).agg(F.sum("value").alias("failed"))
