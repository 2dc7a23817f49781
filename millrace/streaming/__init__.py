from millrace.streaming.medallion import (
    ARCHIVED_EVENTS,
    EDITS,
    EDITS_WITH_RESCUED,
    EVENTS,
    EVENTS_WITH_CORRUPT,
    TRANSCRIBED_EDITS,
    Feed,
    FeedTables,
    RunOptions,
    judged,
    publish,
    rule_counts,
    run_feeds,
    start_append,
)
from millrace.streaming.metrics import BatchMetrics, observed_rule_counts, read_batch_metrics
from millrace.streaming.minutes import read_minute_counts, start_minute_counts
from millrace.streaming.named import create_table, run_named_feeds, start_into

__all__ = [
    "ARCHIVED_EVENTS",
    "EDITS",
    "EDITS_WITH_RESCUED",
    "EVENTS",
    "EVENTS_WITH_CORRUPT",
    "TRANSCRIBED_EDITS",
    "BatchMetrics",
    "Feed",
    "FeedTables",
    "RunOptions",
    "create_table",
    "judged",
    "observed_rule_counts",
    "publish",
    "read_batch_metrics",
    "read_minute_counts",
    "rule_counts",
    "run_feeds",
    "run_named_feeds",
    "start_append",
    "start_into",
    "start_minute_counts",
]
