"""A bounded, repeatable slice of a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_events(df: DataFrame, key: str, batch_size: int, max_batches: int = 1) -> DataFrame:
    """The first ``batch_size * max_batches`` rows by a unique key.

    Ordered, so that a repeated or retried run gives the same rows. Only keys, at most n
    per input task, are merged in one place to find the greatest key that still belongs;
    the rows are then taken by a filter the scan can use to skip what lies above it.
    """
    n = batch_size * max_batches
    bound = df.select(key).orderBy(key).limit(n).agg(F.max(key)).scalar()
    return df.filter(F.col(key) <= bound).orderBy(key).limit(n)
