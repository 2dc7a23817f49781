"""Small helpers around Arrow batches and written intermediate results."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.storage import shared_root

# Text a worker turns into results at a time; bounds its memory whatever the batch size.
SLICE_BYTES = 8 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that ``column`` (text or bytes) holds about ``SLICE_BYTES`` in each.

    A single value above that size is a slice of its own.
    """
    for batch in batches:
        start, held = 0, 0
        for i, value in enumerate(batch.column(column)):
            size = len(value.as_buffer()) if value.is_valid else 0
            if i > start and held + size > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns appended."""
    return pa.RecordBatch.from_arrays(
        batch.columns + list(columns.values()), names=batch.schema.names + list(columns)
    )


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, with underscores before it as long as a column has that name."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def durable(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder at once, so that lost executors cost no history.

    The folder is that of ``spark.checkpoint.dir``; only a session without it gets one.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_root(df.sparkSession)}/checkpoints")
    return df.checkpoint()
