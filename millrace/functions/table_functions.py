"""Table functions over transcript lines, for use in SQL.

They take a table of lines and work on whole Arrow batches:

    SELECT e.id, e.title FROM parse_sse(TABLE(SELECT value FROM lines)) e

SQL that stays in the JVM is possible too, at the price of writing the schema out:

    SELECT inline(array(from_json(data, '...'))) FROM ...

and for whole feeds there is ``sources.sse.parse_sse``. All accept and refuse the same text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udtf
from pyspark.sql.pandas.types import to_arrow_schema

from millrace.schemas import EDIT_SCHEMA

_PREFIX = b"data:"


def _payload(line: bytes | None) -> str | None:
    """Text behind the prefix, without bytes that are no UTF-8."""
    if line is None or not line.startswith(_PREFIX):
        return None
    return line[len(_PREFIX) :].decode("utf-8", "ignore").strip()


def _fit(value, kind: T.DataType):
    """``value`` if it has the declared type, else NULL; objects in text fields stay JSON."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        if not isinstance(value, dict):
            return None
        return {f.name: _fit(value.get(f.name), f.dataType) for f in kind}
    if isinstance(kind, T.StringType) and not isinstance(value, str):
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    if isinstance(value, bool) != isinstance(kind, T.BooleanType):
        return None
    if isinstance(kind, T.LongType) and not (isinstance(value, int) and -(2**63) <= value < 2**63):
        return None
    return value


def _payloads(batch: pa.RecordBatch) -> list[str]:
    texts = map(_payload, batch.column(0).cast(pa.binary()).to_pylist())
    return [t for t in texts if t is not None]


def _record(text: str) -> dict | None:
    """The fields of the text if it is one JSON object."""
    try:
        record = json.loads(text)
    except ValueError:
        return None
    return _fit(record, EDIT_SCHEMA) if isinstance(record, dict) else None


class ParseSse:
    """One row of change-record fields per readable ``data:`` line of the table."""

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        records = [r for r in map(_record, _payloads(batch)) if r is not None]
        yield pa.Table.from_pylist(records, schema=to_arrow_schema(EDIT_SCHEMA))


class SseData:
    """One row with the raw JSON text per ``data:`` line of the table."""

    def eval(self, batch: pa.RecordBatch) -> Iterator[pa.Table]:
        yield pa.table({"data": pa.array(_payloads(batch), pa.string())})


parse_sse_rows = arrow_udtf(ParseSse, returnType=EDIT_SCHEMA)
sse_data_rows = arrow_udtf(SseData, returnType="data string")


def register_table_functions(spark: SparkSession) -> None:
    """Make ``parse_sse(TABLE(...))`` and ``sse_data(TABLE(...))`` available to SQL."""
    spark.udtf.register("parse_sse", parse_sse_rows)
    spark.udtf.register("sse_data", sse_data_rows)
