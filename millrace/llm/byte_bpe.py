"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

Each match of the split pattern is encoded by itself and no special token is known, so
``encode`` gives what ``tiktoken.Encoding(...).encode_ordinary`` gives for the whole text.
The library's pattern engine recurses on very long runs of white space, so long texts are
first cut at places where no match can reach across; a stretch without such a place is
split by an iterative engine and its matches are encoded one by one.

Defined results: NULL and empty text have no ids and decode to no bytes; repeated rows are
encoded independently; an empty table gives an empty table; other columns are kept, and
one whose name clashes with a result column is replaced.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.rows import slices, unused, with_columns

# Longest text handed to the library's pattern engine at once.
SEGMENT_CHARS = 50_000

# A letter or digit, then a space or line break: every pattern alternative ends before
# white space that follows something else, so no match spans this place.
_BOUNDARY = regex.compile(r"(?r)(?<=[A-Za-z0-9])[ \n]")


# As a pattern: the whole input is one match.
_WHOLE = r"(?s:.+)"


@functools.lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file; a worker builds it once."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines) if t}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, most: int = SEGMENT_CHARS) -> Iterator[tuple[str, bool]]:
    """(part, safe) in order; a part is not safe if it is longer than ``most``."""
    start = 0
    while len(text) - start > most:
        cut = _BOUNDARY.search(text, start + 1, start + most)
        end = cut.start() if cut else 0
        if not cut:
            ahead = regex.search(r"(?<=[A-Za-z0-9])[ \n]", text, pos=start + most)
            end = ahead.start() if ahead else len(text)
        yield text[start:end], bool(cut)
        start = end
    if start < len(text):
        yield text[start:], True


def encode_text(text: str, rank_file: str, pattern: str, most: int = SEGMENT_CHARS) -> np.ndarray:
    """Ids of one text as unsigned 32-bit integers."""
    split = encoding(rank_file, pattern)
    if len(text) <= most:
        return split.encode_to_numpy(text, disallowed_special=())
    parts = []
    for part, safe in segments(text, most):
        if safe:
            parts.append(split.encode_to_numpy(part, disallowed_special=()))
        else:
            whole = encoding(rank_file, _WHOLE)
            for match in regex.finditer(pattern, part):
                parts.append(whole.encode_to_numpy(match[0], disallowed_special=()))
    return np.concatenate(parts)


def _fields(df: DataFrame, new: T.StructType) -> tuple[list[str], T.StructType]:
    taken = {f.name.lower() for f in new}
    kept = [f for f in df.schema if f.name.lower() not in taken]
    return [f.name for f in kept], T.StructType(kept + list(new))


def encode(
    df: DataFrame, rank_file: str, pattern: str, *, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Replace the text column by ``ids``, the array of its token ids."""
    hidden = unused("_text", df.columns)

    def run(batches):
        for batch in slices(batches, hidden):
            arrays = [
                encode_text(t or "", rank_file, pattern) for t in batch.column(hidden).to_pylist()
            ]
            ends = np.cumsum([0] + [len(a) for a in arrays], dtype=np.int32)
            flat = np.concatenate(arrays).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            rest = batch.drop_columns([hidden])
            yield with_columns(rest, **{ids: column})

    others = df.drop(F.col(f"`{text}`"))
    kept, schema = _fields(others, T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType()))]))
    columns = [F.col(f"`{c}`") for c in kept]
    return df.select(*columns, F.col(f"`{text}`").alias(hidden)).mapInArrow(run, schema)


def decode(
    df: DataFrame, rank_file: str, pattern: str, *, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """Add the raw bytes that the ids stand for; NULL ids stand for none."""

    def run(batches):
        split = encoding(rank_file, pattern)
        for batch in batches:
            column = batch.column(ids)
            held, start = [], 0
            size = 0
            for i, value in enumerate(column):
                held.append(split.decode_bytes(value.values.to_pylist()) if value.is_valid else b"")
                size += len(held[-1])
                if size > 8 << 20 or i == batch.num_rows - 1:
                    part = batch.slice(start, i + 1 - start)
                    yield with_columns(part, **{out: pa.array(held, pa.binary())})
                    held, start, size = [], i + 1, 0

    new = T.StructType([T.StructField(out, T.BinaryType())])
    kept, schema = _fields(df, new)
    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def digests(df: DataFrame, *, ids: str = "ids", decoded: str = "decoded", keep_ids: bool = False) -> DataFrame:
    """Replace ids (unless kept) and bytes by their number and their SHA-256 in lower-case hex."""
    words = F.array_join(F.col(ids).cast("array<string>"), " ")
    gone = {decoded.lower(), "n_tokens", "ids_sha256", "decoded_sha256"} | (set() if keep_ids else {ids.lower()})
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone],
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(words.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )
