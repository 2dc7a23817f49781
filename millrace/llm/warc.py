"""WARC archives as a Python data source, written and read.

Reading plans the files into partitions of about equal bytes. A task goes through its files
record by record: it parses the header first, tests it against the filters that Spark pushed
down (record type and every other column taken from the header), and leaves the block of an
unwanted record unread. In an archive with one gzip member a record, whose members tell their
lengths, as written here, it jumps to the next member without inflating; else it inflates
without keeping. Of a wanted record the payload is left alone (``payload="none"``), counted
and hashed piece by piece (``"verify"``) or returned (``"bytes"``). Plain and gzip archives
of any origin are read, by one task each.

Writing gives each task files of its own, rolled over at a bounded size, that count only
once the job's list of files is there; a repeated task writes others, and the files of a lost
one are never read. Payloads go into ``response`` records as HTTP messages; ``revisit``
records hold the HTTP head alone, so the full length stands in its Content-Length.

Defined results: a NULL payload is empty; a NULL or empty header value leaves the header out;
control characters and ``%`` in such values are percent-encoded and decoded again. Damage gives one
row with ``error`` and where it is, after which reading goes on at the next record that can
be found; such rows have no record_type, so filters on it drop them. A payload that does not
have the digest of its header is a row with ``error`` too. An empty table gives an empty
archive, repeated rows records each. Columns other than those named are not written.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from millrace.llm.rows import slices
from millrace.sources.archives import store_uri

RESPONSE, REVISIT, INFO = "response", "revisit", "warcinfo"
# Payloads below this size are always stored in full.
SMALLEST_SHARED = 1000
FILE_BYTES = 256 << 20
PARTITION_BYTES = 128 << 20

# Fixed values of the format.
_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "application/http;msgtype=response"
_END = b"\r\n\r\n"
_GZIP_MAGIC = b"\x1f\x8b\x08"
_MOST_HEADER = 64 << 20
_MOST_HTTP_HEAD = 1 << 20

_READ = 1 << 20
_BATCH_BYTES = 8 << 20
_BATCH_ROWS = 2_000

RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("content_type", T.StringType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)
_ARROW = pa.schema(
    [(f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in RECORDS]
)
# Columns that the header alone decides; filters on these are applied before the block is read.
_FROM_HEADER = {"record_id", "record_type", "target_uri", "date", "content_type", "content_length", "refers_to"}
_WRITTEN = T.StructType([f for f in RECORDS if f.name in ("record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest", "payload_bytes", "payload")])


class Damaged(Exception):
    """Bytes that are no WARC record."""


def _store(path: str) -> tuple[fs.FileSystem, str]:
    uri = path if path.startswith("/") else store_uri(path)
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _encoded(value: str) -> bytes:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", value).encode()


def _decoded(value: bytes) -> str:
    return unquote_to_bytes(value).decode("utf-8", "replace")


def digest_header(hex_digest: str) -> str:
    """A SHA-1 in hex as the header spells it."""
    return "sha1:" + base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _bare(digest: str | None) -> str | None:
    """Lower-case hex of the SHA-1 that a header spells in base 32 or 16; other digests are left as they are."""
    kind, _, value = (digest or "").partition(":")
    if kind.lower() != "sha1":
        return digest
    if len(value) == 40:
        return value.lower()
    try:
        return base64.b32decode(value.upper()).hex()
    except ValueError:
        return digest


# Writing ------------------------------------------------------------------------------------


def member(record: bytes, level: int) -> bytes:
    """One gzip member whose head tells its packed and full length ("sl", the format's skip lengths)."""
    pack = zlib.compressobj(level, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = pack.compress(record) + pack.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    whole = 10 + 2 + 12 + len(body) + len(tail)
    if max(whole, len(record)) > 0xFFFFFFFF:
        raise ValueError("a record above 4 GiB")
    head = _GZIP_MAGIC + bytes([0x04, 0, 0, 0, 0, 0, 0xFF]) + struct.pack("<H2sHII", 12, b"sl", 8, whole, len(record))
    return head + body + tail


def record_bytes(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: ".encode() + _encoded(value) for name, value in headers if value]
    return _VERSION + b"\r\n".join([*lines, f"Content-Length: {len(block)}".encode()]) + _END + block + _END


@dataclass
class _Files(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.job = options["path"].rstrip("/"), uuid.uuid4().hex
        self.level, self.most = int(options.get("level", 6)), int(options.get("filebytes", FILE_BYTES))
        self.date = options.get("date") or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def _record(self, r: dict) -> bytes:
        payload = r["payload"] or b""
        kind, size = r["record_type"] or RESPONSE, r["payload_bytes"]
        size = len(payload) if size is None else size
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}".encode() + _END
        digest = r["payload_digest"] or hashlib.sha1(payload).hexdigest()
        headers = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", f"<{r['record_id'] or uuid.uuid4().urn}>"),
            ("WARC-Date", r["date"] or self.date),
            ("WARC-Target-URI", r["target_uri"]),
            ("WARC-Payload-Digest", digest_header(digest)),
            ("Content-Type", _HTTP),
        ]
        if kind == REVISIT:
            headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{r['refers_to']}>" if r["refers_to"] else None)]
            return record_bytes(headers, head)
        return record_bytes(headers, head + payload)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        info = record_bytes(
            [("WARC-Type", INFO), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", self.date), ("Content-Type", "application/warc-fields")],
            b"format: WARC File Format 1.1\r\n",
        )
        names, out = [], None
        names_in = [f.name for f in _WRITTEN]
        try:
            for batch in slices(iterator, "payload"):
                for cells in zip(*(batch.column(n) for n in names_in)):
                    if out is None or out.tell() >= self.most:
                        if out is not None:
                            out.close()
                        names.append(f"part-{self.job}-{uuid.uuid4().hex}.warc.gz")
                        out = store.open_output_stream(f"{root}/{names[-1]}", compression=None)
                        out.write(member(info, self.level))
                    out.write(member(self._record({n: c.as_py() for n, c in zip(names_in, cells)}), self.level))
        finally:
            if out is not None:
                out.close()
        return _Files(names)

    def commit(self, messages: list[_Files | None]) -> None:
        """The job's list of files, without which none of them is read."""
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        with store.open_output_stream(f"{root}/_files-{self.job}.json", compression=None) as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list[_Files | None]) -> None:
        """Files without a list are never read; those of tasks that reported are removed."""
        store, root = _store(self.path)
        for name in [n for m in messages if m is not None for n in m.names]:
            store.delete_file(f"{root}/{name}")


# Reading ------------------------------------------------------------------------------------


class _Plain:
    """Bytes of an uncompressed archive."""

    def __init__(self, file, at: int):
        self.file, self.held, self.at = file, b"", at
        file.seek(at)

    def more(self) -> bool:
        data = self.file.read(_READ)
        self.held += data
        return bool(data)

    def take(self, n: int) -> bytes:
        """The next bytes, at most n; none at the end."""
        if not self.held and n:
            self.more()
        out, self.held = self.held[:n], self.held[n:]
        self.at += len(out)
        return out

    def skip(self, n: int) -> None:
        if n > len(self.held):
            if self.at + n > self.file.size():
                raise Damaged("the block ends early")
            self.at += n
            self.held = b""
            self.file.seek(self.at)
        else:
            self.take(n)

    def where(self) -> int:
        return self.at


class _Inflated(_Plain):
    """Bytes of a gzip archive; ``start`` is where the member of the last byte begins."""

    def __init__(self, file, at: int):
        self.packed, self.unpack = b"", None
        self.start, self.whole, self.left = at, None, None
        super().__init__(file, at)
        self.place = at  # of the packed bytes not yet inflated

    def _load(self, n: int) -> bool:
        while len(self.packed) < n:
            data = self.file.read(_READ)
            if not data:
                return False
            self.packed += data
        return True

    def _open(self) -> bool:
        """Begin the next member; False at the end of the file."""
        if not self._load(1):
            return False
        self.start, self.whole, self.left = self.place, None, None
        if not self._load(12) or not self.packed.startswith(_GZIP_MAGIC):
            raise Damaged("no gzip member")
        self.unpack = zlib.decompressobj(zlib.MAX_WBITS | 16)
        if self.packed[3] & 0x04:
            n = struct.unpack_from("<H", self.packed, 10)[0]
            if self._load(12 + n):
                at, extra = 0, self.packed[12 : 12 + n]
                while at + 4 <= n:
                    name, size = struct.unpack_from("<2sH", extra, at)
                    if name == b"sl" and size == 8 and at + 12 <= n:
                        self.whole, self.left = struct.unpack_from("<II", extra, at + 4)
                    at += 4 + size
        return True

    def more(self) -> bool:
        while True:
            if self.unpack is None:
                if not self._open():
                    return False
                if self.held:  # bytes of two members: what is left of one is not known
                    self.left = None
            if not self.packed and not self._load(1):
                raise Damaged("the last gzip member ends early")
            given = self.packed
            data = self.unpack.decompress(given, _READ)
            self.packed = self.unpack.unconsumed_tail or self.unpack.unused_data
            self.place += len(given) - len(self.packed)
            if self.unpack.eof:
                self.unpack = None
            self.held += data
            if data:
                return True

    def take(self, n: int) -> bytes:
        out = super().take(n)
        if self.left is not None:
            self.left -= len(out)
        return out

    def skip(self, n: int) -> None:
        # The rest of a member that says how long it is need not be inflated.
        if self.left is not None and self.left == n + len(_END) and self.start + self.whole <= self.file.size():
            self.place = self.start + self.whole
            self.file.seek(self.place)
            self.packed, self.held, self.unpack, self.left = b"", _END, None, None
            return
        while n:
            got = self.take(min(n, _READ))
            if not got:
                raise Damaged("the block ends early")
            n -= len(got)

    def where(self) -> int:
        return self.start


def _header(source: _Plain) -> dict[str, bytes] | None:
    """The fields of the next record by lower-case name; None at the end of the file."""
    while (end := source.held.find(_END)) < 0:
        if len(source.held) > _MOST_HEADER:
            raise Damaged("a header without end")
        if not source.more():
            if source.held.strip(b"\r\n"):
                raise Damaged("a header without end")
            return None
    lines = source.take(end + len(_END))[: -len(_END)].split(b"\r\n")
    if not re.fullmatch(rb"WARC/[0-9.]+", lines[0]):
        raise Damaged("no WARC record")
    out, last = {}, None
    for line in lines[1:]:
        if line[:1] in (b" ", b"\t") and last:
            out[last] += b" " + line.strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("a header line without a colon")
        last = name.strip().lower().decode("latin-1")
        out[last] = value.strip()
    if not re.fullmatch(rb"[0-9]{1,18}", out.get("content-length", b"")):
        raise Damaged("a record without Content-Length")
    return out


def _row(fields: dict[str, bytes], file: str, offset: int) -> dict:
    def text(name):
        return _decoded(fields[name]) if name in fields else None

    def bracketed(name):
        value = text(name)
        return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value

    return {
        "record_id": bracketed("warc-record-id"),
        "record_type": text("warc-type"),
        "target_uri": bracketed("warc-target-uri"),
        "date": text("warc-date"),
        "content_type": text("content-type"),
        "content_length": int(fields["content-length"]),
        "refers_to": bracketed("warc-refers-to"),
        "payload_digest": _bare(text("warc-payload-digest")),
        "payload_bytes": None,
        "payload": None,
        "file": file,
        "offset": offset,
        "error": None,
    }


_TESTS = {
    EqualTo: lambda x, y: x == y,
    GreaterThan: lambda x, y: x > y,
    GreaterThanOrEqual: lambda x, y: x >= y,
    LessThan: lambda x, y: x < y,
    LessThanOrEqual: lambda x, y: x <= y,
    In: lambda x, y: x in y,
    StringStartsWith: lambda x, y: x.startswith(y),
    StringEndsWith: lambda x, y: x.endswith(y),
    StringContains: lambda x, y: y in x,
}


def _known(f: Filter) -> bool:
    f = f.child if isinstance(f, Not) else f
    return type(f) in (*_TESTS, EqualNullSafe, IsNull, IsNotNull) and len(f.attribute) == 1 and f.attribute[0] in _FROM_HEADER


def holds(f: Filter, row: dict) -> bool | None:
    """The filter on a row, None where SQL has neither true nor false."""
    if isinstance(f, Not):
        inner = holds(f.child, row)
        return None if inner is None else not inner
    value = row[f.attribute[0]]
    if isinstance(f, (IsNull, IsNotNull)):
        return (value is None) == isinstance(f, IsNull)
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None or f.value is None:
        return None
    if isinstance(f, In) and value not in f.value and any(v is None for v in f.value):
        return None
    # Spark orders strings by their bytes.
    if isinstance(value, str) and isinstance(f.value, str) and not isinstance(f, (StringStartsWith, StringEndsWith, StringContains)):
        return _TESTS[type(f)](value.encode(), f.value.encode())
    return _TESTS[type(f)](value, f.value)


def _pieces(source: _Plain, n: int) -> Iterator[bytes]:
    while n:
        piece = source.take(min(n, _READ))
        if not piece:
            raise Damaged("the block ends early")
        n -= len(piece)
        yield piece


def _fill(row: dict, source: _Plain, mode: str) -> None:
    """Read the block of a wanted record as far as it is asked for."""
    left, whole = row["content_length"], row["content_length"]
    http = (row["content_type"] or "").replace(" ", "").lower().startswith("application/http")
    head = b""
    if http and left:
        while _END not in head and left and len(head) < _MOST_HTTP_HEAD:
            piece = source.take(min(left, 1 << 14))
            if not piece:
                raise Damaged("the block ends early")
            head += piece
            left -= len(piece)
        head, mark, begun = head.partition(_END)
        if not mark:
            head, begun = b"", head
    else:
        begun = b""
    if row["record_type"] == REVISIT:
        found = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", head)
        row["payload_bytes"] = int(found[1]) if found else None
        source.skip(left)
        return
    row["payload_bytes"] = len(begun) + left
    if mode == "none":
        source.skip(left)
        return
    found, kept = hashlib.sha1(begun), [begun]
    for piece in _pieces(source, left):
        found.update(piece)
        if mode == "bytes":
            kept.append(piece)
    stated, row["payload_digest"] = row["payload_digest"], found.hexdigest()
    if stated is not None and re.fullmatch("[0-9a-f]{40}", stated) and stated != row["payload_digest"]:
        row["error"] = f"the header states {stated}"
    if mode == "bytes":
        row["payload"] = b"".join(kept)


def _pass_end(source: _Plain) -> None:
    """Pass the empty lines after a block."""
    end = b""
    while len(end) < len(_END) and (piece := source.take(len(_END) - len(end))):
        end += piece
    if end != _END:
        raise Damaged("no end of record after the block")


def _next_start(file, at: int, packed: bool) -> int | None:
    """Where after ``at`` a record may begin."""
    mark = _GZIP_MAGIC if packed else _END + b"WARC/1."
    file.seek(at + 1)
    held, base = b"", at + 1
    while True:
        data = file.read(_READ)
        held += data
        found = held.find(mark)
        if found >= 0:
            return base + found + (0 if packed else len(_END))
        if not data:
            return None
        cut = max(0, len(held) - len(mark) + 1)
        held, base = held[cut:], base + cut


def records_of(file, name: str, filters: list[Filter], mode: str) -> Iterator[dict]:
    """The wanted records of an open archive, and a row for each stretch of damage."""
    packed = file.read(len(_GZIP_MAGIC)) == _GZIP_MAGIC
    at, failed = 0, False
    while at is not None and at < file.size():
        source, begin = (_Inflated if packed else _Plain)(file, at), at
        try:
            while True:
                begin = source.where()
                fields = _header(source)
                if fields is None:
                    return
                begin = source.where() if packed else begin
                row = _row(fields, name, begin)
                wanted = all(holds(f, row) is True for f in filters)
                if wanted:
                    _fill(row, source, mode)
                else:
                    source.skip(row["content_length"])
                _pass_end(source)
                failed = False
                if wanted:
                    yield row
        except (Damaged, zlib.error, UnicodeDecodeError) as e:
            begin = source.where() if packed else begin
            # Bytes tried as the start of a record on the way are no damage of their own.
            if not failed:
                error = {n: None for n in RECORDS.names} | {"file": name, "offset": begin, "error": f"{type(e).__name__}: {e}"}
                if all(holds(f, error) is True for f in filters):
                    yield error
            failed = True
            at = _next_start(file, max(begin, at), packed)


@dataclass
class _Part(InputPartition):
    files: list[str]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.mode = options["path"].rstrip("/"), options.get("payload", "none")
        if self.mode not in ("none", "verify", "bytes"):
            raise ValueError(f"payload is none, verify or bytes, not {self.mode}")
        self.size, self.filters = int(options.get("partitionbytes", PARTITION_BYTES)), []
        self.tasks = int(options.get("tasks", 1))

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if _known(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[_Part]:
        store, root = _store(self.path)
        there = store.get_file_info(root)
        if there.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        if there.type == fs.FileType.File:
            return [_Part([root])]
        found = [f for f in store.get_file_info(fs.FileSelector(root, recursive=True)) if f.type == fs.FileType.File]
        listed = set()
        for f in found:
            if re.fullmatch(r"_files-[0-9a-f]{32}\.json", f.base_name):
                with store.open_input_stream(f.path, compression=None) as file:
                    listed.update(json.loads(file.read()))
        def wanted(f: fs.FileInfo) -> bool:
            own = re.fullmatch(r"part-[0-9a-f]{32}-[0-9a-f]{32}\.warc\.gz", f.base_name)
            return bool(re.search(r"\.warc(\.gz)?$", f.base_name)) and f.base_name[0] not in "_." and (not own or f.base_name in listed)

        found = sorted(filter(wanted, found), key=lambda f: f.path)
        # Few bytes are spread over the tasks that can run at once.
        most = min(self.size, -(-sum(f.size for f in found) // self.tasks))
        out, held = [], 0
        for f in found:
            if not out or held + f.size > most:
                out.append(_Part([]))
                held = 0
            out[-1].files.append(f.path)
            held += f.size
        return out or [_Part([])]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        rows, held = [], 0
        for name in partition.files:
            with store.open_input_file(name) as file:
                for row in records_of(file, name, self.filters, self.mode):
                    rows.append(row)
                    held += len(row["payload"] or b"") + 500
                    if held >= _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class WarcSource(DataSource):
    """``spark.read.format("warc")`` with the options path, payload, partitionBytes and tasks, and
    ``df.write.format("warc").mode("append")`` with path, level, fileBytes and date."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return RECORDS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("archives are appended to")
        if [(f.name, f.dataType) for f in schema] != [(f.name, f.dataType) for f in _WRITTEN]:
            raise ValueError(f"records are written from {_WRITTEN.simpleString()}")
        return _Writer(dict(self.options))


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with the store that Spark would take it from."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def write_records(records: DataFrame, path: str, **options: object) -> None:
    """Write records to archives below ``path``; columns that are not there count as NULL."""
    spark = records.sparkSession
    spark.dataSource.register(WarcSource)
    have = set(records.columns)
    columns = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in _WRITTEN]
    out = records.select(*columns).write.format("warc").mode("append")
    out.options(**{k: str(v) for k, v in options.items()}).save(_qualified(spark, path))


def read_records(spark: SparkSession, path: str, payload: str = "none", **options: object) -> DataFrame:
    """The records of an archive or of all archives below a folder."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    options = {"tasks": spark.sparkContext.defaultParallelism} | options
    return spark.read.format("warc").options(payload=payload, **{k: str(v) for k, v in options.items()}).load(_qualified(spark, path))


def share_payloads(pages: DataFrame, id: str, payload: str, smallest: int = SMALLEST_SHARED) -> DataFrame:
    """Add payload_bytes, payload_digest, record_type and response_id to pages.

    Of equal payloads of at least ``smallest`` bytes the one with the largest id is stored,
    the others revisit it (response_id); payloads below that are all stored. Rows that share
    the largest id are stored each; where no id is known, all are.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    sized = pages.withColumns({"payload_bytes": F.octet_length(body).cast("long"), "payload_digest": F.sha1(body)})
    large = F.col("payload_bytes") >= smallest
    stored = sized.filter(large).groupBy(F.col("payload_digest").alias("of_digest")).agg(
        F.max(id).alias("response_id"), F.count(F.lit(1)).alias("of_rows")
    )
    stored = stored.filter("of_rows > 1 AND response_id IS NOT NULL").drop("of_rows")
    joined = sized.filter(large).join(stored, F.col("payload_digest") == F.col("of_digest"), "left").drop("of_digest")
    joined = joined.unionByName(sized.filter(~large).withColumn("response_id", F.lit(None).cast(pages.schema[id].dataType)))
    again = F.col("response_id").isNotNull() & ~F.col(id).eqNullSafe(F.col("response_id"))
    kind = F.when(again, F.lit(REVISIT)).otherwise(F.lit(RESPONSE))
    return joined.withColumn("record_type", kind).withColumn("response_id", F.when(again, F.col("response_id")))
