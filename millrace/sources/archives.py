"""ZIP archives of export members, unpacked inside tasks.

Spark lists the archives and never reads them. A first task opens an archive by path and reads
its directory only, and cuts the data members into runs of bounded size; the runs are dealt
out anew, so the members of one large archive are unpacked by several tasks. A run is streamed
out as bounded Arrow batches of lines. A member within ``HELD_BYTES`` is inflated once, a
larger one twice, as its checksum is tested before its first line leaves the task.

A damaged member, whatever its compression, gives one error row and no lines; the others of
its archive are read. Only what is wrong with an archive itself makes such rows. A store that
cannot be reached fails the task, and Spark tries it again.
"""

from __future__ import annotations

import io
import lzma
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import EVENT_SCHEMA, UNREADABLE, UNREADABLE_SCHEMA

# Fixed value: suffix of the members that carry data.
MEMBER_SUFFIX = ".CSV"

# Packed bytes that one run of members holds, unless a single member is larger, and the
# unpacked size up to which a member is held in memory.
RUN_BYTES = 64 << 20
HELD_BYTES = 32 << 20

_LINES_PER_BATCH = 20_000
_PROBE_BYTES = 1 << 20
_ENCRYPTED = 0x1
_PACKED = (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# How the stores that Spark names are called by the library that opens files in tasks.
_SCHEMES = {
    "file": "file",
    "s3": "s3",
    "s3a": "s3",
    "s3n": "s3",
    "gs": "gs",
    "hdfs": "hdfs",
    "viewfs": "viewfs",
    "abfs": "abfs",
    "abfss": "abfss",
    "wasb": "abfs",
    "wasbs": "abfss",
}

LINE_SCHEMA = T.StructType(
    [
        T.StructField("archive", T.StringType(), True),
        T.StructField("member", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
    ]
)
_ARROW_SCHEMA = pa.schema([(f.name, pa.string()) for f in LINE_SCHEMA])


class UnreadableArchive(Exception):
    """An archive that this library cannot unpack."""


class _Watched(io.RawIOBase):
    """A stored file that remembers a failure of its store.

    The ZIP reader takes any failed read of an archive's end for "no archive".
    """

    def __init__(self, file: pa.NativeFile):
        self._file, self._size, self.fault = file, file.size(), None

    def readable(self):
        return True

    def seekable(self):
        return True

    def tell(self):
        return self._file.tell()

    def seek(self, offset, whence=io.SEEK_SET):
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self._file.tell(), io.SEEK_END: self._size}[whence]
        if start + offset < 0:
            raise OSError("position before the start of the file")
        return self._file.seek(start + offset)

    def readinto(self, buffer):
        try:
            data = self._file.read(len(buffer))
        except OSError as e:
            self.fault = e
            raise
        buffer[: len(data)] = data
        return len(data)


def store_uri(path: str) -> str:
    """The path as the library that opens files names it; an unknown store is an error."""
    parts = urlsplit(path)
    if parts.scheme not in _SCHEMES:
        raise ValueError(f"no way is known to open {parts.scheme}: files; pass a filesystem")
    if parts.scheme == "file":
        return unquote(parts.path)
    host = parts.netloc.replace(".blob.", ".dfs.") if parts.scheme.startswith("wasb") else parts.netloc
    return f"{_SCHEMES[parts.scheme]}://{host}{unquote(parts.path)}"


def _checked(spark: SparkSession, path: str, filesystem: fs.FileSystem | None) -> None:
    """Refuse a store that tasks could not open, before anything is read or committed."""
    scheme = urlsplit(path).scheme
    if not scheme:
        scheme = urlsplit(spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")).scheme
    if filesystem is None:
        store_uri(f"{scheme}://host/name")


def read_archives(
    spark: SparkSession,
    path: str,
    *,
    stream: bool = False,
    options: dict | None = None,
    filesystem: fs.FileSystem | None = None,
) -> DataFrame:
    """The archives of a folder, one ``archive`` path each; their content is not read.

    ``filesystem`` opens them in tasks (``unzip``) where the store needs settings of its own
    or has a scheme that is not known here.
    """
    _checked(spark, path, filesystem)
    reader = spark.readStream if stream else spark.read
    files = reader.format("binaryFile").schema(_FILE_SCHEMA).options(**(options or {})).load(path)
    return files.select(F.col("path").alias("archive"))


def _opened(archive: str, filesystem: fs.FileSystem | None):
    if filesystem is not None:
        parts = urlsplit(archive)
        return filesystem.open_input_file(unquote(f"{parts.netloc}{parts.path}"))
    uri = store_uri(archive)
    store, name = (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)
    return store.open_input_file(name)


# What the unpacking of a damaged member ends in; OSError comes from one of the codecs too.
_DAMAGE = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, NotImplementedError, OSError, UnreadableArchive)
_RUN_SCHEMA = "archive string, first int, last int, error string"


def _told(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"


def _runs_of(archive: str, suffix: str, filesystem: fs.FileSystem | None) -> Iterator[tuple]:
    """Runs of data members of an archive, by their places in its directory."""
    with _opened(archive, filesystem) as stored:
        watched = _Watched(stored)
        try:
            with zipfile.ZipFile(io.BufferedReader(watched, _PROBE_BYTES)) as z:
                directory = z.infolist()
        except _DAMAGE as e:
            if watched.fault is not None:
                raise watched.fault from e
            yield archive, None, None, _told(e)
            return
    first = last = None
    held = 0
    for n, info in enumerate(directory):
        if not info.filename.endswith(suffix):
            continue
        if first is not None and held + info.compress_size > RUN_BYTES:
            yield archive, first, last, None
            first, held = None, 0
        first, last, held = n if first is None else first, n, held + info.compress_size
    if first is not None:
        yield archive, first, last, None


def _tested(z: zipfile.ZipFile, info: zipfile.ZipInfo) -> io.BufferedIOBase:
    """The content of a member that is known to be sound."""
    if info.flag_bits & _ENCRYPTED:
        raise UnreadableArchive("member is encrypted")
    if info.compress_type not in _PACKED:
        raise UnreadableArchive(f"unknown compression {info.compress_type}")
    if info.file_size <= HELD_BYTES:
        with z.open(info) as raw:
            return io.BytesIO(raw.read())
    with z.open(info) as raw:
        while raw.read(_PROBE_BYTES):
            pass
    return z.open(info)


def _lines_of(archive: str, first: int, last: int, suffix: str, filesystem: fs.FileSystem | None) -> Iterator[pa.RecordBatch]:
    """Lines of the data members from one place in the directory to another."""

    def batch(member, values, error=None):
        n = len(values)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([archive] * n, pa.string()),
                pa.array([member] * n, pa.string()),
                pa.array(values, pa.string()),
                pa.array([error] * n, pa.string()),
            ],
            schema=_ARROW_SCHEMA,
        )

    with _opened(archive, filesystem) as stored:
        watched = _Watched(stored)
        with zipfile.ZipFile(io.BufferedReader(watched, _PROBE_BYTES)) as z:
            for info in z.infolist()[first : last + 1]:
                member = info.filename
                if not member.endswith(suffix):
                    continue
                try:
                    raw = _tested(z, info)
                except _DAMAGE as e:
                    if watched.fault is not None:
                        raise watched.fault from e
                    yield batch(member, [None], _told(e))
                    continue
                with raw:
                    chunk = []
                    for line in io.TextIOWrapper(raw, "utf-8", errors="replace"):
                        chunk.append(line.rstrip("\n"))
                        if len(chunk) == _LINES_PER_BATCH:
                            yield batch(member, chunk)
                            chunk = []
                    if chunk:
                        yield batch(member, chunk)


def unzip(
    archives: DataFrame, suffix: str = MEMBER_SUFFIX, filesystem: fs.FileSystem | None = None
) -> DataFrame:
    """Lines of all data members as (archive, member, value, error).

    What cannot be unpacked gives one row with ``error`` set: a damaged, encrypted or unknown
    member under its name, an archive without a readable directory under no member.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [r for archive in b.column(0).to_pylist() for r in _runs_of(archive, suffix, filesystem)]
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.string())
            columns = [pa.array([r[i] for r in found], t) for i, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["archive", "first", "last", "error"])

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, first, last, error in zip(*(c.to_pylist() for c in b.columns)):
                if error is None:
                    yield from _lines_of(archive, first, last, suffix, filesystem)
                else:
                    yield pa.RecordBatch.from_pylist([{"archive": archive, "error": error}], schema=_ARROW_SCHEMA)

    spread = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = archives.select("archive").mapInArrow(runs, _RUN_SCHEMA)
    return found.repartition(spread).mapInArrow(lines, LINE_SCHEMA)


def members(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("error").isNull()).drop("error")


def unreadable_archives(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("error").isNotNull()).select("archive", "member", "error")


def read_archived_events(
    spark: SparkSession, path: str, *, stream: bool = False, options: dict | None = None
) -> DataFrame:
    """Event rows straight from landed archives; ``read_unreadable_archives`` has the rest."""
    lines = unzip(read_archives(spark, path, stream=stream, options=options))
    return member_events(lines).select(*EVENT_SCHEMA.names)


def read_unreadable_archives(
    spark: SparkSession, path: str, *, stream: bool = False, options: dict | None = None
) -> DataFrame:
    """What could not be unpacked: source, member, text (NULL), error."""
    lines = unzip(read_archives(spark, path, stream=stream, options=options))
    bad = unreadable_archives(lines).withColumnRenamed("archive", "source")
    return bad.withColumn("text", F.lit(None).cast("string")).select(*UNREADABLE_SCHEMA.names)


def read_archives_once(
    spark: SparkSession, path: str, *, stream: bool = False, options: dict | None = None
) -> DataFrame:
    """Event rows of landed archives and, with ``_unreadable`` set, what could not be unpacked:
    each archive is read once."""
    lines = unzip(read_archives(spark, path, stream=stream, options=options))
    lines = lines.filter(F.col("error").isNotNull() | (F.trim("value") != ""))
    text = F.lit(None).cast("string")
    fault = F.struct(F.col("archive").alias("source"), "member", text.alias("text"), "error")
    fault = F.when(F.col("error").isNotNull(), fault).alias(UNREADABLE)
    rows = lines.select(_event_of("value").alias("e"), fault)
    return rows.select(*[F.col(f"e.{n}") for n in EVENT_SCHEMA.names], UNREADABLE)


def _event_of(column: str):
    layout = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in EVENT_SCHEMA)
    return F.from_csv(column, layout, {"sep": "\t"})


def member_events(lines: DataFrame) -> DataFrame:
    """Event rows of unpacked member lines, with the archive and member they came from."""
    data = members(lines).filter(F.trim("value") != "")
    return data.select("archive", "member", _event_of("value").alias("e")).select("archive", "member", "e.*")
