"""URL filters whose lists change over time.

Dated list entries (a key is listed or released from a day on) become validity intervals:
each entry holds until the next one for the same key. A capture is evaluated against the
entries that hold when it was fetched: an as-of join of its keys with the intervals. Keys
of a capture are its host, every parent domain of the host (``domain:``), and every path
prefix that ends at a slash (``path:``), so each is matched by equality and no pattern runs
against every entry.

A key is looked up by its 128-bit digest. All prefixes of a URL are digested in one run over
it, so a URL of any length costs as much as it is long, and its text is not copied along with
its keys. The join is an equality of digests with a range condition; a host with very many
captures is only ever on the side of the join that Spark splits.

Defined results: a URL that is NULL or has no host matches nothing and is allowed; a capture
without a fetch time is evaluated against no interval; an entry with a NULL key, action or
day is ignored, and one of another form matches nothing; of several entries for one key on
one day, a release goes before a listing, so that the listing holds; repeated captures are
evaluated alike, each on its own row; an empty list allows everything. Domains may have any
number of labels and paths any number of folders. Columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import slices

# Keys that a task hands on at a time.
_KEYS = 50_000

BLOCK, RELEASE = "block", "release"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a final dot; NULL if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.lower(F.regexp_replace(authority, r"^.*@", "")), r":[0-9]*$", "")
    return F.nullif(F.regexp_replace(host, r"\.$", ""), F.lit(""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def digests_of(host: str, path: str) -> list[bytes]:
    """Digests of all keys under which an entry may mention the URL.

    Domains are read from their end, so that each is a prefix of the next.
    """
    own = hashlib.md5(b"host:" + host.encode())
    domain, path_run = hashlib.md5(b"domain:"), hashlib.md5(b"path:" + host.encode())
    out = [own.digest()]
    for n, label in enumerate(host[::-1].split(".")):
        domain.update(("." if n else "").encode() + label.encode())
        out.append(domain.digest())
    for folder in path.split("/")[:-1]:
        path_run.update(folder.encode() + b"/")
        out.append(path_run.digest())
    return out


def digest_of(key: Column) -> Column:
    """The digest by which an entry's key is looked up."""
    value = F.reverse(F.substr(key, F.lit(len("domain:") + 1)))
    return F.unhex(F.md5(F.when(F.startswith(key, F.lit("domain:")), F.concat(F.lit("domain:"), value)).otherwise(key)))


def _keyed(rows: DataFrame) -> DataFrame:
    """(page, fetched_on, key) for every key of rows (page, fetched_on, host, path)."""
    kinds = [("page", pa.binary()), ("fetched_on", pa.date32()), ("key", pa.binary())]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for part in slices(batches, "path"):
            for page, day, host, path in zip(*(part.column(n).to_pylist() for n in ("page", "fetched_on", "host", "path"))):
                for key in digests_of(host, path or ""):
                    out.append((page, day, key))
                    if len(out) == _KEYS:
                        yield batch(out)
                        out = []
        yield batch(out)

    found = rows.filter("host IS NOT NULL AND fetched_on IS NOT NULL").select("page", "fetched_on", "host", "path")
    return found.mapInArrow(run, "page binary, fetched_on date, key binary")


def intervals(entries: DataFrame) -> DataFrame:
    """(key, action, valid_from, valid_to) of entries (key, action, day); open ends are NULL."""
    known = entries.filter("key IS NOT NULL AND action IS NOT NULL AND day IS NOT NULL")
    known = known.select("key", "action", F.col("day").cast("date").alias("valid_from"))
    # "block" sorts before "release".
    known = known.groupBy("key", "valid_from").agg(F.min("action").alias("action"))
    following = Window.partitionBy("key").orderBy("valid_from")
    return known.withColumn("valid_to", F.lead("valid_from").over(following))


def evaluate(captures: DataFrame, entries: DataFrame, *, capture: str = "page_id") -> DataFrame:
    """``capture``, host, fetched_on, n_entries, blocked and rule of each capture.

    ``captures`` has the capture id, url and fetched_on (a date). ``n_entries`` counts the
    entries that hold; the capture is blocked if one of them blocks, and ``rule`` is the
    longest blocking key, ties going to the one that sorts first.
    """
    rows = captures.select(capture, "url", F.col("fetched_on").cast("date").alias("fetched_on"))
    rows = rows.groupBy(capture, "url", "fetched_on").agg(F.count(F.lit(1)).alias("times"))
    told = F.struct(F.col(capture).cast("string"), F.col("url"), F.col("fetched_on").cast("string"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "page": F.unhex(F.md5(F.to_json(told)))})
    keyed = _keyed(rows.withColumn("path", path_of(F.col("url"))))
    # Equal keys of one day are looked up once, whatever the number of captures.
    asked = keyed.select("key", "fetched_on").distinct()
    valid = intervals(entries).withColumnRenamed("key", "listed").withColumn("digest", digest_of(F.col("listed")))
    hits = asked.join(
        valid,
        (F.col("key") == F.col("digest"))
        & (F.col("valid_from") <= F.col("fetched_on"))
        & (F.col("valid_to").isNull() | (F.col("fetched_on") < F.col("valid_to"))),
    ).select("key", "fetched_on", "action", "listed")
    blocking = F.when(F.col("action") == BLOCK, F.struct((-F.length("listed")).alias("l"), F.col("listed").alias("k")))
    found = keyed.join(hits, ["key", "fetched_on"]).groupBy(F.col("page").alias("f_page")).agg(
        F.count(F.lit(1)).alias("n_entries"), F.min(blocking).alias("rule")
    )
    found = found.select("f_page", "n_entries", F.col("rule.k").alias("rule"))
    out = rows.join(found, F.col("page") == F.col("f_page"), "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select(
        capture,
        "host",
        "fetched_on",
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"),
        F.col("rule").isNotNull().alias("blocked"),
        "rule",
    )
