"""A schema that grows with the feed: versions kept beside the tables.

Fields that the schema lacks are rescued as text (``read_edits(rescue=True)``). Here their names
and types are found from that text, and the next version of the schema has them as columns, at
the top or inside a nested object. Rows read before keep the fields as rescued text and have
NULL in the new columns; nothing written is changed.

A type narrower than text is taken only if every value seen comes back from it as the same
text, so ``007`` stays text. A known field whose values do not fit its type is a conflict:
its type is not changed and the values stay rescued. Names that differ from a known one, or
from a more frequent new one, in case only are conflicts too, as Spark would mix them up.
"""

from __future__ import annotations

import json

from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import CORRUPT, RESCUED, UNREADABLE, with_rescued
from millrace.sources.readers import read_edits
from millrace.streaming.medallion import EDITS, READABLE, Feed

# New fields that one version adds, the most frequent first; the others stay rescued for the next.
FIELDS_PER_VERSION = 100

_OWN = {RESCUED.lower(), CORRUPT.lower(), UNREADABLE.lower(), READABLE.lower()}
_NARROW = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


@dataclass(frozen=True)
class Growth:
    """The next schema, the fields it adds, and the fields refused (both as paths)."""

    schema: T.StructType
    added: list[tuple[str, ...]]
    conflicts: list[tuple[str, ...]]


def _leftovers(rows: DataFrame, structs: list[str]) -> DataFrame:
    """(parent, name, value) of every rescued field; parent is NULL at the top."""
    def fields(text: Column) -> Column:
        return F.explode(F.from_json(text, "map<string,string>"))

    top = rows.filter(F.col(RESCUED).isNotNull()).select(fields(F.col(RESCUED)).alias("name", "value"))
    inside = F.col("name").isin(structs) & F.startswith("value", F.lit("{"))
    top = top.withColumn("kind", F.when(inside, F.lit("object")))
    plain = F.array(F.struct(F.lit(None).cast("string").alias("parent"), "name", "value"))
    inner = F.transform(
        F.map_entries(F.from_json("value", "map<string,string>")),
        lambda e: F.struct(F.col("name").alias("parent"), e["key"].alias("name"), e["value"].alias("value")),
    )
    return top.select(F.inline(F.when(F.col("kind").isNotNull(), inner).otherwise(plain)))


def propose(rows: DataFrame, schema: T.StructType, most: int = FIELDS_PER_VERSION) -> Growth:
    """The schema that takes up what was rescued in ``rows``.

    What is brought together is one row per field name, the ``most`` most frequent unknown
    ones and the known ones; a feed that makes names out of data fills no driver.
    """
    structs = {f.name: f.dataType for f in schema if isinstance(f.dataType, T.StructType)}
    known = {(None, f.name): f.dataType for f in schema}
    known |= {(s, f.name): f.dataType for s, kind in structs.items() for f in kind}
    stats = _leftovers(rows, list(structs)).groupBy("parent", "name").agg(
        F.count("value").alias("n"),
        *[F.coalesce(F.every(F.col("value").try_cast(t).cast("string").eqNullSafe(F.col("value")) | F.col("value").isNull()), F.lit(False)).alias(t) for t in _NARROW],
        *[F.coalesce(F.every(F.col("value").try_cast(t).isNotNull() | F.col("value").isNull()), F.lit(False)).alias(f"fits_{t}") for t in _NARROW],
    )
    is_known = F.lit(False)
    for parent in [None, *structs]:
        names = [n for p, n in known if p == parent]
        is_known = is_known | (F.col("parent").eqNullSafe(F.lit(parent)) & F.col("name").isin(names))
    conflicts, added = [], {}
    # One job: first the known fields, as many as the schema has, then the most frequent others.
    stats = stats.withColumn("known", F.coalesce(is_known, F.lit(False))).filter(F.col("known") | (F.col("n") > 0))
    first = stats.orderBy(F.desc("known"), F.desc("n"), "parent", "name").limit(len(known) + most).collect()
    for r in (r for r in first if r.known):
        kind = known[r.parent, r.name]
        fits = isinstance(kind, T.StringType) or (kind.simpleString() in ("int", "smallint", "tinyint") and r.fits_bigint)
        if not fits and not (kind.simpleString() in _NARROW and r[f"fits_{kind.simpleString()}"]):
            conflicts.append((r.parent, r.name))
    taken = {(p, n.lower()) for p, n in known} | {(None, n) for n in _OWN}
    for r in [r for r in first if not r.known][:most]:
        if (r.parent, r.name.lower()) in taken:
            conflicts.append((r.parent, r.name))
            continue
        taken.add((r.parent, r.name.lower()))
        added[r.parent, r.name] = next((kind for t, kind in _NARROW.items() if r[t]), T.StringType())

    def grown(kind: T.StructType, parent: str | None) -> T.StructType:
        own = sorted(((n, t) for (p, n), t in added.items() if p == parent), key=lambda f: f[0])
        fields = [T.StructField(f.name, grown(f.dataType, f.name), f.nullable) if parent is None and f.name in structs else f for f in kind]
        return T.StructType(fields + [T.StructField(n, t) for n, t in own])

    def paths(keys) -> list[tuple[str, ...]]:
        return sorted(tuple(k for k in key if k is not None) for key in keys)

    return Growth(grown(schema, None), paths(added), paths(conflicts))


@dataclass(frozen=True)
class SchemaLog:
    """Versions of a schema as numbered files below ``path``; before the first it is ``base``."""

    path: str
    base: T.StructType

    def _store(self, spark: SparkSession):
        hadoop = spark._jvm.org.apache.hadoop.fs
        return hadoop.Path, hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self, spark: SparkSession) -> int:
        path, store = self._store(spark)
        if not store.exists(path(self.path)):
            return 0
        names = [f.getPath().getName() for f in store.listStatus(path(self.path))]
        return max((int(n.removesuffix(".json")) for n in names if n[0].isdigit()), default=0)

    def read(self, spark: SparkSession, version: int | None = None) -> T.StructType:
        """A version of the schema, the newest if none is named."""
        version = self.version(spark) if version is None else version
        if version == 0:
            return self.base
        text = spark.read.text(f"{self.path}/{version:06d}.json", wholetext=True).first()[0]
        return T.StructType.fromJson(json.loads(text))

    def append(self, spark: SparkSession, schema: T.StructType) -> int:
        """Write the next version; fails if another writer has just taken its number."""
        path, store = self._store(spark)
        version = self.version(spark) + 1
        out = store.create(path(f"{self.path}/{version:06d}.json"), False)
        out.write(bytearray(schema.json().encode()))
        out.close()
        return version

    def grow(self, spark: SparkSession, rows: DataFrame) -> Growth:
        """Take up what was rescued in ``rows``; a version is written only if fields are added."""
        growth = propose(rows, self.read(spark))
        if growth.added:
            self.append(spark, growth.schema)
        return growth


def grown_edits(spark: SparkSession, log: SchemaLog) -> Feed:
    """The change feed by the newest schema, with what it still lacks rescued."""
    schema = log.read(spark)
    return replace(EDITS, schema=with_rescued(schema), read=partial(read_edits, rescue=True, schema=schema))
