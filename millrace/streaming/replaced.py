"""Landed files that may be replaced by newer content under the same name.

A file stream takes a path up once and never again. Here a ledger notes each content of a
file that was taken up, told by name, modification time and length. A run reads the files
whose present content the ledger lacks, appends their rows to the table with the file and
the run they came from, and then notes them. A row counts if its run is the last that noted
its file; so newer content withdraws the rows of the older one, and rows of a run that was
killed before its note never count. Neither table is ever rewritten.

Files that vanish keep their rows, unless the table is to ``mirror`` the folder, as it must
where a new delivery replaces files by others of a new name; an empty file counts as not
there, as the file sources skip it. If a file is replaced while a run
reads it, the next run sees another modification time and takes it up again. Names hold no
characters that a path pattern gives a meaning to.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from itertools import batched

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE, RUN = "_file", "_run"
LEDGER_SCHEMA = "file string, path string, modified timestamp, length bigint, run string, taken bigint"

# Files that one write reads; the driver holds this many paths at a time.
FILES_PER_WRITE = 10_000

Reader = Callable[[SparkSession, list[str]], DataFrame]


@dataclass(frozen=True)
class ReplaceableTable:
    """A table below ``root`` that follows the files of a folder.

    ``read`` takes a list of files and is one that reads them by a file source, without
    shuffling; ``schema`` is what it gives. Only one run may go on at a time.
    """

    root: str
    read: Reader
    schema: T.StructType
    mirror: bool = False

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    def _exists(self, spark: SparkSession, path: str) -> bool:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)

    def read_ledger(self, spark: SparkSession) -> DataFrame:
        """Every content taken up so far: file, path, modified, length, run (NULL: withdrawn)
        and taken, which grows from run to run."""
        if not self._exists(spark, self.ledger):
            return spark.createDataFrame([], LEDGER_SCHEMA)
        return spark.read.schema(LEDGER_SCHEMA).parquet(self.ledger)

    def newest(self, spark: SparkSession) -> DataFrame:
        """The last note of each file."""
        last = F.max_by(F.struct("path", "modified", "length", "run", "taken"), F.struct("taken", "run"))
        return self.read_ledger(spark).groupBy("file").agg(last.alias("n")).select("file", "n.*")

    def listed(self, spark: SparkSession, landed: str) -> DataFrame:
        """What lies in a folder: file, path, modified, length; no content is read."""
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landed)
        return files.select(F.input_file_name().alias("file"), "path", F.col("modificationTime").alias("modified"), "length")

    def changed(self, spark: SparkSession, landed: str) -> DataFrame:
        """Files of a folder whose content has not been taken up."""
        held = self.newest(spark).filter(F.col("run").isNotNull())
        return self.listed(spark, landed).join(held, ["file", "modified", "length"], "left_anti").select("file", "path", "modified", "length")

    def take_up(self, spark: SparkSession, landed: str) -> int:
        """Take up new and replaced files of a folder; returns their number."""
        n = 0
        taken = self.read_ledger(spark).agg(F.coalesce(F.max("taken"), F.lit(0))).first()[0] + 1
        for files in batched(self.changed(spark, landed).toLocalIterator(), FILES_PER_WRITE):
            run = uuid.uuid4().hex
            rows = self.read(spark, [f.path for f in files])
            rows = rows.select(*[F.col(f"`{c}`") for c in self.schema.names], F.input_file_name().alias(FILE), F.lit(run).alias(RUN))
            rows.write.mode("append").partitionBy(RUN).parquet(self.rows)
            notes = spark.createDataFrame([(*f, run, taken) for f in files], LEDGER_SCHEMA)
            notes.coalesce(1).write.mode("append").parquet(self.ledger)
            n += len(files)
        if self.mirror:
            held = self.newest(spark).filter(F.col("run").isNotNull())
            gone = held.join(self.listed(spark, landed), "file", "left_anti")
            gone = gone.select("file", "path", "modified", "length", F.lit(None).cast("string").alias("run"), F.lit(taken).cast("bigint").alias("taken"))
            gone.write.mode("append").parquet(self.ledger)
        return n

    def current(self, spark: SparkSession) -> DataFrame:
        """The rows of the present content of each file, with its name in ``_file``."""
        schema = T.StructType([*self.schema, T.StructField(FILE, T.StringType()), T.StructField(RUN, T.StringType())])
        if not self._exists(spark, self.rows):
            return spark.createDataFrame([], schema).drop(RUN)
        rows = spark.read.schema(schema).parquet(self.rows)
        newest = self.newest(spark).select(F.col("file").alias(FILE), F.col("run").alias(RUN))
        return rows.join(newest, [FILE, RUN], "left_semi").drop(RUN)
