"""Append-only tables that several writers may extend at once: each append is one version, claimed by one atomic rename."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import exists

ATTEMPTS = 50


class CommitConflict(RuntimeError):
    """Other writers were faster again and again."""


def renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Whether the folder got the name; false if there is a folder of that name. One of several renames to a name succeeds.

    This asks the file system of the driver (a store with an atomic rename, such as HDFS or a mounted disk), so it needs a
    session whose driver runs here.
    """
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path
    system = place(target).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    a, b = (system.makeQualified(place(x)) for x in (source, target))
    gateway = spark.sparkContext._gateway
    try:
        if a.toUri().getScheme() == "file":
            at = [jvm.java.nio.file.Paths.get(x.toUri().getPath(), gateway.new_array(jvm.java.lang.String, 0)) for x in (a, b)]
            jvm.java.nio.file.Files.move(*at, gateway.new_array(jvm.java.nio.file.CopyOption, 0))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), system.getConf())
            context.rename(a, b, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Py4JJavaError:  # what a file system says when the name was taken a moment ago differs
        if system.exists(b):
            return False
        raise
    return True


@dataclass(frozen=True)
class CommitLog:
    """A table below `path`: folders version=1, version=2 ... Rows of an append that has not been claimed are in folders that readers pass over."""

    spark: SparkSession
    path: str
    schema: T.StructType

    def _all(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path) if exists(self.spark, self.path) else self.spark.createDataFrame([], schema)

    def version(self) -> int:
        """The last version, 0 before the first; only names of folders are read."""
        return self._all().agg(F.max("version")).first()[0] or 0

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, or as it is now."""
        rows = self._all()
        return (rows if version is None else rows.where(F.col("version") <= version)).select(*self.schema.fieldNames())

    def commit(self, make: Callable[[DataFrame], DataFrame]) -> int:
        """Adds the rows that `make` gives for the present table; how many they are.

        make sees one version and may refuse by an error. If another writer claims the next version first, make is asked again
        about the table with those rows, so what it has checked holds for the version that it becomes. No rows: no version.
        """
        draft = f"{self.path}/_draft-{uuid.uuid4().hex}"
        for _ in range(ATTEMPTS):
            at = self.version()
            make(self.read(at)).select(*self.schema.fieldNames()).write.mode("overwrite").parquet(draft)
            n = self.spark.read.schema(self.schema).parquet(draft).count()
            if not n or renamed(self.spark, draft, f"{self.path}/version={at + 1}"):
                return n
        raise CommitConflict(f"{self.path}: {ATTEMPTS} attempts to append")
