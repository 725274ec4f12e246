"""Reading and writing of tables; only Spark touches storage, so any store that it can reach will do."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import ConfigError
from ..operators.guards import ContractError


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can find the path, in whatever store it lies."""
    try:
        spark.read.text(path).schema
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A report or manifest, replaced: a folder with one text file, in whatever store Spark can reach."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()).rstrip("\n")


def work_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, the folder that driver and executors share. Only a session on one machine may have none; it gets one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise ConfigError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="stakescope-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


@dataclass
class Workspace:
    """Tables that a run writes once and reads many times, in a database below spark.checkpoint.dir; so what many later steps use is
    computed once, and a lost executor costs a stage, not the run.

    Called with a table, a name and perhaps a key: the table as written. With a key it is bucketed by it, in as many buckets as
    a shuffle has partitions, so joins, groups and windows on the key need no exchange. A key with many rows makes a large
    bucket: meant for tables with few rows a key. end() drops the tables and their files, all or all but those named in `but`.
    """

    spark: SparkSession
    written: dict[str, list[str]] = field(default_factory=dict)

    def __call__(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        at = work_folder(self.spark)
        database = f"stakescope_{hashlib.md5(at.encode()).hexdigest()[:12]}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{at}/{database}'")
        table = f"{database}.{re.sub('[^a-z0-9]', '_', name.lower())}_{uuid.uuid4().hex}"
        if by is None:
            df.write.format("parquet").saveAsTable(table)
        else:
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            df.repartition(n, by).write.format("parquet").bucketBy(n, by).sortBy(by).saveAsTable(table)
        self.written.setdefault(name, []).append(table)
        return self.spark.table(table)

    def end(self, but: tuple[str, ...] = ()) -> None:
        for name in [n for n in self.written if n not in but]:
            for table in self.written.pop(name):
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.end()


def kept(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """A table of a workspace that stays, for results that are read later."""
    return Workspace(df.sparkSession)(df, name, by)


def long_rows(spark: SparkSession) -> None:
    """For results with rows of megabytes: Parquet writers of this session look at the size of what they hold from the first row on, not after 100. Values that are set stay."""
    for name in ("parquet.page.size.row.check.min", "parquet.block.size.row.check.min"):
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, "1")


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the six flat tables by name, with its declared schema."""
    if name not in schemas.TABLES:
        raise ConfigError(f"unknown table {name!r}; known: {', '.join(sorted(schemas.TABLES))}")
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{folder}/{name}")


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """All tables, replaced."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def read_documents(spark: SparkSession, location: str, schema: T.StructType, kind: str = "json") -> DataFrame:
    """Raw documents with a declared schema: JSON lines or Parquet, or a catalog table (kind "table"), or a document store by connector.

    A configured location is required; a catalog view is an error, since the reader must see stored documents.
    """
    if not location:
        raise ConfigError("no location is set")
    if kind == "table":
        if not spark.catalog.tableExists(location):
            raise ContractError(f"missing table {location}")
        if spark.catalog.getTable(location).tableType in ("VIEW", "TEMPORARY"):
            raise ContractError(f"{location} is a view")
        return spark.table(location)
    if kind == "mongodb":
        return spark.read.format("mongodb").schema(schema).option("collection", location).load()
    if not exists(spark, location):
        raise ContractError(f"missing documents at {location}")
    return spark.read.schema(schema).format(kind).load(location)


def find(df: DataFrame, predicate: Column | None = None, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Filter, projection and limit, which the source can take over."""
    if predicate is not None:
        df = df.where(predicate)
    if columns:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def sample(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def count_all(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of all tables in one job."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@dataclass(frozen=True)
class DocumentStore:
    """Read-only access to the collections of one source: folders below a location, tables of a database, or a document store.

    kind: json, parquet, table or mongodb (by its connector). collections: name to schema, those that a run may read.
    """

    spark: SparkSession
    location: str
    kind: str = "json"
    collections: dict[str, T.StructType] = field(default_factory=dict)
    timeout_ms: int = 5000

    def _place(self, name: str) -> str:
        if not self.location:
            raise ConfigError("no location is set")
        return f"{self.location}.{name}" if self.kind == "table" else name if self.kind == "mongodb" else f"{self.location.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        """A collection with its declared schema; one that is not declared, missing, or a view is an error."""
        if name not in self.collections:
            raise ConfigError(f"collection {name!r} is not configured; known: {', '.join(sorted(self.collections))}")
        if self.kind == "mongodb":
            return self._asked(name, self.collections[name])
        return read_documents(self.spark, self._place(name), self.collections[name], self.kind)

    def _asked(self, name: str, schema: T.StructType) -> DataFrame:
        reader = self.spark.read.format("mongodb").schema(schema).option("connection.uri", self.location).option("collection", name)
        return reader.option("serverSelectionTimeoutMS", str(self.timeout_ms)).option("connectTimeoutMS", str(self.timeout_ms)).load()

    def ping(self) -> bool:
        """Whether the source answers, whatever collections are declared; one that is away, or has no connector here, does not."""
        if self.kind == "table":
            return self.spark.catalog.databaseExists(self.location)
        if self.kind == "mongodb":
            try:  # a collection that is not there is empty, if the server answers at all
                return bool(self.location) and self._asked(next(iter(self.collections), "ping"), T.StructType([T.StructField("_id", T.StringType())])).limit(1).count() >= 0
            except (PySparkException, Py4JJavaError):
                return False
        return bool(self.location) and exists(self.spark, self.location)

    def names(self) -> list[str]:
        """The collections that are there, declared or not, sorted; a connector without a list of its own is asked for the declared ones."""
        if self.kind == "table":
            return sorted(t.name for t in self.spark.catalog.listTables(self.location) if t.tableType not in ("VIEW", "TEMPORARY"))
        if self.kind == "mongodb":
            return sorted(n for n, schema in self.collections.items() if not self._asked(n, schema).limit(1).isEmpty())
        if not self.ping():
            return []
        below = F.regexp_extract(F.col("path"), r"/([^/]+)/[^/]+$", 1)  # only names of files are read
        files = self.spark.read.format("binaryFile").load(f"{self.location.rstrip('/')}/*").select(below.alias("name"))
        return sorted(r[0] for r in files.distinct().collect())

    def count(self, name: str) -> int:
        return self.read(name).count()

    def counts(self) -> DataFrame:
        return count_all({name: self.read(name) for name in self.names() if name in self.collections})

    def sample(self, name: str, n: int = 5) -> DataFrame:
        return sample(self.read(name), n)

    def find(self, name: str, predicate: Column | None = None, columns: list[str] | None = None, limit: int | None = None) -> DataFrame:
        return find(self.read(name), predicate, columns, limit)
