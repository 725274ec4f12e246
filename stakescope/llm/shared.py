"""The folder that driver and executors share, tables written there, and the block exchange."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of the exchange: the partition they go to, the block they belong to, what they are, and packed arrays.
ROW = "to int, block long, tag int, body binary"
_ARROW = pa.schema([("to", pa.int32()), ("block", pa.int64()), ("tag", pa.int32()), ("body", pa.binary())])


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Only a session on one machine may have none; a folder is made for it then."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="stakescope-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stored(df: DataFrame, name: str, by: str | None = None, free: bool = False) -> DataFrame:
    """df written to the shared folder and read again: cuts the lineage, survives lost executors.

    by: a column that gets a folder for each value. free: let go of the shuffle files of what has been written, which is
    worth a pause after exchanges of whole texts.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    out._stored_at = path
    if free:
        release(df.sparkSession)
    return out


def settled(df: DataFrame, fixed: bool) -> DataFrame:
    """df if it is fixed (every pass over it sees the same partitions), else stored."""
    return df if fixed else stored(df, "settled")


def dropped(df: DataFrame, part: str = "") -> None:
    """Empties a table written by stored() (or one of its folders), once nothing reads it any more."""
    spark, path = df.sparkSession, df._stored_at
    spark.createDataFrame([], "gone int").write.mode("overwrite").parquet(f"{path}/{part}" if part else path)


def release(spark: SparkSession) -> None:
    """Shuffle files of finished plans go when the driver's garbage is collected; where the driver is elsewhere, it does so in its own time.

    Plans that have just ended are still held for a moment by events on their way to listeners, hence the pauses; the last
    event is held until another comes, hence a query of one row.
    """
    spark.range(1).collect()
    gc.collect()
    if (jvm := getattr(spark, "_jvm", None)) is not None:
        time.sleep(0.2)
        jvm.System.gc()
        time.sleep(0.2)


def n_parts(df: DataFrame) -> int:
    """Partitions for an exchange over df: at least the session's, and as many as the input's splits, so that it grows with the data."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


def batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW, strict=True)], schema=_ARROW)


def batches(rows: Iterator[tuple[int, int, int, bytes]], limit: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[3]) + 32
        if size > limit:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)
    trim()


def trim() -> None:
    """Memory that a task has freed goes back to the system, so that workers which wait for their next task hold little."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than the one that has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def trimmed(it: Iterator) -> Iterator:
    """What `it` gives; then the memory of the task goes back."""
    yield from it
    trim()


def rows_of(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    for b in it:
        yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True)


def sent(df: DataFrame, parts: int, fn: Callable, schema: str = ROW) -> DataFrame:
    """Rows go to the partition they name; fn (an Arrow iterator) then sees all rows of its partition."""
    return df.repartitionById(parts, F.col("to")).mapInArrow(fn, schema)


def spread(block: int, parts: int) -> int:
    """The partition of a block; a multiplier keeps the blocks of one task apart."""
    return int((block * 0x9E3779B97F4A7C15 % (1 << 64)) * parts >> 64)


def block_id(sequence: int) -> int:
    """A number of its own for each block of a task: the partition and the block's place in it."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return ((context.partitionId() if context else 0) << 24) + sequence


def crc32_text(column: str):
    """crc32 of an integer column written as text, as a Spark column."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def empty_int() -> np.ndarray:
    return np.zeros(0, np.int64)
