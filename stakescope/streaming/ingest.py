"""Micro-batch ingest: new raw documents are flattened and appended as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def ingest(spark: SparkSession, source: str, schema: T.StructType, flatten: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, kind: str = "json") -> StreamingQuery:
    """Reads what is there and not yet ingested, in batches; each batch is one overwrite-safe folder of the target.

    A batch that is repeated after a failure replaces its own folder, so every document lands once.
    """

    def write(batch: DataFrame, number: int) -> None:
        flatten(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).format(kind).load(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
