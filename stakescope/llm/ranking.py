"""Gapless ranks within keys of any size, without bringing a key's rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: list[str], order: list[str], buckets: int, name: str = "rank") -> DataFrame:
    """df with ranks 0, 1, ... inside each key.

    Rows of a key are spread over hash buckets of the order columns (which must be unique inside a key);
    ranks inside a bucket come from a window over that bucket, and a running sum of bucket counts
    (at most `buckets` rows for a key) shifts them.
    """
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    inside = df.withColumn("_in", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order)))
    counts = df.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shift = counts.select(*keys, "_bucket", (F.sum("_n").over(running) - F.col("_n")).alias("_shift"))
    out = inside.join(shift, [*keys, "_bucket"])
    return out.withColumn(name, F.col("_shift") + F.col("_in") - 1).drop("_bucket", "_in", "_shift")
