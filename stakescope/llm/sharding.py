"""Sharding: groups that must stay together go, largest first, to the least-loaded shard (LPT with a heap)."""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranking import ranked
from .shared import dropped, n_parts, shared_dir, stored

#: A plan of at most so many rows is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000


def lpt(histogram: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """(size, shards, running counts) for each (size, number of groups) in descending order of size.

    Equal sizes are placed together: a few by the heap one by one, many by the water level that the same
    greedy choice reaches, so the work follows the number of distinct sizes, not of groups.
    """
    loads = [0] * shards
    for size, count in histogram:
        got = [0] * shards
        left = count
        if count > 4 * shards and size > 0:
            low, high = min(loads), max(loads) + size * (count + 1)

            def below(level, size=size):
                return sum(max(0, -(-(level - x) // size)) for x in loads)

            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if below(mid) <= count else (low, mid)
            got = [max(0, -(-(low - x) // size)) for x in loads]
            left = count - sum(got)
        heap = [(x + size * g, s) for s, (x, g) in enumerate(zip(loads, got, strict=True))]
        heapq.heapify(heap)
        for _ in range(left):
            load, s = heap[0]
            got[s] += 1
            heapq.heapreplace(heap, (load + size, s))
        used = [s for s in range(shards) if got[s]]
        for s in used:
            loads[s] += size * got[s]
        upto, total = [], 0
        for s in used:
            total += got[s]
            upto.append(total)
        yield size, used, upto


def planned(spark: SparkSession, rows: Iterator[tuple], at_once: int = BROADCAST_ROWS) -> DataFrame:
    """The plan as a table. It is written in pieces as it is made, so the driver never holds more than one; a plan of one piece is broadcast."""
    schema = "_total long, _shards array<int>, _upto array<long>"
    piece = list(islice(rows, at_once))
    if len(piece) < at_once:
        return F.broadcast(spark.createDataFrame(piece, schema))
    path = f"{shared_dir(spark)}/shard-plan-{uuid.uuid4().hex}"
    while piece:
        spark.createDataFrame(piece, schema).write.mode("append").parquet(path)
        piece = list(islice(rows, at_once))
    return spark.read.schema(schema).parquet(path)


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """Every row with its shard and a gapless slot in it; equal texts share a shard, shards are near equal in bytes.

    Size of a row: UTF-8 bytes of its text (null: none, and the same group as the empty text) plus `overhead`.
    The driver sees only the histogram of group sizes, one row for each distinct size, in a stream, and writes the plan in
    pieces: k distinct sizes add up to at least k*k/2 bytes, so there are at most the square root of twice the input.
    An empty table gives an empty result; repeated rows are rows of their own, ordered by id and then by content.
    Columns: the id, size, text_crc32, shard, slot.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("_text")
        ),
        "shard-rows",
    )
    buckets = n_parts(rows)
    groups = stored(rows.groupBy("_text").agg(F.sum("size").alias("_total")), "shard-groups")
    histogram = ((r[0], r[1]) for r in groups.groupBy("_total").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("_total")).toLocalIterator())
    plan = planned(docs.sparkSession, lpt(histogram, shards))
    shard = F.element_at("_shards", F.size(F.filter("_upto", lambda u: u <= F.col("_rank"))) + 1)
    where = ranked(groups, ["_total"], ["_text"], buckets, "_rank").join(plan, "_total").select("_text", shard.alias("shard"))
    out = stored(rows.join(where, "_text").select(id_col, "size", "text_crc32", "shard"), "shard-of")
    dropped(groups)
    return ranked(out, ["shard"], [id_col, "text_crc32", "size"], buckets, "slot")
