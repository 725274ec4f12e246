"""Best-fit packing of token pieces, after Martello and Toth's dominance reduction."""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Encoder, Vocabulary, column_tokens
from .ranking import ranked
from .shared import n_parts, stored
from .textcore import NULL_ID, ids_of

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack_plan(histogram: Iterable[tuple[int, int]], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int, int]:
    """How pieces of each length are placed: rows (length, first rank, ranks, first bin, offset), all bins, and bins that dominance fixed.

    Row meaning: pieces with ranks first .. first + ranks - 1 of that length go to bins first bin, first bin + 1, ... at that offset.
    Everything works on counts of equal lengths, so time and memory follow the capacity, not the number of pieces.

    Dominance: a set with an item j that is at least as good as any other set with j is fixed for good:
    j alone if nothing fits beside it; j with the largest k that fits if j + k fills the bin, if no two items fit beside j,
    or if no three fit and k weighs at least as much as the best two. What is left is packed best-fit decreasing.
    """
    count = np.zeros(capacity + 1, np.int64)
    for length, n in histogram:
        count[length] += n
    taken = np.zeros(capacity + 1, np.int64)
    plan: list[tuple[int, int, int, int, int]] = []
    bins = 0

    def put(length: int, n: int, first_bin: int, offset: int) -> None:
        plan.append((length, int(taken[length]), n, first_bin, offset))
        taken[length] += n
        count[length] -= n

    def smallest(without: int, k: int) -> int:
        """Sum of the k smallest items left besides one of size `without`; more than the capacity if there are fewer."""
        total = 0
        for s in np.flatnonzero(count).tolist():
            n = int(count[s]) - (s == without)
            use = min(n, k)
            total, k = total + use * s, k - use
            if not k:
                return total
        return capacity + 1

    def best_pair(room: int, without: int) -> int:
        """The largest weight of two items within room, besides one of size `without`; 0 if none fits."""
        sizes = [s for s in np.flatnonzero(count).tolist() if count[s] - (s == without) > 0]
        i, j, best = 0, len(sizes) - 1, 0
        while i <= j:
            total = sizes[i] + sizes[j]
            if total > room:
                j -= 1
                continue
            if i != j or count[sizes[i]] - (sizes[i] == without) > 1:
                best = max(best, total)
            i += 1
        return best

    changed = True
    while changed:
        changed = False
        for j in range(capacity, 0, -1):
            while count[j]:
                room = capacity - j
                fits = np.flatnonzero(count[: room + 1])
                if len(fits) and fits[-1] == j and count[j] == 1:
                    fits = fits[:-1]
                if not len(fits):
                    n = int(count[j]) if 2 * j > capacity else 1
                    put(j, n, bins, 0)
                else:
                    k = int(fits[-1])
                    if not (j + k == capacity or smallest(j, 2) > room or smallest(j, 3) > room and k >= best_pair(room, j)):
                        break
                    n = int(count[j]) // 2 if j == k else int(min(count[j], count[k]))
                    put(j, n, bins, 0)
                    put(k, n, bins, j)
                bins += n
                changed = True
    fixed = bins
    open_bins: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges of bins
    for s in range(capacity, 0, -1):
        rooms = sorted(r for r in open_bins if r >= s)
        at = 0
        while count[s]:
            while at < len(rooms) and not open_bins.get(rooms[at]):
                at += 1
            if at < len(rooms):
                room = rooms[at]
                first, many = open_bins[room].pop()
                n = int(min(many, count[s]))
                put(s, n, first, capacity - room)
                if many > n:
                    open_bins[room].append((first + n, many - n))
                if room - s:
                    open_bins.setdefault(room - s, []).append((first, n))
                    if room - s >= s:
                        rooms = sorted(r for r in open_bins if r >= s)
                        at = 0
                continue
            each = capacity // s
            full, rest = divmod(int(count[s]), each)
            for many, items in ((full, each), (1, rest)):
                if many and items:
                    for k in range(items):
                        put(s, many, bins, k * s)
                    if capacity - items * s:
                        open_bins.setdefault(capacity - items * s, []).append((bins, many))
                    bins += many
    return plan, bins, fixed


def token_pieces(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of every document: its ids and the end id, cut only if longer than a sequence; the first piece takes the remainder.

    Null texts count as empty: one piece holding the end id alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path, pattern))

    def cut(it):
        encoder = Encoder(shared.value)
        for b in it:
            doc = ids_of(b.column(0))
            rows: list[tuple[int, int, int, int, int]] = []
            for i, part, s, e, keys, first in column_tokens(b.column(1), encoder.vocabulary):
                ids, n = encoder.ids(part, s, e, keys)
                ends = np.concatenate(([0], np.cumsum(n)))[first].tolist()
                for k, (x, y) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                    own = np.append(ids[x:y], np.array([end_id], "<u4")).astype("<u4")
                    start, length = 0, (len(own) - 1) % capacity + 1
                    for piece in range(-(-len(own) // capacity)):
                        rows.append((None if doc[i + k] == NULL_ID else int(doc[i + k]), piece, start, length, zlib.crc32(own[start : start + length])))
                        start, length = start + length, capacity
            cols = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, path: str, pattern: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """All pieces of docs with the sequence that each goes to and its offset there, in few sequences.

    The driver sees the histogram of piece lengths (at most `capacity` rows) and makes a plan of ranges of ranks; pieces are
    ranked within their length in a distributed way, and join the plan. Documents with the same id are told apart by content;
    repeated rows are documents of their own. An empty table gives an empty result; other columns go.
    """
    pieces = stored(token_pieces(docs, path, pattern, capacity, end_id), "pieces")
    histogram = [(r[0], r[1]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()]
    rows, _, _ = pack_plan(histogram, capacity)
    plan = docs.sparkSession.createDataFrame(rows, "length long, _first long, _many long, _bin long, offset long")
    if len(rows) <= 200_000:
        plan = F.broadcast(plan)
    placed = ranked(pieces, ["length"], ["doc_id", "piece", "ids_crc32", "start"], n_parts(pieces), "_rank").alias("p")
    inside = (F.col("p.length") == F.col("q.length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_many"))
    return placed.join(plan.alias("q"), inside).select("doc_id", "piece", "start", F.col("p.length").alias("length"), "ids_crc32", (F.col("_bin") + F.col("_rank") - F.col("_first")).alias("sequence_id"), "offset")
