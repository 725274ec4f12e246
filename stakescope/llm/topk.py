"""Exact top-k inner-product search with block-at-a-time pruning over reordered document ranges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import ROW, batches, n_parts, rows_of, sent
from .textcore import pack, unpack
from .vectors import finite, matrix, query_set, stacked, top, widened

#: Vectors of a document-range block, of a group of blocks (what a task holds), and about as many queries of a query block.
BLOCK_ROWS, GROUP_ROWS, QUERY_ROWS = 64, 131_072, 65_536
#: Queries that a task works on at a time, random planes of the space-filling order, terms that share one norm in a bound.
CHUNK, PLANES, TERMS = 1024, 16, 8
#: Blocks of a query, best bounds first, that are scored before its threshold is looked at again.
TIERS = (4, 32, 256)
BLOCK, QUERY = 0, 1
_NONE = -(2**63)


def _packed(*columns) -> bytes:
    *ids, m = columns
    return pack(*(i.astype(np.int64).view(np.uint64) for i in ids), m.astype(np.int64).reshape(-1).view(np.uint64), np.array([m.shape[1]]))


def _opened(body) -> list[np.ndarray]:
    *ids, values, width = unpack(body.as_py())
    ids = [i.astype(np.uint64).view(np.int64) for i in ids]
    return [*ids, values.astype(np.uint64).view(np.int64).reshape(len(ids[0]), int(width[0]))]


class Index:
    """Blocks of vectors (their forward indexes) with what bounds their scores."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray]], width: int) -> None:
        self.blocks = [(i, widened(m, width)) for i, m in blocks]
        ms = [m for _, m in self.blocks]
        self.largest = max([1.0, *(float(np.abs(m).max(initial=0)) for m in ms)])
        self.high, self.low = np.array([m.max(axis=0) for m in ms]), np.array([m.min(axis=0) for m in ms])
        self.first = np.array([i.min() for i, _ in self.blocks])
        self.centre = np.array([m.mean(axis=0) for m in ms])
        self.cuts = np.arange(0, max(1, width), TERMS)
        self.radius = np.array([np.sqrt(self._norms(m - c).max(axis=0)) for m, c in zip(ms, self.centre, strict=True)])

    def _norms(self, m: np.ndarray) -> np.ndarray:
        """Squares of the norms of each group of terms."""
        m = m.astype(np.float64)
        return np.add.reduceat(m * m, self.cuts, axis=1) if m.shape[1] else np.zeros((len(m), 1))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """At least the best score of each block: by summed term maxima, and by the centre and the norms of groups of terms around it."""
        q = q.astype(np.float64)
        terms = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
        norms = q @ self.centre.T + np.sqrt(self._norms(q)) @ self.radius.T
        slack = 1e-9 * float(np.abs(q).max(initial=0)) * self.largest * max(1, q.shape[1])  # far above what rounding can lose
        return np.minimum(terms, norms) + slack


def search(index: Index, qid: np.ndarray, q: np.ndarray, floor: np.ndarray, floor_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query ids, vec ids, scores) of each query's k best that are no worse than its floor, its own id left out; and how many blocks were scored.

    Each query's blocks are taken in the order of their bounds, in tiers; after each tier its threshold is the k-th best so
    far (score, then id), and blocks whose bound is below it, or that can only tie with larger ids, are left out. The floor
    is a threshold that the query brings along: a score and id of which k candidates anywhere are no worse.
    """
    found, scored = ([], [], []), 0
    kind = np.float64 if index.largest * max(1.0, float(np.abs(q).max(initial=0))) * max(1, q.shape[1]) < 2**52 else np.int64  # sums are whole and exact in either
    forward = [m.astype(kind) for _, m in index.blocks]
    for start in range(0, len(qid), CHUNK):
        own, qk = qid[start : start + CHUNK], q[start : start + CHUNK].astype(kind)
        kth, kth_id = floor[start : start + CHUNK].copy(), floor_id[start : start + CHUNK].copy()
        bound = index.bounds(q[start : start + CHUNK])
        best = (np.zeros(0, np.int64),) * 3
        done = np.zeros(bound.shape, bool)
        for tier in (*TIERS, bound.shape[1]):
            far = kth.astype(np.float64)[:, None]
            go = ~done & ((bound > far) | ((bound >= far) & (index.first[None, :] <= kth_id[:, None])))
            if tier < bound.shape[1]:
                near = np.argpartition(np.where(go, -bound, np.inf), tier - 1, axis=1)[:, :tier]
                some = np.zeros(bound.shape, bool)
                np.put_along_axis(some, near, True, axis=1)
                go &= some
            if not go.any():
                break
            done |= go
            scored += int(go.sum())
            fresh = ([best[0]], [best[1]], [best[2]])
            for b in np.flatnonzero(go.any(axis=0)).tolist():
                rows = np.flatnonzero(go[:, b])
                ids = index.blocks[b][0]
                s = (qk[rows] @ forward[b].T).astype(np.int64)
                r, c = np.nonzero(s >= kth[rows][:, None])
                hit, vec, score = rows[r], ids[c], s[r, c]
                use = (own[hit] != vec) & ((score > kth[hit]) | (vec <= kth_id[hit]))
                for to, x in zip(fresh, (hit[use], vec[use], score[use]), strict=True):
                    to.append(x)
            cat = [np.concatenate(x) for x in fresh]
            keep = top(cat[0], cat[2], cat[1], k)
            best = tuple(x[keep] for x in cat)
            n = np.bincount(best[0], minlength=len(own))
            last = (np.cumsum(n) - 1)[n >= k]
            kth[n >= k], kth_id[n >= k] = best[2][last], best[1][last]
        for to, x in zip(found, (own[best[0]], best[1], best[2]), strict=True):
            to.append(x)
    return *(np.concatenate([*x, np.zeros(0, np.int64)]) for x in found), scored


def blocks_of(ids: np.ndarray, m: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(ids[i : i + BLOCK_ROWS], m[i : i + BLOCK_ROWS]) for i in range(0, len(ids), BLOCK_ROWS)]


def places(m: np.ndarray) -> np.ndarray:
    """A space-filling order: cells between random planes, numbered so that neighbours differ by one plane; then along one more direction."""
    planes = np.random.default_rng(m.shape[1]).standard_normal((m.shape[1], PLANES + 1))
    s = m.astype(np.float64) @ planes
    gray = (s[:, :PLANES] > 0) @ (np.int64(1) << np.arange(PLANES, dtype=np.int64))
    number = gray.copy()
    for shift in (1, 2, 4, 8):
        number ^= number >> shift
    return number + 0.5 + np.arctan(s[:, PLANES] / (1.0 + np.abs(s[:, PLANES]).mean() if len(s) else 1.0)) / np.pi


def exact_top_k(rows: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's k best rows by the integer inner product of floor(64 * component): query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by `every`, once for each id (the smallest vector, if an id has several);
    every row with another id is a candidate. Vectors that are null or hold null or non-finite components take no part, nor
    do rows without an id; vectors of other lengths count as padded with zeros. Repeated rows are candidates of their own;
    an empty table gives an empty result; other columns go.

    Rows are ordered along a space-filling curve and dealt to groups of GROUP_ROWS; a task cuts its group into blocks and
    gives its own queries a first threshold. Then query blocks meet groups in cells, which prune with it. What is sent
    grows as the rows times the query blocks plus the queries times the groups, both of which are as large as a task can hold.
    """
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * 64).cast("long"))
    rows = rows.where(F.col(id_col).isNotNull() & finite(vector_col)).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))
    n, parts = rows.count(), n_parts(rows)
    groups = max(1, -(-n // GROUP_ROWS), min(parts, n // (8 * BLOCK_ROWS)))
    n_blocks = min(groups, max(1, -(-n // (every * QUERY_ROWS))))
    both = rows.select("vec_id", "v", F.lit(False).alias("asks")).unionByName(query_set(rows, every).select("vec_id", "v", F.lit(True).alias("asks")))

    def cell(group: int, block: int) -> int:
        return (group * n_blocks + block) % parts

    def placed(it):
        for b in it:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(places(matrix(b.column(1))), pa.float64())], names=["vec_id", "v", "asks", "place"])

    def dealt(it):
        from pyspark import TaskContext

        group = TaskContext.get().partitionId() % groups
        ids, ms, asks = [], [], []
        for b in it:
            ids.append(b.column(0).to_numpy())
            ms.append(_narrow(matrix(b.column(1))))
            asks.append(b.column(2).to_numpy(zero_copy_only=False).astype(bool))
        if not ids:
            return
        ids, m, asks = np.concatenate(ids), stacked(ms), np.concatenate(asks)
        qid, q, ids, m = ids[asks], m[asks], ids[~asks], m[~asks]
        for i in range(0, len(ids), 4096):
            body = _packed(ids[i : i + 4096], m[i : i + 4096])
            for block in range(n_blocks):
                yield cell(group, block), group * n_blocks + block, BLOCK, body
        if not len(qid):
            return
        floor, floor_id = np.full(len(qid), _NONE), np.full(len(qid), _NONE)
        if len(ids):
            who, vec, score, _ = search(Index(blocks_of(ids, m), m.shape[1]), np.arange(len(qid)) + _NONE, q, floor, floor_id, k + 1)
            seen = who - _NONE
            use = vec != qid[seen]
            seen, vec, score = seen[use], vec[use], score[use]
            count = np.bincount(seen, minlength=len(qid))
            kth = (np.cumsum(count) - count + k - 1)[count >= k]
            floor[count >= k], floor_id[count >= k] = score[kth], vec[kth]
        block = group * n_blocks // groups
        for i in range(0, len(qid), 4096):
            part = slice(i, i + 4096)
            body = _packed(qid[part], floor[part], floor_id[part], q[part])
            for other in range(groups):
                yield cell(other, block), other * n_blocks + block, QUERY, body

    def searched(it):
        cells: dict[int, tuple[list, list]] = {}
        for _, at, tag, body in rows_of(it):
            cells.setdefault(at, ([], []))[tag].append(body)
        for at in list(cells):
            came, asked = cells.pop(at)
            if came and asked:
                blocks = [_opened(x) for x in came]
                qid, floor, floor_id = (np.concatenate(x) for x in zip(*(x[:3] for x in map(_opened, asked)), strict=True))
                q = stacked([_opened(x)[3] for x in asked])
                width = max([q.shape[1], *(m.shape[1] for _, m in blocks)])
                index = Index([x for ids, m in blocks for x in blocks_of(ids, m)], width)
                found = search(index, qid, widened(q, width), floor, floor_id, k)[:3]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["query_id", "vec_id", "score"])

    ordered = both.mapInArrow(placed, "vec_id long, v array<long>, asks boolean, place double").repartitionByRange(groups, "place", "vec_id").sortWithinPartitions("place", "vec_id")
    found = sent(ordered.mapInArrow(lambda it: batches(dealt(it)), ROW), parts, searched, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _narrow(m: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest of three types that holds them."""
    top_ = float(np.abs(m.astype(np.float64)).max(initial=0))
    return m.astype(np.int16 if top_ < 2**15 else np.int32 if top_ < 2**31 else np.int64)
