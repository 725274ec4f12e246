"""Byte-level BPE encoding and decoding through one global shuffle of distinct words."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Vocabulary, column_tokens, gathered
from .shared import ROW, batches, block_id, n_parts, rows_of, sent, settled, spread, trimmed
from .textcore import bounds, distinct_spans, hash_spans, ids_back, ids_of, pack, pieces, unpack

#: Text bytes of a block, the unit whose words go out once and come back as ids.
BLOCK_BYTES = 2_000_000
WORDS, PLACES, IDS = 1, 0, 2


def _blocks(it, vocabulary, parts, what):
    """Rows of the exchange for each block: its distinct words by bucket (WORDS), or its texts as word numbers (PLACES).

    A word's number is rank * parts + bucket, its rank being by count inside the block's bucket: frequent words get
    small numbers, and the numbers need no table of their own.
    """
    sequence = 0
    for b in it:
        ids = b.column(0)
        for i, part, s, e, keys, first in column_tokens(b.column(1), vocabulary, BLOCK_BYTES):
            block, sequence = block_id(sequence), sequence + 1
            d, example, inverse, n = distinct_spans(part, s, e, keys)
            edge = bounds(d, parts)
            bucket = np.repeat(np.arange(parts), np.diff(edge))
            order = np.lexsort((-n, bucket))
            if what == PLACES:
                number = np.empty(len(d), np.int64)
                number[order] = (np.arange(len(d)) - edge[bucket]) * parts + bucket
                yield spread(block, parts), block, PLACES, pack(ids_of(ids.slice(i, len(first) - 1)), first, number[inverse], edge)
                continue
            at = example[order]
            length = e[at] - s[at]
            text, _ = gathered(part, e - s, at)
            ends = np.concatenate(([0], np.cumsum(length)))
            for p in np.flatnonzero(np.diff(edge)).tolist():
                x, y = edge[p], edge[p + 1]
                yield p, block, WORDS, pack(text[ends[x] : ends[y]], length[x:y])


def _encode_bucket(rows, vocabulary, parts):
    """Each distinct word of the bucket encoded once; ids go back to the blocks that asked."""
    blocks, texts, lengths = [], [], []
    bucket = 0
    for to, block, _, body in rows:
        text, length = unpack(body.as_py())
        blocks.append(block)
        texts.append(text)
        lengths.append(length.astype(np.int64))
        bucket = to
    if not blocks:
        return
    data, length = np.concatenate(texts), np.concatenate(lengths)
    ends = np.cumsum(length)
    starts = ends - length
    keys = np.empty(len(ends), np.uint64)
    offsets = np.concatenate(([0], ends))
    for i, j in pieces(offsets):
        keys[i:j] = hash_spans(data[offsets[i] : offsets[j]], starts[i:j] - offsets[i], ends[i:j] - offsets[i])
    _, example, inverse, _ = distinct_spans(data, starts, ends, keys)
    coded = [vocabulary.encode_word(data[a:b].tobytes()) for a, b in zip(starts[example].tolist(), ends[example].tolist(), strict=True)]
    n = np.array([len(c) for c in coded], np.int64)
    values = np.fromiter((x for c in coded for x in c), np.int64, int(n.sum()))
    at = 0
    for block, own in zip(blocks, lengths, strict=True):
        which = inverse[at : at + len(own)]
        at += len(own)
        got, many = gathered(values, n, which)
        yield spread(block, parts), block, IDS, pack(np.array([bucket]), got, many)


def _assemble(rows):
    """Texts of each block put together again by position."""
    blocks: dict[int, tuple[list, list]] = {}
    for _, block, tag, body in rows:
        blocks.setdefault(block, ([], []))[tag != PLACES].append(body.as_py())
    for places, answers in blocks.values():
        if len(places) != 1:
            raise RuntimeError("texts and words of a block come from different inputs; store the input first")
        doc, first, number, edge = (x.astype(np.int64) for x in unpack(places[0]))
        parts = len(edge) - 1
        got = sorted(((int(a[0][0]), a[1], a[2].astype(np.int64)) for a in map(unpack, answers)), key=lambda a: a[0])
        if [len(m) for _, _, m in got] != [x for x in np.diff(edge).tolist() if x]:
            raise RuntimeError("texts and words of a block come from different inputs; store the input first")
        values = np.concatenate([v.astype(np.int32) for _, v, _ in got]) if got else np.zeros(0, np.int32)
        many = np.concatenate([m for *_, m in got]) if got else np.zeros(0, np.int64)
        ids, n = gathered(values, many, edge[number % parts] + number // parts)
        ends = np.concatenate(([0], np.cumsum(n)))[first]
        yield pa.RecordBatch.from_arrays([ids_back(doc), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32()))], names=["id", "ids"])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", each: tuple[Callable, str] | None = None, fixed: bool = False) -> DataFrame:
    """(id, ids array<int>) of every whole text, by the ranks of the vocabulary file, without special tokens.

    each: a function of Arrow batches (id, ids) that is applied in the task that assembles them, and its result's columns.
    fixed: docs gives the same partitions on every pass, as tables read from files do; otherwise it is stored first.

    Pre-tokens keep their positions in blocks; each block sends each of its distinct words once, each bucket of words
    encodes each distinct word once, and ids come back to the blocks. A word that stands everywhere reaches its bucket
    once from each block. Null and empty texts have no ids. Ids of rows must be integers (null stays null); repeated rows
    stay; an empty table gives an empty result; other columns go.
    """
    vocabulary = Vocabulary.read(path, pattern)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    source = settled(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), fixed)
    parts = n_parts(source)
    words = source.mapInArrow(lambda it: batches(_blocks(it, shared.value, parts, WORDS)), ROW)
    places = source.mapInArrow(lambda it: batches(_blocks(it, shared.value, parts, PLACES)), ROW)
    ids = sent(words, parts, lambda it: batches(_encode_bucket(rows_of(it), shared.value, parts)))
    change, schema = each or ((lambda b: b), "id long, ids array<int>")
    out = sent(places.unionByName(ids), parts, lambda it: trimmed(map(change, _assemble(rows_of(it)))), schema)
    return out.withColumnRenamed("id", id_col)


def decoded_batch(b: pa.RecordBatch, data: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """(id, ids) with the bytes of the ids, joined from the token-byte table."""
    lists = b.column(1)
    first = lists.offsets.to_numpy().astype(np.int64)
    ids = lists.values.to_numpy(zero_copy_only=False)[first[0] : first[-1]]
    out, n = gathered(data, np.diff(starts), ids)
    ends = np.concatenate(([0], np.cumsum(n)))[first - first[0]]
    raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())])
    return pa.RecordBatch.from_arrays([b.column(0), lists, raw.cast(pa.binary())], names=["id", "ids", "data"])


def digest_batch(b: pa.RecordBatch) -> pa.RecordBatch:
    """n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers) and decoded_sha256 of (id, ids, data)."""
    lists = b.column(1)
    first = lists.offsets.to_numpy().astype(np.int64)
    raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
    sums = [hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(first), pa.int64()), pa.array(sums, pa.string()), pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in b.column(2)], pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, data binary): the bytes of each row's ids, through the token-byte table (bounded by the vocabulary); null ids count as none."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(path, pattern).token_bytes())
    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(lambda it: (decoded_batch(b, *shared.value) for b in it), "id long, ids array<int>, data binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", fixed: bool = False) -> DataFrame:
    """Digests of every text's ids and of the bytes decoded from them, made in the task that assembles the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.read(path, pattern).token_bytes())
    each = (lambda b: digest_batch(decoded_batch(b, *shared.value))), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode(docs, path, pattern, id_col, text_col, each, fixed)
