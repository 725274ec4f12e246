"""Whole texts in blocks: the unit that asks the exchange and gets its answers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .shared import block_id, spread
from .textcore import ids_of, string_buffers, word_spans

BLOCK_BYTES = 2_000_000
TEXT, ASK, ANSWER = 0, 1, 2


def text_blocks(it, id_at: int, text_at: int, size: int = BLOCK_BYTES):
    """(block, rows, document ids, bytes, word starts, word ends, first word of each document) of each block."""
    sequence = 0
    for b in it:
        data, offsets = string_buffers(b.column(text_at))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
            part = data[offsets[i] : offsets[j]]
            s, e, first = word_spans(part, offsets[i : j + 1] - offsets[i])
            rows = b.slice(i, j - i)
            yield block_id(sequence), rows, ids_of(rows.column(id_at)), part, s, e, first
            sequence, i = sequence + 1, j


def text_rows(it, id_at, text_at, parts, size: int = BLOCK_BYTES):
    """The rows of each block, whole, as compressed Arrow."""
    for block, rows, *_ in text_blocks(it, id_at, text_at, size):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(rows)
        yield spread(block, parts), block, TEXT, sink.getvalue().to_pybytes()


def opened(body: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(body).read_next_batch()


def by_block(rows) -> dict[int, dict[int, list[bytes]]]:
    """What has come for each block of this partition, by tag; every block needs its texts."""
    blocks: dict[int, dict[int, list]] = {}
    for _, block, tag, body in rows:
        blocks.setdefault(block, {}).setdefault(tag, []).append(body.as_py())
    if any(len(x.get(TEXT, ())) != 1 for x in blocks.values()):
        raise RuntimeError("texts and answers of a block come from different inputs; store the input first")
    return blocks
