"""Substring dedup by recompression: names that depend only on content reveal long repeats, which are then verified.

A round names pairs of neighbouring symbols: each symbol falls on the left or the right side by a bit of its name, and a
left symbol followed by a right one becomes one symbol whose name is a function of both. Equal neighbours fall on the same
side, so a run stays a row of its symbol's own name. Names are 64-bit functions of content, hence the same in every
document and task: no round needs a shuffle to agree on them. The exchange then finds which high-level names stand in
several documents (reveal), and compares the windows around those by 96 bits of their words (verify).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ROW, batches, dropped, n_parts, rows_of, sent, settled, spread, stored, trimmed
from .textblocks import ANSWER, ASK, TEXT, by_block, opened, text_blocks, text_rows
from .textcore import U64, bounds, deltas, distinct, hash_spans, ids_of, mix, pack, string_buffers, undeltas, unpack, window_ok, windows, word_spans

ROUNDS = 2
_FAR = np.int64(1) << np.int64(40)


def symbols(h: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the symbols after the rounds, and the stretch [from, to) of words that alone determines each one.

    A stretch that would reach beyond its document is marked as endless, since another document may go on there.
    """
    name, own = h, doc
    low = np.arange(len(h), dtype=np.int64)
    high = low + 1
    for r in range(rounds):
        n = len(name)
        if n < 2:
            break
        right = (mix(name ^ U64(r + 1)) & U64(1)).astype(bool)
        same = own[1:] == own[:-1]
        merge = np.zeros(n, bool)  # with the next symbol
        merge[:-1] = ~right[:-1] & right[1:] & same
        gone = np.zeros(n, bool)
        gone[1:] = merge[:-1]
        after = np.full(n, _FAR)
        after[:-1] = np.where(same, high[1:], _FAR)
        before = np.full(n, -_FAR)
        before[1:] = np.where(same, low[:-1], -_FAR)
        new_low = np.where(right & ~gone, np.minimum(low, before), low)
        new_high = np.where(~right, np.maximum(high, after), high)
        pair = name.copy()
        pair[:-1][merge[:-1]] = mix(name[:-1][merge[:-1]] * U64(0x9E3779B97F4A7C15) + name[1:][merge[:-1]])
        keep = ~gone
        name, own, low, high = pair[keep], own[keep], new_low[keep], new_high[keep]
    return name, low, high


def anchors(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of n words inside one document: its anchor's name. Returns (window starts, names).

    The anchor is the smallest name among the symbols that the window's words alone determine, so equal windows have equal
    anchors wherever they stand; a window without such a symbol takes its smallest word.
    """
    total = len(h)
    ok = window_ok(first, n, total)
    if not ok.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    name, low, high = symbols(h, doc)
    best = np.full(total - n + 1, U64(2**64 - 1))
    fit = (high - low <= n) & (low >= 0) & (high <= total)
    name, low, high = name[fit], low[fit], high[fit]
    for j in range(n):
        at = low - j
        use = (at >= 0) & (at >= high - n) & (at < len(best))
        np.minimum.at(best, at[use], name[use])
    starts = np.flatnonzero(ok)
    best = best[starts]
    none = np.flatnonzero(best == U64(2**64 - 1))
    if len(none):
        best[none] = mix(np.lib.stride_tricks.sliding_window_view(h, n)[starts[none]].min(axis=1))
    return starts, best


def _least(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, place of each input among them, smallest and largest document of each."""
    d, inverse, n = distinct(keys)
    order = np.argsort(inverse, kind="stable")
    at = np.cumsum(n) - n
    return d, inverse, np.minimum.reduceat(docs[order], at) if len(d) else docs[:0], np.maximum.reduceat(docs[order], at) if len(d) else docs[:0]


def _block_anchors(doc, s, e, first, part, n):
    h = hash_spans(part, s, e)
    starts, name = anchors(h, first, n)
    owner = doc[np.searchsorted(first, starts, side="right") - 1]
    return h, starts, name, owner


def _ask_anchors(it, id_at, text_at, n, parts):
    for block, _, doc, part, s, e, first in text_blocks(it, id_at, text_at):
        _, _, name, owner = _block_anchors(doc, s, e, first, part, n)
        if not len(name):
            continue
        change = np.flatnonzero(np.concatenate(([True], (name[1:] != name[:-1]) | (owner[1:] != owner[:-1]))))
        d, _, low, high = _least(name[change], owner[change])
        edge, base = bounds(d, parts), int(low.min())
        for p in np.flatnonzero(np.diff(edge)).tolist():
            x, y = edge[p], edge[p + 1]
            yield p, block, ASK, pack(np.array([base], np.int64), deltas(d[x:y]), low[x:y] - base, high[x:y] > low[x:y])


def _answer_anchors(rows, parts):
    """For each anchor asked about: whether several documents have it."""
    asked = []
    bucket = 0
    for bucket, block, _, body in rows:
        base, d, low, many = unpack(body.as_py())
        asked.append((block, undeltas(d), low.astype(np.int64) + int(base[0]), many > 0))
    if not asked:
        return
    _, inverse, low, high = _least(np.concatenate([a[1] for a in asked]), np.concatenate([a[2] for a in asked]))
    shared = high > low
    several = np.concatenate([a[3] for a in asked])
    shared[inverse[several]] = True
    at = 0
    for block, keys, *_ in asked:
        yield spread(block, parts), block, ANSWER, pack(np.array([bucket]), np.packbits(shared[inverse[at : at + len(keys)]]), np.array([len(keys)]))
        at += len(keys)


def _words_of(batch, id_at, text_at):
    data, offsets = string_buffers(batch.column(text_at))
    s, e, first = word_spans(data, offsets)
    return ids_of(batch.column(id_at)), data, s, e, first


def _suspects(doc, s, e, first, data, shared, n):
    """Windows whose anchor several documents have: starts, owners, and two hashes of each."""
    h, starts, name, owner = _block_anchors(doc, s, e, first, data, n)
    if not len(starts):
        return starts, owner, name, name
    change = np.flatnonzero(np.concatenate(([True], (name[1:] != name[:-1]) | (owner[1:] != owner[:-1]))))
    d = distinct(name[change])[0]
    if len(d) != len(shared):
        raise RuntimeError("texts and answers of a block come from different inputs; store the input first")
    use = shared[np.searchsorted(d, name)]
    starts, owner = starts[use], owner[use]
    if not len(starts):
        return starts, owner, name[:0], name[:0]
    return starts, owner, windows(h, n)[starts], windows(hash_spans(data, s, e, 1), n, 1)[starts] >> U64(32)


def _pairs_least(one, two, docs):
    """Distinct (one, two) in order, place of each input, and smallest document of each."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    inverse = np.empty(len(a), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return a[at], b[at], inverse, np.minimum.reduceat(docs[order], at) if len(at) else docs[:0]


def _ask_windows(rows, id_at, text_at, n, parts):
    for block, came in by_block(rows).items():
        doc, data, s, e, first = _words_of(opened(came[TEXT][0]), id_at, text_at)
        _, owner, one, two = _suspects(doc, s, e, first, data, _bits(came.get(ANSWER, ())), n)
        if len(one):
            a, b, _, low = _pairs_least(one, two, owner)
            edge, base = bounds(a, parts), int(low.min())
            for p in np.flatnonzero(np.diff(edge)).tolist():
                x, y = edge[p], edge[p + 1]
                yield p, block, ASK, pack(np.array([base], np.int64), deltas(a[x:y]), b[x:y], low[x:y] - base)


def _answer_windows(rows, parts):
    """For each window asked about: whether a smaller document than the block's own smallest has it."""
    asked = []
    bucket = 0
    for bucket, block, _, body in rows:
        base, d, two, low = unpack(body.as_py())
        asked.append((block, undeltas(d), two, low.astype(np.int64) + int(base[0])))
    if not asked:
        return
    own = np.concatenate([a[3] for a in asked])
    _, _, inverse, low = _pairs_least(np.concatenate([a[1] for a in asked]), np.concatenate([a[2] for a in asked]), own)
    smaller = low[inverse] < own
    at = 0
    for block, keys, *_ in asked:
        yield spread(block, parts), block, ANSWER, pack(np.array([bucket]), np.packbits(smaller[at : at + len(keys)]), np.array([len(keys)]))
        at += len(keys)


def _bits(answers):
    got = sorted((unpack(a) for a in answers), key=lambda a: int(a[0][0]))
    return np.concatenate([np.unpackbits(b, count=int(k[0])).astype(bool) for _, b, k in got]) if got else np.zeros(0, bool)


def _removed(rows, id_at, text_at, n, names):
    for by_tag in by_block(rows).values():
        batch = opened(by_tag[TEXT][0])
        doc, data, s, e, first = _words_of(batch, id_at, text_at)
        starts, owner, one, two = _suspects(doc, s, e, first, data, _bits(by_tag.get(ANSWER, ())), n)
        cover = np.zeros(len(s) + 1, np.int64)
        if len(starts):
            _, _, inverse, low = _pairs_least(one, two, owner)
            found = starts[_bits(by_tag.get(ANSWER + 1, ()))[inverse] | (low[inverse] < owner)]
            np.add.at(cover, found, 1)
            np.add.at(cover, found + n, -1)
        keep = np.cumsum(cover[:-1]) == 0
        kept = np.flatnonzero(keep)
        place = np.searchsorted(kept, first)
        text, length = _with_blanks(data, s[kept], e[kept])
        ends = np.concatenate(([0], np.cumsum(length)))[place]
        many = np.diff(place)
        stops = np.maximum(ends[1:] - (many > 0), ends[:-1])
        out = [text[a:b].tobytes().decode(errors="replace") for a, b in zip(ends[:-1].tolist(), stops.tolist(), strict=True)]
        words = np.diff(first)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(words, pa.int64()), pa.array(words - many, pa.int64()), pa.array(out, pa.string())], names=[*names, "n_words", "n_removed", "kept"])


def _with_blanks(data, s, e):
    """The bytes of the spans, each followed by one blank, and their lengths with it."""
    n = e - s + 1
    total = int(n.sum())
    if not total:
        return data[:0], n
    ends = np.cumsum(n)
    out = np.append(data, np.uint8(0x20))[np.arange(total) + np.repeat(s - (ends - n), n)]
    out[ends - 1] = 0x20
    return out, n


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", fixed: bool = False) -> DataFrame:
    """docs with n_words, n_removed and kept (the words that stay, joined by one space).

    A word goes if it lies in a window of `window` words of its document whose words also start somewhere in a document
    with a smaller id. Windows are judged on the input. Null texts have no words; documents with the same id do not
    remove each other's words; columns named n_words, n_removed or kept are replaced. Ids must be integers; a null id counts
    as smaller than any other. fixed: docs gives the same partitions on every pass, as tables read from files do;
    otherwise it is stored first.

    Each window is sent to compare only if its anchor stands in several documents; a block sends a window once however
    many of its documents share it, so a passage that stands everywhere costs one row for each block.
    """
    docs = settled(docs.drop("n_words", "n_removed", "kept"), fixed)
    names = docs.columns
    id_at, text_at = names.index(id_col), names.index(text_col)
    parts = n_parts(docs)
    texts = docs.mapInArrow(lambda it: batches(text_rows(it, id_at, text_at, parts)), ROW)
    asked = docs.select(id_col, text_col).mapInArrow(lambda it: batches(_ask_anchors(it, 0, 1, window, parts)), ROW)
    shared = stored(sent(asked, parts, lambda it: batches(_answer_anchors(rows_of(it), parts))), "anchors", free=True)
    asked = sent(texts.unionByName(shared), parts, lambda it: batches(_ask_windows(rows_of(it), id_at, text_at, window, parts)))
    repeated = stored(sent(asked, parts, lambda it: batches(_answer_windows(rows_of(it), parts))), "windows", free=True)
    rows = texts.unionByName(shared).unionByName(repeated.withColumn("tag", F.lit(ANSWER + 1)))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return sent(rows, parts, lambda it: trimmed(_removed(rows_of(it), id_at, text_at, window, names)), f"{fields}, n_words long, n_removed long, kept string")
