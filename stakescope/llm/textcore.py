"""Vectorised text primitives: word spans, content hashes, sorted-key maps and packed arrays.

Everything works on Arrow string buffers (UTF-8 bytes and offsets) with numpy, so a
partition's text is never turned into one Python object per word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard

U64 = np.uint64
#: The multipliers of the 64-bit mixing function (splitmix64) and two odd factors.
_M1, _M2, _GOLD = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)
_ODD = (U64(0x2545F4914F6CDD1D), U64(0xD1342543DE82EF95))
#: Text is worked on in pieces of about this many bytes, which bounds the working arrays.
PIECE_BYTES = 1_000_000
#: Spans of more bytes than this are hashed by a library routine, one by one.
LONG_BYTES = 64
_KEY = b"stakescope text spans"
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], U64)

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits look independent."""
    x = x + _GOLD
    x = (x ^ (x >> U64(30))) * _M1
    x = (x ^ (x >> U64(27))) * _M2
    return x ^ (x >> U64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number (zeros beyond the end)."""
    return np.ndarray(len(data) + 1, "<u8", np.append(data, np.zeros(8, np.uint8)).tobytes(), strides=(1,))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0, lower: bool = False) -> np.ndarray:
    """A 64-bit content hash of each span data[start:end]; equal bytes hash alike wherever they stand. lane: 0 or 1.

    Eight bytes at a time go through a non-linear mixing function; spans of more than LONG_BYTES take keyed BLAKE2.
    """
    if lower:
        data = _LOWER[data]
    n = ends - starts
    state = mix(n.astype(U64) * _ODD[lane])
    eight = _eights(data)
    at = np.flatnonzero((n > 0) & (n <= LONG_BYTES))
    done = 0
    while len(at):
        left = n[at] - done
        state[at] = mix((state[at] ^ eight[starts[at] + done] & _TAIL[np.minimum(left, 8)]) * _ODD[lane])
        at, done = at[left > 8], done + 8
    long = np.flatnonzero(n > LONG_BYTES)
    if len(long):
        whole = data.tobytes()
        digests = b"".join(hashlib.blake2b(whole[a:b], digest_size=16, key=_KEY).digest() for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True))
        state[long] = np.frombuffer(digests, "<u8").reshape(-1, 2)[:, lane]
    return state


def same_spans(a: np.ndarray, a0: np.ndarray, a1: np.ndarray, b: np.ndarray, b0: np.ndarray, b1: np.ndarray) -> np.ndarray:
    """Whether the bytes a[a0:a1] and b[b0:b1] are equal, for each pair of spans."""
    n = a1 - a0
    same = n == b1 - b0
    x, y = _eights(a), _eights(b)
    at = np.flatnonzero(same & (n > 0) & (n <= LONG_BYTES))
    done = 0
    while len(at):
        left = n[at] - done
        equal = ((x[a0[at] + done] ^ y[b0[at] + done]) & _TAIL[np.minimum(left, 8)]) == 0
        same[at[~equal]] = False
        at, done = at[equal & (left > 8)], done + 8
    for i in np.flatnonzero(same & (n > LONG_BYTES)).tolist():
        same[i] = bool(np.array_equal(a[a0[i] : a1[i]], b[b0[i] : b1[i]]))
    return same


def distinct_spans(data: np.ndarray, s: np.ndarray, e: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct spans by their bytes: sorted keys, an example of each, the place of each span among them, and their counts.

    Every span is compared with the example of its key; where different bytes share a key, the key stands more than once.
    """
    d, inverse, n = distinct(keys)
    example = np.empty(len(d), np.int64)
    example[inverse] = np.arange(len(keys))
    of = example[inverse]
    if same_spans(data, s, e, data, s[of], e[of]).all():
        return d, example, inverse, n
    words = list(zip(keys.tolist(), (data[x:y].tobytes() for x, y in zip(s.tolist(), e.tolist(), strict=True)), strict=True))
    every = {w: k for k, w in enumerate(sorted(set(words)))}
    inverse = np.array([every[w] for w in words], np.int64)
    example = np.empty(len(every), np.int64)
    example[inverse] = np.arange(len(keys))
    return keys[example], example, inverse, np.bincount(inverse)


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


#: What stands for a null id inside arrays: smaller than any other.
NULL_ID = -(2**63)


def ids_of(column: pa.Array) -> np.ndarray:
    return np.array(column.cast(pa.int64()).fill_null(NULL_ID).to_numpy(zero_copy_only=False), np.int64)


def ids_back(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES):
    """Ranges of documents of about limit bytes each; a longer document is a range by itself."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ and, for each document, the index of its first word (n + 1 values)."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SEPARATOR[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    cut[n] = True
    starts = np.empty(n, bool)
    starts[0] = inside[0]
    starts[1:] = inside[1:] & (~inside[:-1] | cut[1:n])
    ends = np.empty(n, bool)
    ends[n - 1] = inside[n - 1]
    ends[:-1] = inside[:-1] & (~inside[1:] | cut[1:n])
    s = np.flatnonzero(starts)
    return s, np.flatnonzero(ends) + 1, np.searchsorted(s, offsets)


def windows(h: np.ndarray, n: int, lane: int = 0) -> np.ndarray:
    """Hashes of all n consecutive values of h (they may cross documents; callers mask those), put together from powers of two."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    odd, out, done, size, power = _ODD[lane], None, 0, 1, h
    while size <= n:
        if n & size:
            part = power[done : done + m]
            out = part.copy() if out is None else mix(out * odd + part)
            done += size
        power = mix(power[:-size] * odd + power[size:]) if 2 * size <= n else power
        size *= 2
    return out


def window_ok(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the total - n + 1 windows lie in one document."""
    if total < n:
        return np.zeros(0, bool)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return doc[: total - n + 1] == doc[n - 1 :]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the place of each input key among them, and their counts."""
    if not len(keys):
        return keys, np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys)
    k = keys[order]
    new = np.empty(len(k), bool)
    new[0] = True
    np.not_equal(k[1:], k[:-1], out=new[1:])
    at = np.flatnonzero(new)
    inverse = np.empty(len(k), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return k[at], inverse, np.diff(np.append(at, len(k)))


_DTYPES = [np.dtype(x) for x in ("u1", "<u2", "<u4", "<u8", "<i4", "<i8", "<f8")]


def _small(a: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds the values, if they are whole and not negative."""
    if a.dtype.kind in "iu" and a.dtype.itemsize > 1 and (not len(a) or int(a.min()) >= 0):
        top = int(a.max()) if len(a) else 0
        return a.astype("u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")
    return a.astype("u1") if a.dtype == bool else a


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays as compressed bytes; bytes of equal weight stand together, which suits sorted differences and small counts."""
    head, body = [len(arrays)], []
    for a in arrays:
        a = np.ascontiguousarray(_small(np.asarray(a)))
        a = a.astype(a.dtype.newbyteorder("<"))
        head += [_DTYPES.index(a.dtype), len(a)]
        body.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=level).compress(np.array(head, "<i8").tobytes() + b"".join(body))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(bytes(blob))
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", 2 * n, 8), 8 * (1 + 2 * n), []
    for k in range(n):
        dtype, size = _DTYPES[head[2 * k]], int(head[2 * k + 1])
        part = np.frombuffer(raw, np.uint8, size * dtype.itemsize, at)
        out.append(np.ascontiguousarray(part.reshape(dtype.itemsize, size).T).reshape(-1).view(dtype))
        at += size * dtype.itemsize
    return out


def deltas(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=U64(0)) if len(sorted_keys) else sorted_keys


def undeltas(d: np.ndarray) -> np.ndarray:
    return np.cumsum(d.astype(U64), dtype=U64)


def bounds(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each of the parts equal ranges of 64-bit keys begins in sorted keys (parts + 1 values)."""
    edges = np.array([(p << 64) // parts for p in range(1, parts)], dtype=U64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)])).astype(np.int64)
