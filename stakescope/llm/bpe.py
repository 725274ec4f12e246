"""Byte-level BPE on whole columns: vectorised pre-tokens, whole-token shortcut, cached merges.

The vocabulary files are read where they lie (driver), and go to the tasks as one bounded
object: 50,256 entries whatever the data.
"""

from __future__ import annotations

import base64
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken

from .textcore import PIECE_BYTES, distinct_spans, hash_spans, pieces, same_spans, string_buffers

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: A task's cache of merged words is emptied beyond this many entries; this bounds memory and changes no result.
CACHE_ENTRIES = 120_000
#: Longer words are merged again each time they come.
CACHE_BYTES = 200
_QUOTE, _BLANK = 0x27, 0x20
#: The classes in the public pre-token pattern, by themselves.
PROBE_PATTERN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+"


@lru_cache(1)
def classes() -> np.ndarray:
    """For each code point: letter, number, white space, or anything else, as the tokenizer libraries tell them apart.

    Two tables of different Unicode versions agree on nearly all; the library itself is asked about the others.
    """
    table = np.zeros(0x110000, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            # runs may step over the surrogates, whose place in `every` is closed up
            table[[ord(c) for c in m.group()]] = kind
    major = {"L": LETTER, "N": NUMBER}
    other = np.fromiter((major.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for c in np.flatnonzero((table != other) & (table != SPACE)).tolist():
        table[c] = _library_class(chr(c))
    return table


@lru_cache(1)
def _probe() -> tiktoken.Encoding:
    """A vocabulary in which a, 1 and ! join any byte that follows in the same pre-token."""
    pairs = [bytes([a, b]) for a in b"a1!" for b in range(256)]
    return tiktoken.Encoding("probe", pat_str=PROBE_PATTERN, mergeable_ranks={t: i for i, t in enumerate([bytes([b]) for b in range(256)] + pairs)}, special_tokens={})


def _library_class(c: str) -> int:
    for kind, a in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
        if len(_probe().decode_single_token_bytes(_probe().encode_ordinary(a + c)[0])) == 2:
            return kind
    return SPACE


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def load_ranks(path: str) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """Token bytes to ids, and the special strings that the file's library recognises inside texts."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        letters = _byte_letters()
        return {bytes(letters[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s.encode() not in special}, special
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}, {}


def _cut_at(data: np.ndarray, offsets: np.ndarray, special: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets with cuts around special strings; starts and ends of those strings."""
    if not special:
        return offsets, offsets[:0], offsets[:0]
    pattern = regex.compile(b"|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)))
    found = [m.span() for m in pattern.finditer(data.tobytes())]
    if found:
        s, e = np.array(found, np.int64).T
        whole = np.searchsorted(offsets, s, side="right") == np.searchsorted(offsets, e, side="left")  # in one document
        s, e = s[whole], e[whole]
        return np.unique(np.concatenate((offsets, s, e))), s, e
    return offsets, offsets[:0], offsets[:0]


def pretokens(data: np.ndarray, offsets: np.ndarray, special: dict[bytes, int], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all pre-tokens of the documents, and the index of each document's first one (n + 1 values)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    cuts, fixed, fixed_end = _cut_at(data, offsets, special)
    lead = (data & 0xC0) != 0x80
    lead[offsets[:-1][offsets[:-1] < len(data)]] = True
    pos = np.flatnonzero(lead)
    head = data[pos]
    cp = head.astype(np.int32)
    if len(pos) < len(data):
        padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int32)
        for low, high, n in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0x100, 4)):
            at = np.flatnonzero((head >= low) & (head < high))
            p, value = pos[at], padded[pos[at]] & (0x7F >> n)
            for k in range(1, n):
                value = value << 6 | padded[p + k] & 0x3F
            cp[at] = np.minimum(value, 0x10FFFF)
    m = len(cp)
    kind = table[cp]
    first = np.zeros(m + 1, bool)  # documents (or parts between special strings) begin here
    first[np.searchsorted(pos, cuts)] = True
    first[m] = True
    run = np.empty(m, bool)  # runs of one class begin here
    run[0] = True
    run[1:] = (kind[1:] != kind[:-1]) | first[1:m]
    start = run.copy()
    # white space before something else in the same document: its last character stands apart or joins what follows
    word = np.flatnonzero(run & (kind != SPACE))
    after = word[(word > 0) & ~first[word]]
    after = after[kind[after - 1] == SPACE]
    start[after - 1] = True
    start[after[cp[after - 1] == _BLANK]] = False
    # contractions: a lone quote where a token begins, and s t m d re ve ll after it
    q = np.flatnonzero(start & (cp == _QUOTE))
    q = q[(q + 1 < m)]
    q = q[~first[q + 1] & (kind[np.minimum(q + 1, m - 1)] == LETTER)]
    if len(q):
        a, b = cp[q + 1], cp[np.minimum(q + 2, m - 1)]
        two = np.isin(a, [ord(c) for c in "stmd"])
        inside = (q + 2 < m) & ~first[np.minimum(q + 2, m)]
        three = inside & (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
        for hit, n in ((two, 2), (three, 3)):
            at = q[hit]
            start[at + 1] = False
            at = at + n
            start[at[at < m]] = True
    s = pos[start]
    if len(fixed):  # a special string is one token
        k = np.searchsorted(fixed, s, side="right") - 1
        s = s[(k < 0) | (s == fixed[k]) | (s >= fixed_end[k])]
    return s, np.append(s[1:], len(data)), np.searchsorted(s, offsets)


class Vocabulary:
    """Ranks, the library's encoder for the rest, and the strings proved to be one token by themselves."""

    def __init__(self, ranks: dict[bytes, int], special: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.special, self.pattern, self.classes = ranks, special, pattern, classes()

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        return cls(*load_ranks(path), pattern)

    @property
    def encoder(self) -> tiktoken.Encoding:
        if "_encoder" not in self.__dict__:
            self._encoder = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={})
        return self._encoder

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_encoder" and k != "_whole"}

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        if word in self.special:
            return [self.special[word]]
        try:
            return self.encoder.encode_ordinary(word.decode())
        except UnicodeDecodeError:
            return self.encoder.encode_ordinary(word.decode(errors="replace"))

    def prove_whole(self) -> dict[bytes, int]:
        """The vocabulary strings that the encoder gives back as one token, each checked by encoding it alone (offline, once)."""
        found = {}
        for token, rank in self.ranks.items():
            try:
                text = token.decode()
            except UnicodeDecodeError:
                continue
            if self.encoder.encode_ordinary(text) == [rank]:
                found[token] = rank
        return found

    def token_bytes(self) -> tuple[np.ndarray, np.ndarray]:
        """The token-byte table for decoding: all bytes, and where each id's begin."""
        table = {i: b for b, i in [*self.ranks.items(), *self.special.items()]}
        top = max(table) + 1 if table else 0
        joined = [table.get(i, b"") for i in range(top)]
        return np.frombuffer(b"".join(joined), np.uint8), np.concatenate(([0], np.cumsum([len(b) for b in joined]))).astype(np.int64)


class WholeTokens:
    """Strings that are one token by themselves, to be found by hash and compared by bytes."""

    def __init__(self, tokens: list[bytes]) -> None:
        data = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum([len(t) for t in tokens], dtype=np.int64)
        starts = ends - np.array([len(t) for t in tokens], np.int64)
        keys = hash_spans(data, starts, ends)
        order = np.argsort(keys, kind="stable")
        self.data, self.starts, self.ends, self.keys = data, starts[order], ends[order], keys[order]

    def holds(self, part: np.ndarray, s: np.ndarray, e: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Which spans are one of the strings. Strings whose hashes are equal count as not held, but for the first."""
        found = np.zeros(len(keys), bool)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == keys)
            at = at[hit]
            found[hit] = same_spans(part, s[hit], e[hit], self.data, self.starts[at], self.ends[at])
        return found


def column_tokens(column: pa.Array, vocabulary: Vocabulary, limit: int = PIECE_BYTES):
    """Pieces of a text column: (first document, bytes, starts, ends, keys, first token of each document)."""
    data, offsets = string_buffers(column)
    for i, j in pieces(offsets, limit):
        part = data[offsets[i] : offsets[j]]
        s, e, first = pretokens(part, offsets[i : j + 1] - offsets[i], vocabulary.special, vocabulary.classes)
        yield i, part, s, e, hash_spans(part, s, e), first


class Counter:
    """Tokens of pre-tokens: one for proved whole tokens, merged and remembered otherwise."""

    def __init__(self, vocabulary: Vocabulary, whole: WholeTokens) -> None:
        self.vocabulary, self.whole, self.cache = vocabulary, whole, {}

    def counts(self, part: np.ndarray, s: np.ndarray, e: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), np.int64)
        rest = np.flatnonzero(~self.whole.holds(part, s, e, keys))
        if len(rest):
            d, example, inverse, _ = distinct_spans(part, s[rest], e[rest], keys[rest])
            example = rest[example]
            cache, encode, n = self.cache, self.vocabulary.encode_word, np.empty(len(d), np.int64)
            if len(cache) > CACHE_ENTRIES:
                cache.clear()
            for k, (a, b) in enumerate(zip(s[example].tolist(), e[example].tolist(), strict=True)):
                word = part[a:b].tobytes()
                c = cache.get(word)
                if c is None:
                    c = len(encode(word))
                    if b - a <= CACHE_BYTES:
                        cache[word] = c
                n[k] = c
            out[rest] = n[inverse]
        return out


class Encoder:
    """Ids of pre-tokens, each distinct word of a task merged once and remembered."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.cache = vocabulary, {}

    def ids(self, part: np.ndarray, s: np.ndarray, e: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each pre-token has."""
        _, example, inverse, _ = distinct_spans(part, s, e, keys)
        cache, encode, words = self.cache, self.vocabulary.encode_word, []
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        for a, b in zip(s[example].tolist(), e[example].tolist(), strict=True):
            word = part[a:b].tobytes()
            w = cache.get(word)
            if w is None:
                w = np.array(encode(word), "<u4").tobytes()
                if b - a <= CACHE_BYTES:
                    cache[word] = w
            words.append(w)
        return gathered(np.frombuffer(b"".join(words), "<u4"), np.array([len(w) // 4 for w in words], np.int64), inverse)


def gathered(values: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The variable-length rows of values (given their lengths) picked by which, end to end, and the picked lengths."""
    starts = np.cumsum(lengths) - lengths
    n = lengths[which]
    total = int(n.sum())
    if not total:
        return values[:0], n
    at = np.arange(total) + np.repeat(starts[which] - (np.cumsum(n) - n), n)
    return values[at], n
