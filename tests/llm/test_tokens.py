"""Token counts, byte-level BPE and packing against the libraries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stakescope.llm import bpe
from stakescope.llm.byte_bpe import decode, encode, round_trip
from stakescope.llm.packing import pack, pack_plan
from stakescope.llm.token_counts import token_counts

from .conftest import alternating, odd_texts


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json")[0])


def test_pretokens_match_the_library(vocabulary, library):
    rng = random.Random(3)
    alphabet = ["a", "b", " ", " ", "\n", "\t", "'", "s", "t", "re", "ll", "ve", "!", "1", "²", "é", " ", "　", "日", "😀", "<|endoftext|>", "'s", "՘", "٣", "\x1c", "\x85"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(3000)] + [t for _, t in odd_texts()]
    v = bpe.Vocabulary.read(*vocabulary("byte_bpe_50k.json"))
    encoder, got = bpe.Encoder(v), []
    for _, part, s, e, keys, first in bpe.column_tokens(pa.array(texts), v, 5000):
        ids, n = encoder.ids(part, s, e, keys)
        ends = np.concatenate(([0], np.cumsum(n)))[first]
        got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert got == [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_whole_tokens_are_proved(vocabulary):
    v = bpe.Vocabulary.read(*vocabulary("byte_bpe_50k.json"))
    whole = v.prove_whole()
    assert len(whole) > 40_000 and all(v.encoder.encode_ordinary(t.decode()) == [i] for t, i in list(whole.items())[::97])


def test_token_counts(odd, none, vocabulary, library):
    extra = odd.withColumn("n_tokens", F.lit("x"))
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts(extra, *vocabulary("byte_bpe_50k.json")).collect()}
    for i, t in odd_texts():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 512)
    assert token_counts(none, *vocabulary("byte_bpe_50k.json")).count() == 0
    twice = token_counts(odd.union(odd), *vocabulary("byte_bpe_50k.json"))
    assert Counter(map(tuple, twice.collect())) == Counter({(i, *v): 2 for i, v in got.items()})


def test_byte_bpe(odd, none, vocabulary):
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=ranks[1], mergeable_ranks=bpe.load_ranks(ranks[0])[0], special_tokens={})
    rows = decode(encode(odd.withColumn("ids", F.lit(1)), *ranks), *ranks).collect()
    digests = {r["doc_id"]: r for r in round_trip(odd, *ranks).collect()}
    texts = dict(odd_texts())
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]] or ""
        ids = library.encode_ordinary(t)
        assert (r["ids"], bytes(r["data"])) == (ids, t.encode())
        d = digests[r["doc_id"]]
        assert (d["n_tokens"], d["ids_sha256"], d["decoded_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    assert round_trip(none, *ranks).count() == 0
    twice = round_trip(odd.union(odd).withColumn("data", F.lit("x")), *ranks).collect()
    assert Counter(map(tuple, twice)) == Counter({tuple(r): 2 for r in digests.values()})


def fits(plan, bins, histogram, capacity):
    """Every piece is placed once, and every bin is filled without gaps or overlap."""
    ranks, space = {}, {}
    for length, first, many, start, offset in plan:
        ranks.setdefault(length, []).append((first, many))
        for k in range(many):
            space.setdefault(start + k, []).append((offset, length))
    for length, n in histogram:
        at = 0
        for first, many in sorted(ranks.get(length, [])):
            assert first == at
            at += many
        assert at == n
    assert sorted(space) == list(range(bins))
    for items in space.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity


def best_fit(histogram, capacity):
    """Bins of plain best-fit decreasing, piece by piece."""
    rooms = []
    for s, n in sorted(histogram, reverse=True):
        for _ in range(n):
            k = min((r, i) for i, r in enumerate([*rooms, capacity]) if r >= s)[1]
            if k == len(rooms):
                rooms.append(capacity)
            rooms[k] -= s
    return len(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_pack_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64])
    histogram = [(s, rng.randrange(1, 40)) for s in rng.sample(range(1, capacity + 1), rng.randrange(1, min(capacity, 12)))]
    plan, bins, fixed = pack_plan(histogram, capacity)
    fits(plan, bins, histogram, capacity)
    assert fixed <= bins and -(-sum(s * n for s, n in histogram) // capacity) <= bins <= best_fit(histogram, capacity)


def test_dominance_fixes_perfect_pairs():
    assert pack_plan([(6, 3), (4, 3)], 10)[1:] == (3, 3)
    assert pack_plan([], 10) == ([], 0, 0)


def test_packing(odd, none, vocabulary, library):
    path = vocabulary("byte_bpe_50k.json")
    for docs, texts in ((odd, dict(odd_texts())), (none, {})):
        rows = pack(docs, *path, 256).collect()
        pieces = {(r["doc_id"], r["piece"]): r for r in rows}
        n = 0
        for i, t in texts.items():
            ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
            start, length = 0, (len(ids) - 1) % 256 + 1
            for k in range(-(-len(ids) // 256)):
                r = pieces[i, k]
                assert (r["start"], r["length"], r["ids_crc32"]) == (start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()))
                start, length, n = start + length, 256, n + 1
        assert n == len(rows)
        by_bin = {}
        for r in rows:
            by_bin.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for items in by_bin.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= 256


def test_packing_of_repeated_rows_and_clashing_columns(odd, vocabulary, library):
    twice = odd.union(odd).withColumn("length", F.lit("x")).withColumn("offset", F.lit(1)).withColumn("_rank", F.lit(2))
    rows = pack(twice, *vocabulary("byte_bpe_50k.json"), 256).collect()
    want = Counter()
    for i, t in odd_texts():
        n = len(library.encode(t or "", add_special_tokens=False).ids) + 1
        first = (n - 1) % 256 + 1
        for k in range(-(-n // 256)):
            want[i, k, 0 if not k else first + 256 * (k - 1), first if not k else 256] += 2
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in rows) == want
    taken = {}
    for r in rows:
        taken.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in x) <= 256 and all(a[0] + a[1] == b[0] for a, b in zip(sorted(x), sorted(x)[1:])) for x in taken.values())


def test_spans_that_collide_are_told_apart():
    """With a hash of two bits nearly all words collide; bytes still decide."""
    from stakescope.llm import textcore

    text = " ".join(f"w{k % 37}" for k in range(500)).encode()
    data = np.frombuffer(text, np.uint8)
    s, e, _ = textcore.word_spans(data, np.array([0, len(data)]))
    keys = textcore.hash_spans(data, s, e) % np.uint64(4)
    d, example, inverse, n = textcore.distinct_spans(data, s, e, keys)
    words = [text[a:b] for a, b in zip(s, e, strict=True)]
    assert len(d) == 37 and n.sum() == 500 and (np.diff(d.astype(np.int64)) >= 0).all()
    assert [words[example[k]] for k in inverse] == words
    whole = bpe.WholeTokens([b"w1", b"w2", b"w30"])
    assert whole.holds(data, s, e, textcore.hash_spans(data, s, e)).tolist() == [w in (b"w1", b"w2", b"w30") for w in words]
    a, b = (np.frombuffer(w.encode(), np.uint8) for w in alternating(1024))
    for lane in (0, 1):
        for m in (8, 24, 64, 1024):
            one, two = (textcore.hash_spans(x, np.array([0]), np.array([m]), lane)[0] for x in (a, b))
            assert one != two
