"""Suffix tree, substring dedup, sharding, classifier and Jaccard join against brute force on odd documents."""

from __future__ import annotations

import glob
import heapq
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from stakescope.llm import jaccard_join, suffix_tree
from stakescope.llm import quality as Q
from stakescope.llm.components import components
from stakescope.llm.jaccard_join import jaccard_components
from stakescope.llm.recompression import anchors, remove_repeats
from stakescope.llm.shared import stored
from stakescope.llm.sharding import lpt, planned, shard_by_bytes
from stakescope.llm.suffix_tree import score

from .conftest import odd_texts, words_of


def id_order(i):
    return -(2**63) if i is None else i


def brute_repeats(rows, n=13):
    first = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            first[key] = min(first.get(key, 2**62), id_order(i))
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < id_order(i):
                gone[k : k + n] = [True] * n
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def test_remove_repeats(odd, none):
    clash = odd.withColumn("kept", F.lit(1)).withColumn("block", F.lit(2))
    got = remove_repeats(clash)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "block", "n_words", "n_removed", "kept"]
    key = lambda r: (id_order(r[0]), r[1], r[2], r[3])
    assert sorted([tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept").collect()], key=key) == sorted(brute_repeats(odd_texts()), key=key)
    assert remove_repeats(none).count() == 0
    twice = remove_repeats(odd.union(odd)).select("doc_id", "n_words", "n_removed", "kept").collect()  # equal ids don't remove each other
    assert sorted(map(tuple, twice), key=key) == sorted(2 * brute_repeats(odd_texts()), key=key)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, 2**63, 4, dtype=np.uint64)
    h = symbols[rng.integers(0, 4, 6000)]
    first = np.concatenate((np.arange(0, 6000, 37), [6000]))
    starts, names = anchors(h, first, 5)
    seen = {}
    for s, a in zip(starts.tolist(), names.tolist(), strict=True):
        assert seen.setdefault(h[s : s + 5].tobytes(), a) == a


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = words_of(t, lower=True)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets, key=id_order)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(ids[a]), find(ids[b])
                if p != q:
                    root[max(p, q, key=id_order)] = min(p, q, key=id_order)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_components(odd, none):
    want = brute_components(odd_texts())
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(odd.withColumn("n", F.lit("x")).withColumn("row", F.lit(0))).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)
    assert jaccard_components(none).count() == 0
    twice = jaccard_components(odd.union(odd)).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in twice) == Counter({(i, *v): 2 for i, v in want.items()})


def test_a_group_without_a_central_text(spark, monkeypatch):
    """A long chain of texts, each linked with its neighbours only, and copies of every link: exact, without all pairs."""
    rng = random.Random(11)
    words, rows = [f"w{k}" for k in range(60)], []
    for k in range(60):
        rows += [(1000 * j + k, " ".join(words)) for j in range(3)]
        words = [*words[3:], *(f"n{k}x{j}" for j in range(3))]
    rng.shuffle(rows)
    counted, real = [], jaccard_join._links
    monkeypatch.setattr(jaccard_join, "_links", lambda pairs, *a: (counted.append(pairs.count()), real(pairs, *a))[1])
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows).items()} and set(got.values()) == {0}
    same = " ".join(f"s{k}" for k in range(40))  # one hot shingle among many unlike texts
    rows = [(k, " ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(9)) + " the very same five words " + (same if k % 5 == 0 else str(k))) for k in range(150)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_components_of_a_chain(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[k] for k in range(41)}) == 1 and len({got[k] for k in (90, 95, 100)}) == 1 and got[0] != got[90]


def test_suffix_tree(odd, none):
    rows = [(i, t) for i, t in odd_texts()]
    train = {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 10}
    column = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    counts = Counter(w for i, t in rows if i in train for w in [*words_of(t, lower=True), None])
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in score(odd.withColumn("train", F.lit("x")), column).collect()}
    for i, t in rows:
        w = [*words_of(t, lower=True), None]
        r = got[i]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(w), sum(counts[x] > 0 for x in w), n, i not in train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    assert sum(r["score"] for r in got.values()) > sum(r["base_score"] for r in got.values())
    assert score(none, column).count() == 0
    twice = {}
    for r in score(odd.union(odd), column).collect():
        twice.setdefault(r["doc_id"], []).append(r)
    for i, (a, b) in twice.items():  # repeated rows are rows of their own, in training too
        assert a == b and (a["n_tokens"], a["train_tokens"], a["held_out"]) == (got[i]["n_tokens"], 2 * n, got[i]["held_out"])
        assert a["base_score"] == pytest.approx(sum(math.log10((2 * counts[x] + 0.1) / (2 * n + 0.1 * (v + 1))) for x in [*words_of(dict(rows)[i], lower=True), None]), rel=1e-9)
    unlearned = score(odd, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["score"] == r["base_score"] for r in unlearned)


def brute_scores(rows, train, least=8, sure=suffix_tree.SURE):
    """Scores with every context that is seen often enough and diverges; beyond `sure` words, those whose suffix is retained."""
    streams = {i: [*words_of(t, lower=True), None] for i, t in rows}
    counts = Counter(w for i in train for w in streams[i])
    n, v = sum(counts.values()), len(counts)
    after, grows, retained, size = {(): counts}, {()}, {}, 0

    def kept(x, y):
        many, of = sum(x.values()), sum(y.values())
        return sum(k * math.log(k / many * of / y[w]) for w, k in x.items()) > 0.5 * len(x) * math.log(max(2, n))

    while grows:
        size += 1
        level = {}
        for i in train:
            w = streams[i]
            for k in range(size, len(w)):
                if (c := tuple(w[k - size : k]))[1:] in grows:
                    level.setdefault(c, Counter())[w[k]] += 1
        level = {c: x for c, x in level.items() if sum(x.values()) >= least}
        found = {c: (len(x), sum(x.values()), x) for c, x in level.items() if kept(x, after[c[1:]])}
        grows = set(level) if size < sure else set(found)
        after.update(level)
        retained |= found
    out = {}
    for i, w in streams.items():
        total = 0.0
        for k, x in enumerate(w):
            p = (counts[x] + 0.1) / (n + 0.1 * (v + 1))
            for size in range(1, k + 1):
                c = tuple(w[k - size : k])
                if c not in after:
                    break
                if c in retained:
                    kinds, many, seen = retained[c]
                    p = (seen[x] + kinds * p) / (many + kinds)
            total += math.log10(p)
        out[i] = total
    return out, retained


@pytest.mark.parametrize("split", [None, 40])
def test_suffix_tree_scores_with_contexts_of_any_length(spark, monkeypatch, split):
    rng = random.Random(5)
    passages = [" ".join(rng.choice("abcdefg") * 2 for _ in range(12)) for _ in range(3)]
    rows = [(k, " ".join([*(rng.choice("pqrst") for _ in range(rng.randrange(9))), rng.choice(passages), rng.choice("xyz"), *["run"] * (k % 14)])) for k in range(160)] + [(200, None), (201, "aa"), (202, passages[0] + " never")]
    if split:
        monkeypatch.setattr(suffix_tree, "SPLIT", split)
    got = {r["doc_id"]: r["score"] for r in score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), F.col("doc_id") < 140).collect()}
    want, retained = brute_scores(rows, range(140))
    assert max(map(len, retained)) > 2
    assert got == {i: pytest.approx(x, rel=1e-9) for i, x in want.items()}


def test_suffix_tree_deals_out_contexts_by_their_own_count(spark, monkeypatch):
    rng, dealt, write = np.random.default_rng(4), [], suffix_tree.stored

    def recorded(df, name, **kw):
        out = write(df, name, **kw)
        if name == "pairs":
            dealt.append(out.where(F.col("tag") == suffix_tree.CONTEXT).count())
        return out

    monkeypatch.setattr(suffix_tree, "stored", recorded)
    rows = [(k, " ".join(f"x{i} the y{j}" for i, j in rng.integers(0, 60, (1100, 2)).tolist())) for k in range(20)]
    score(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), F.lit(True)).collect()
    assert dealt[0] > 0 and len(dealt) > 1  # "the" stands 22,000 times
    assert not any(dealt[1:])  # "x0 the" and its like some 370 times each


def test_shuffle_files_of_what_is_stored_go(spark):
    folders = list(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString())
    held = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    for _ in range(3):
        before = held()
        stored(spark.range(1000).repartition(3, "id"), "kept", free=True)
        until = time.time() + 3
        while held() - before and time.time() < until:
            time.sleep(0.1)
        assert not held() - before


def test_suffix_tree_learns_rare_contexts_of_a_large_corpus(spark):
    rng = np.random.default_rng(3)
    words = np.array([f"w{k}" for k in range(1000)])
    rows = [(k, " ".join(words[rng.integers(0, 1000, 20_000)])) for k in range(50)] + [(100 + k, "odd pair") for k in range(9)] + [(200, "odd pair")]
    got = score(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), F.col("doc_id") < 200).where("doc_id = 200").first()
    assert got["score"] > got["base_score"] + 6  # both words and the end after a context that is seen 9 times in 1e6 tokens


def test_suffix_tree_retains_what_diverges(spark):
    docs = spark.createDataFrame([(k, "alpha beta gamma delta " * 20 + f"noise{k % 7}") for k in range(60)], "doc_id long, text string")
    rows = score(docs, F.col("doc_id") < 50).collect()
    assert all(r["score"] > r["base_score"] / 3 for r in rows)  # base is far below


def test_lpt_equals_the_heap():
    rng = np.random.default_rng(1)
    for trial in range(20):
        sizes = sorted(rng.integers(8, 60, 900).tolist() + [int(x) for x in rng.integers(500, 3000, 5)], reverse=True)
        heap = [(0, s) for s in range(7)]
        for x in sizes:
            load, s = heap[0]
            heapq.heapreplace(heap, (load + x, s))
        loads = [0] * 7
        for size, shards, upto in lpt(sorted(Counter(sizes).items(), reverse=True), 7):
            for s, a, b in zip(shards, [0, *upto[:-1]], upto, strict=True):
                loads[s] += size * (b - a)
        assert sorted(loads) == sorted(x for x, _ in heap), trial


def test_a_plan_of_many_pieces(spark):
    rows = [(s, [s % 3], [s]) for s in range(50, 0, -1)]
    for at_once in (7, 50, 60):
        assert sorted(map(tuple, planned(spark, iter(rows), at_once).collect())) == sorted(rows)


def test_sharding(odd, none):
    rows = shard_by_bytes(odd.union(odd).withColumn("shard", F.lit("x")), 5).collect()
    assert len(rows) == 2 * len(odd_texts())
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = dict(odd_texts())
    together = {}
    for r in rows:
        t = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(t) + 8, zlib.crc32(t))
        together.setdefault(t, set()).add(r["shard"])
    assert all(len(s) == 1 for s in together.values())
    assert shard_by_bytes(none, 5).count() == 0


def test_quality_on_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.1')}/{t}.parquet") for t in ("documents", "labels"))
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = Q.fit(*Q.labelled_sample(docs, labels, remainder != 1))
    held = Q.score(docs.join(labels.where(remainder == 1), "doc_id").select("doc_id", "text", "quality"), model).toPandas()
    rank = held["score"].rank()
    good = held["quality"] == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.98 and ((held["score"] >= 0.5) == good).mean() > 0.95 and (held.loc[good, "score"] >= 0.5).mean() > 0.97


def test_quality_scores_equal_brute_force(odd, spark):
    """Sizes by the library itself, chunk by chunk; the calibration is where the loss has no slope."""
    texts = {i: (t or "").encode() for i, t in odd_texts()}
    ids = sorted(i for i in texts if i is not None)
    labels = spark.createDataFrame([(i, int(k % 3 > 0), 0) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")
    good, bad = Q.labelled_sample(odd, labels, F.lit(True))
    assert sorted(good + bad) == sorted(texts[i] for i in ids if dict(odd_texts())[i] is not None)
    model = Q.fit(good, bad)
    room = min(Q.DICTIONARY_BYTES, *(sum(len(t) + 1 for t in x[::2]) for x in (good, bad)))
    sizes = []
    for x, made in ((good, model.good), (bad, model.bad)):
        held, raw = [], zstandard.ZstdCompressionDict(made, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        for t in x[::2]:
            if t and sum(len(h) + 1 for h in held) + len(t) + 1 <= room:
                held.append(t)
        assert made == b"\n".join(held) and made
        raw.precompute_compress(level=9)
        tool = zstandard.ZstdCompressor(dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes.append(lambda t, tool=tool: sum(len(tool.compress(t[i : i + Q.CHUNK_BYTES])) for i in range(0, len(t), Q.CHUNK_BYTES)))
    feature = lambda t: (sizes[1](t) - sizes[0](t)) / len(t) if t else 0.0
    a, b = model.weights
    want = lambda t: 1 / (1 + math.exp(-max(-35, min(35, a + b * feature(t)))))
    twice = odd.union(odd).withColumn("score", F.lit("x"))
    got = Counter((r["doc_id"], round(r["score"], 9)) for r in Q.score(twice, model).collect())
    assert got == Counter({(i, round(want(t), 9)): 2 for i, t in texts.items()})
    learnt = [(feature(t), 1) for t in good[1::2]] + [(feature(t), 0) for t in bad[1::2]]
    assert abs(sum(1 / (1 + math.exp(-(a + b * x))) - y for x, y in learnt)) < 1e-3


def test_quality_of_one_text_each_and_byte_bound(spark):
    model = Q.fit([b"good words here " * 40], [b"bad! " * 9])
    assert model.good and model.bad and np.isfinite(model.scores([b"", b"good words", b"bad!"])).all()
    docs = spark.createDataFrame([(1, "a" * 50), (1, "b" * 40), (1, "c" * 40), (2, "d" * 70), (3, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    assert Q.labelled_sample(docs, labels, F.lit(True), most_bytes=60) == ([b"b" * 40], [b"e"])


def test_quality_odd_cases(odd, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = Q.fit(*Q.labelled_sample(odd, labels, F.lit(True)))
    rows = Q.score(odd.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == len(odd_texts()) and {r["score"] for r in rows} == {0.5}
    assert Q.score(none, model).count() == 0
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (4, 1, 0), (None, 1, 0), (7, None, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    good, bad = Q.labelled_sample(odd, labels, F.lit(True))
    assert len(good) + len(bad) <= 2
