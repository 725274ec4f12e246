"""Exact and approximate search against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stakescope.llm.nn_descent import approximate_top_k
from stakescope.llm import nn_descent, topk
from stakescope.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score string"


def table(spark, n=700, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, 16))
    m = (centres[rng.integers(0, 12, n)] + 0.5 * rng.standard_normal((n, 16))).astype(np.float32)
    m[50:90] = m[50]  # one common vector
    rows = [(i, m[i].tolist(), "x") for i in range(n)]
    rows += [(n, None, "x"), (n + 1, [None] * 16, "x"), (n + 2, [float("nan")] * 16, "x"), (n + 3, [float("inf")] * 16, "x"), (n + 4, [0.0] * 16, "x"), (n + 5, [1.0], "x"), (None, m[0].tolist(), "x")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4), rows


def usable(rows, zero):
    out = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v)):
            out[i] = np.array(list(v) + [0.0] * (16 - len(v)), np.float32).astype(float)
    return out


def brute(vectors, k, every):
    ids = np.array(sorted(vectors))
    m = np.array([vectors[i] for i in ids])
    for q in ids[ids % every == 0].tolist():
        s = m @ vectors[q]
        order = [o for o in np.lexsort((ids, -s)) if ids[o] != q][:k]
        yield q, [(int(ids[o]), s[o]) for o in order]


def test_exact_top_k(spark):
    df, rows = table(spark)
    got = {}
    for r in exact_top_k(df, 10, 7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    vectors = {i: np.floor(64 * v) for i, v in usable(rows, True).items()}
    want = dict(brute(vectors, 10, 7))
    assert {q: sorted(x) for q, x in got.items()} == {q: [(k + 1, i, int(s)) for k, (i, s) in enumerate(x)] for q, x in want.items()}
    assert exact_top_k(df.limit(0)).count() == 0
    assert exact_top_k(df.where("vec_id in (7, 14, 15)"), 10, 7).count() == 4  # fewer candidates than k


def test_exact_top_k_with_repeated_ids_and_far_values(spark):
    """An id with several vectors asks with the smallest; all rows with another id are candidates; large values stay exact."""
    rows = [(0, [1.0, 2.0]), (0, [1.0, 1.0]), (0, [1.0, 1.0]), (1, [3.0, 0.0]), (1, [3.0, 0.0]), (2, [-1.0, 9.0]), (3, [1e12, -1e12]), (4, [])]
    got = sorted(map(tuple, exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3, 2).collect()))
    v = [(i, [int(np.floor(64 * x)) for x in m] + [0] * (2 - len(m))) for i, m in rows]
    want = []
    for q in (0, 2, 4):
        own = min(m for i, m in v if i == q)
        best = sorted((-sum(a * b for a, b in zip(own, m, strict=True)), i) for i, m in v if i != q)[:3]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == want


def searched_share(m, n_queries=200, k=10):
    m = np.floor(64 * m).astype(np.int64)
    order = np.argsort(topk.places(m))
    index = topk.Index(topk.blocks_of(order, m[order]), m.shape[1])
    none = np.full(n_queries, -(2**63))
    q, v, s, scored = topk.search(index, np.arange(n_queries), m[:n_queries], none, none, k)
    for i in range(0, n_queries, 20):
        own = m @ m[i]
        best = [int(x) for x in np.lexsort((np.arange(len(m)), -own)) if x != i][:k]
        assert v[q == i].tolist() == best and s[q == i].tolist() == own[best].tolist()
    return scored / (n_queries * len(index.blocks))


def test_blocks_are_skipped_on_clustered_vectors():
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 32))
    clustered = centres[rng.integers(0, 60, 12_000)] + 0.15 * rng.standard_normal((12_000, 32))
    assert searched_share(clustered) < 0.25
    assert searched_share(rng.standard_normal((4000, 32))) <= 1  # directions without clusters: right, though little is skipped


def test_approximate_top_k(spark):
    df, rows = table(spark, 1500)
    got = {}
    for r in approximate_top_k(df, 10, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    vectors = usable(rows, False)
    hit = total = 0
    want = dict(brute(vectors, 10, 20))
    assert set(got) == set(want)
    for q, x in want.items():
        mine = sorted(got[q])
        assert [k for k, *_ in mine] == list(range(1, 11)) and all(i != q for _, i, _ in mine)
        assert all(s == pytest.approx(float(vectors[i] @ vectors[q]), rel=1e-12) for _, i, s in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hit += len({i for _, i, _ in mine} & {i for i, _ in x})
        total += 10
    assert hit / total >= 0.9
    assert approximate_top_k(df.limit(0)).count() == 0
    few = approximate_top_k(df.where("vec_id < 5"), 10, 20).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3, 4]


def test_small_index_is_compared_completely(spark):
    m = np.ones((21, 16)) + 0.1 * np.random.default_rng(21).standard_normal((21, 16))
    m[20] = -1.0  # opposite to all others: in nobody's best
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(21)], "vec_id long, embedding array<double>")
    got = {}
    for r in approximate_top_k(df, 20, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    want = dict(brute(dict(enumerate(m)), 20, 20))
    assert {q: [i for _, i in sorted(x)] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


def test_approximate_top_k_with_repeated_ids(spark):
    """An id with several vectors asks with the smallest and counts once, with its best; rows without an id take no part."""
    rng = np.random.default_rng(8)
    m = rng.standard_normal((60, 8)).astype(np.float32)
    rows = [(k, m[k].tolist()) for k in range(60)] + [(0, [-9.0] * 8), (3, m[7].tolist()), (3, m[3].tolist()), (None, m[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in approximate_top_k(df, 20, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in (0, 20, 40):
        own = np.array(min(v for i, v in rows if i == q), np.float32).astype(float)
        best = {}
        for i, v in rows:
            if i is not None and i != q:
                best[i] = max(best.get(i, -np.inf), float(np.array(v, np.float32).astype(float) @ own))
        want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:20]
        assert [i for _, i, _ in sorted(got[q])] == [i for i, _ in want] and [s for *_, s in sorted(got[q])] == pytest.approx([s for _, s in want])


def hubs(n, width=32, seed=17):
    """Directions of unequal length: the long ones are near to very many."""
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((n, width))
    return m / np.linalg.norm(m, axis=1, keepdims=True) * np.exp(0.5 * rng.standard_normal((n, 1)))


def test_members_that_are_not_drawn_stay_new(spark):
    """After a round each node holds back exactly its new members beyond those that it drew; the next round starts with them."""
    m = hubs(1200).astype(np.float32)
    nodes = spark.createDataFrame([(k, m[k].tolist()) for k in range(len(m))], "node long, v array<float>")
    parts = 4
    state = nn_descent.stored(nn_descent._seeded(nodes, 4, parts, np.float32), "graph")
    before = None
    for turn in range(2):
        state = nn_descent.stored(nn_descent._round(state.where(F.col("tag") != nn_descent.COUNT), parts, np.float32, turn), "graph")
        rows = state.collect()
        lists = [nn_descent.unpack(r["body"]) for r in rows if r["tag"] == nn_descent.STATE]
        held = [nn_descent.unpack(r["body"]) for r in rows if r["tag"] == nn_descent.HELD]
        late = {(int(a), int(b)) for h in held for a, b in zip(h[0], h[1], strict=True)}
        assert sum(r["block"] for r in rows if r["tag"] == nn_descent.HELD) == len(late) > 0
        members = {}
        for x in lists:
            for a, b in zip(x[3].tolist(), x[4].tolist(), strict=True):
                members.setdefault(a, set()).add(b)
                members.setdefault(b, set()).add(a)
        waits = Counter(a for a, _ in late)
        assert all(b in members[a] for a, b in late)
        if turn == 0:  # all members are new
            assert waits == Counter({a: len(x) - nn_descent.MEMBERS for a, x in members.items() if len(x) > nn_descent.MEMBERS})
        else:  # what waited and is still a member was drawn or waits on, and takes its turn with the others
            drawn = {(a, b) for a, b in before if b in members[a]} - late
            assert all(sum(x == a for x, _ in drawn) <= nn_descent.MEMBERS for a in {a for a, _ in drawn}) and drawn
        before = late


def test_approximate_top_k_with_hubs(spark):
    m = hubs(3000)
    df = spark.createDataFrame([(k, m[k].tolist()) for k in range(len(m))], "vec_id long, embedding array<double>")
    got = {}
    for r in approximate_top_k(df, 10, 20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = dict(brute(dict(enumerate(m)), 10, 20))
    assert sum(len(got[q] & {i for i, _ in x}) for q, x in want.items()) / sum(len(x) for x in want.values()) >= 0.9


def test_what_a_step_exchanges_follows_the_table(spark, monkeypatch):
    """On many partitions a vector goes to as many of them as it has neighbours; rounds and searches then come in turns, with all rows as before."""
    for n, parts in ((600_000, 120), (24_000_000, 4800)):
        per_round = n * min(parts, 2 * nn_descent.DEGREE) * (256 + 16 + nn_descent.DEGREE * 20)
        assert per_round > 100 * n * 256 and per_round / nn_descent.turns(n, parts, 256) <= nn_descent.STEP_SHARE * n * 256
    monkeypatch.setattr(nn_descent, "STEP_BYTES", 1 << 19)
    monkeypatch.setattr(nn_descent, "STEP_SHARE", 4)
    m = hubs(1500).astype(np.float32)
    df = spark.createDataFrame([(k, m[k].tolist()) for k in range(len(m))], "vec_id long, embedding array<float>")
    asked, turns, searches = [], nn_descent.turns, nn_descent.searches
    monkeypatch.setattr(nn_descent, "turns", lambda *a: asked.append(min(turns(*a), 3)) or asked[-1])
    monkeypatch.setattr(nn_descent, "searches", lambda *a: asked.append(min(searches(*a), 2)) or asked[-1])
    got = {}
    for r in approximate_top_k(df, 10, 20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = dict(brute(dict(enumerate(m.astype(float))), 10, 20))
    assert asked == [3, 2] and set(got) == set(want) and all(len(x) == 10 for x in got.values())
    assert sum(len(got[q] & {i for i, _ in x}) for q, x in want.items()) / sum(len(x) for x in want.values()) >= 0.9
