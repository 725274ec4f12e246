"""Fill-in-the-middle, entropy mix and divergence audit against brute force on odd documents."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stakescope.llm.divergence import divergence
from stakescope.llm.fill_in_middle import fill_in_middle, restored
from stakescope.llm.mixing import drawn, mix, words

from .conftest import LOWER, odd_texts, words_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute_middle(i, text):
    text = text or ""
    units, h = UNIT.findall(text), hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, n, "plain", None, None, text
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if h4 % 100 < 20 else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return i, n, "spm" if h4 % 100 < 20 else "psm", len(prefix), len(middle), out


def marked() -> list[tuple[int | None, str | None]]:
    """Odd texts, and texts with markers, halves of markers, digits, line ends and characters of every length."""
    texts = ["a<P>b", "<S>", "x <M", "<", "<P", "P><S", ">M> <", "ab1cd22 \n\nef", "é", "éa", "aé", "😀a😀", "٣x٣", "\x00\x01a", "A" * 500, "." * 500, "aZ" * 3 + "@[`{" + "b"]
    return odd_texts() + [(10_000 + 7 * k, t) for k, t in enumerate(texts * 6)]


def test_fill_in_middle(spark, none):
    rows = marked()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).repartition(3)
    clash = docs.withColumn("form", F.lit(1)).withColumn("output", F.lit("x"))
    got = fill_in_middle(clash)
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    want = sorted((brute_middle(i, t) for i, t in rows), key=key)
    assert sorted([tuple(r) for r in got.collect()], key=key) == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    back = got.select("doc_id", restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert Counter(map(tuple, back)) == Counter((i, t or "") for i, t in rows)
    assert fill_in_middle(none).count() == 0
    assert fill_in_middle(docs.union(docs)).count() == 2 * len(rows)
    assert {r["form"] for r in fill_in_middle(docs, rate=0).collect()} == {"plain"}


def source_of(k: int) -> str | None:
    return [None, "b", "a", "Z", "é", "", "hot", "hot", "hot"][k % 9]


def mixed_docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", source_of(k), 0) for k, (i, t) in enumerate(rows)], SCHEMA)


def brute_targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, full = share * sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in full]
        total = sum(weight[s] for s in left)
        share_of = {s: (budget - sum(full.values())) * weight[s] / total for s in left}
        over = [s for s in left if share_of[s] >= most * sizes[s]]
        if not over:
            return share_of | full
        full |= {s: most * sizes[s] for s in over}
        if len(full) == len(order):
            return full


@pytest.fixture(scope="module")
def many(spark):
    rows = [(i, t) for i, t in odd_texts() if len(t or "") < 50_000]
    rows += [(5000 + k, "w " * (k * k % 97)) for k in range(900)]
    return rows, mixed_docs(spark, rows).repartition(5)


def test_mix_meets_targets(spark, many):
    rows, docs = many
    got = mix(docs.withColumn("size", F.lit("x")).withColumn("target", F.lit(0))).collect()
    sizes = Counter((i, len(words_of(t))) for i, t in rows)
    assert Counter((r["doc_id"], r["size"]) for r in got) == sizes
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
    want = brute_targets({s: sum(r["size"] for r in x) for s, x in by.items()})
    for s, x in by.items():
        assert {r["source_size"] for r in x} == {sum(r["size"] for r in x)}
        assert all(math.isclose(r["target"], want[s], rel_tol=1e-9) for r in x)
        assert abs(sum(r["taken"] for r in x) - want[s]) <= 2 + 1e-5 * want[s]


def test_rates_are_exponentially_tilted(many):
    """The copies of all documents of one size follow min(2, exp(multiplier * size)), with a multiplier found by bisection here."""
    _, docs = many
    by = defaultdict(Counter)
    copies = defaultdict(Counter)
    target = {}
    for r in mix(docs).collect():
        by[r["source"]][r["size"]] += 1
        copies[r["source"]][r["size"]] += r["copies"]
        target[r["source"]] = r["target"]
    for s, classes in by.items():
        rate = lambda m, size: min(2.0, math.exp(min(m * size, 1)))
        low, high = -50.0, 1.0
        for _ in range(200):
            m = (low + high) / 2
            low, high = (m, high) if sum(n * size * rate(m, size) for size, n in classes.items()) < target[s] else (low, m)
        ordered = sorted(classes, reverse=True)
        for size, longer in zip(ordered, [None, *ordered], strict=False):
            if size:  # a class is off by its own rounding and by what the longer ones left over
                carried = 0 if longer is None else 0.5 * longer / size
                assert abs(copies[s][size] - classes[size] * rate(m, size)) <= 0.5 + carried + 0.02 * classes[size]


def test_mix_reruns_and_odd_tables(spark, many, none):
    rows, docs = many
    key = lambda df: Counter(map(tuple, df.select("doc_id", "size", "target", "taken").collect()))
    first = key(mix(docs))
    assert first == key(mix(docs.repartition(2).orderBy(F.desc("doc_id"))))
    assert mix(none).count() == 0
    assert key(mix(mixed_docs(spark, [(1, None), (2, ""), (None, " ")]))) == {(1, 0, 0.0, 0): 1, (2, 0, 0.0, 0): 1, (None, 0, 0.0, 0): 1}
    twice = mix(docs.union(docs))  # repeated rows are rows of their own
    assert twice.count() == 2 * len(rows) and twice.where("copies > 2").count() == 0
    same = spark.createDataFrame([(1, "a b c", "en", "s", 0)] * 90 + [(2, "a b c", "en", "t", 0)] * 10, SCHEMA)  # ties in everything
    assert {r[0]: (r[1], r[2]) for r in mix(same).groupBy("source").agg(F.sum("taken"), F.max("copies")).collect()} == {"s": (390, 2), "t": (60, 2)}
    assert mix(same).agg(F.sum("taken")).first()[0] == 450
    flat = mix(docs, tilt=0.0).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r["t"] - r["g"]) <= 2 + 1e-5 * r["g"] for r in flat)


def test_drawn(spark):
    docs = spark.createDataFrame([(k, "w " * (k + 1), "en", "ab"[k % 2], 0) for k in range(40)], SCHEMA)
    plan = mix(docs)
    assert Counter(r["doc_id"] for r in drawn(docs, plan).collect()) == Counter({r["doc_id"]: r["copies"] for r in plan.collect() if r["copies"]})


def test_words(spark):
    texts = [t for _, t in odd_texts()] + ["\x0b\x0c", "a\x85b", " a", "a ", "a", " ", "\x1c \x1f"]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", words(F.col("t"))).collect()
    assert [n for _, n in sorted(map(tuple, got))] == [len(words_of(t)) for t in texts]


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_divergence(rows, least, prior=5, top=50, scale=10**9):
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = TERM.findall(text.translate(LOWER))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= least]
        whole = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + scale * (c[t] + prior) // (total + prior * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s))
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(pairs)]
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(terms[:top])]
    return sorted(out)


def test_divergence(spark, none):
    langs = ["en", None, "de", "en", ""]
    rows = [(t, langs[k % 5], source_of(k)) for k, (_, t) in enumerate(odd_texts())]
    rows += [("Alpha beta ALPHA ÉCOLE école x1y" + " gamma" * (k % 4), "en", source_of(k)) for k in range(80)]
    rows += [(None, "xx", "only"), ("rare words", "yy", "p"), ("others", "yy", None), ("", "yy", "q")]  # no kept terms
    docs = spark.createDataFrame([(k, t, lang, source, 0) for k, (t, lang, source) in enumerate(rows)], SCHEMA).withColumn("term", F.lit("x")).withColumn("n", F.lit(1))
    for least, top in ((30, 50), (2, 3)):
        got = divergence(docs, least, top=top)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == brute_divergence(rows, least, top=top)
    assert divergence(none).count() == 0
    assert sorted(map(tuple, divergence(docs.union(docs), 60).collect())) == brute_divergence(rows * 2, 60)


def test_shares_are_exact_beyond_64_bits(spark):
    from stakescope.llm.divergence import _share

    big = 4 * 10**18
    df = spark.createDataFrame([(big, 9 * 10**18, 7)], "n long, total long, kept long")
    assert df.select(_share(F.col("n"), F.col("total"), F.col("kept"), 5, 10**9)).first()[0] == 1 + 10**9 * (big + 5) // (9 * 10**18 + 35)
