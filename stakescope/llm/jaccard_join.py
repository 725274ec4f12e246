"""N-gram Jaccard join with several global token orders: candidates must share a prefix token under each of them.

A document's set is its distinct word shingles. Under any global order of the shingles, two sets that overlap enough share
one among their first few; so a pair is a candidate only if that holds under all three orders used here, and only
candidates are verified. All orders put rare shingles first (by exact document counts), which keeps lists short.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import ROW, batches, dropped, n_parts, rows_of, sent, settled, spread, stored, trimmed
from .textblocks import ANSWER, ASK, TEXT, by_block, opened, text_blocks, text_rows
from .textcore import NULL_ID, U64, bounds, deltas, distinct, hash_spans, ids_of, mix, pack, string_buffers, undeltas, unpack, window_ok, windows, word_spans

#: Rounds against one document a shingle go on until so few pairs for each listed row are open, or until a round leaves more than this share open.
FEW, FALL = 4, 0.7
SETS = "row long, doc_id long, n long, s1 long, s2 long, rare long, tokens array<long>, prefix array<long>, second array<long>, third array<long>"


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, document) pairs, distinct, ordered by shingle and then document."""
    words = np.diff(first)
    ok = window_ok(first, k, len(h))
    owner = np.repeat(np.arange(len(words)), words)
    name, doc = windows(h, k)[ok], owner[: len(ok)][ok]
    short = np.flatnonzero((words > 0) & (words < k))
    if len(short):  # the whole sequence is one shingle, in a space of its own by its length
        whole = words[short].astype(U64)
        for j in range(k - 1):
            more = words[short] > j
            whole[more] = mix(whole[more] * U64(0x9E3779B97F4A7C15) + h[first[short[more]] + j])
        name, doc = np.concatenate((name, mix(whole ^ U64(0x5851F42D4C957F2D)))), np.concatenate((doc, short))
    order = np.lexsort((doc, name)) if len(short) else np.argsort(name, kind="stable")
    name, doc = name[order], doc[order]
    new = np.concatenate(([True], (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]))) if len(name) else np.zeros(0, bool)
    return name[new], doc[new]


def _ask_counts(it, k, parts):
    for block, _, _, part, s, e, first in text_blocks(it, 0, 1):
        name, _ = shingles(hash_spans(part, s, e, 0, True), first, k)
        d, _, n = distinct(name)
        edge = bounds(d, parts)
        for p in np.flatnonzero(np.diff(edge)).tolist():
            x, y = edge[p], edge[p + 1]
            yield p, block, ASK, pack(deltas(d[x:y]), n[x:y])


def _answer_counts(rows, parts):
    asked = []
    bucket = 0
    for bucket, block, _, body in rows:
        d, n = unpack(body.as_py())
        asked.append((block, undeltas(d), n))
    if not asked:
        return
    _, inverse, _ = distinct(np.concatenate([a[1] for a in asked]))
    total = np.bincount(inverse, weights=np.concatenate([a[2] for a in asked])).astype(np.int64)
    at = 0
    for block, keys, _ in asked:
        yield spread(block, parts), block, ANSWER, pack(np.array([bucket]), total[inverse[at : at + len(keys)]])
        at += len(keys)


def _sums(values, doc, docs):
    """Sums modulo 2**64 of values for each document (doc sorted)."""
    running = np.concatenate((np.zeros(1, U64), np.cumsum(values, dtype=U64)))
    edge = np.searchsorted(doc, np.arange(docs + 1))
    return running[edge[1:]] - running[edge[:-1]]


def _lists(values, doc, docs):
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(docs + 1)).astype(np.int32)), pa.array(values.view(np.int64), pa.int64()))


def _first_of(doc, limit):
    """Which places of a doc-sorted array are among the first limit[doc] of their document."""
    start = np.searchsorted(doc, np.arange(len(limit)))
    return np.arange(len(doc)) - start[doc] < limit[doc]


def _sets(rows, k, num, den):
    """Each document's size, signature, and, if its prefix holds a shingle that others have too, its shared shingles and prefixes."""
    for block, came in by_block(rows).items():
        batch = opened(came[TEXT][0])
        docs = batch.num_rows
        data, offsets = string_buffers(batch.column(1))
        s, e, first = word_spans(data, offsets)
        name, doc = shingles(hash_spans(data, s, e, 0, True), first, k)
        got = sorted((unpack(a) for a in came.get(ANSWER, ())), key=lambda a: int(a[0][0]))
        d, inverse, _ = distinct(name)
        known = np.concatenate([a[1] for a in got]).astype(np.int64) if got else np.zeros(0, np.int64)
        if len(known) != len(d):
            raise RuntimeError("texts and answers of a block come from different inputs; store the input first")
        df = known[inverse]
        n = np.bincount(doc, minlength=docs)
        rare = np.bincount(doc[df == 1], minlength=docs)
        limit = np.maximum(0, n - -(-n * num // den) + 1 - rare)
        order = np.argsort(doc, kind="stable")
        s1, s2 = _sums(name[order], doc[order], docs), _sums(mix(name[order] ^ U64(99)), doc[order], docs)
        ids = ids_of(batch.column(0))
        s1 = np.where(n == 0, np.arange(docs).astype(U64) + U64(block << 20), s1)
        use = (df > 1) & (limit[doc] > 0)
        name, doc, df = name[use], doc[use], df[use]
        level = np.frexp(df.astype(np.float64))[1]
        lists = []
        for keys in ((name, df), (mix(name ^ U64(2)), level), (mix(name ^ U64(3)), level)):
            order = np.lexsort((*keys, doc))
            own = doc[order]
            if not lists:
                lists.append(_lists(name[order], own, docs))
            head = _first_of(own, limit)
            lists.append(_lists(name[order][head], own[head], docs))
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int64()) for x in ((block << 20) + np.arange(docs), ids, n, s1.view(np.int64), s2.view(np.int64), rare)), *lists],
            names=["row", "doc_id", "n", "s1", "s2", "rare", "tokens", "prefix", "second", "third"],
        )


def shingle_sets(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str, fixed: bool) -> DataFrame:
    source = settled(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")), fixed)
    parts = n_parts(source)
    texts = source.mapInArrow(lambda it: batches(text_rows(it, 0, 1, parts)), ROW)
    asked = source.mapInArrow(lambda it: batches(_ask_counts(it, k, parts)), ROW)
    counts = stored(sent(asked, parts, lambda it: batches(_answer_counts(rows_of(it), parts))), "counts", free=True)
    out = stored(sent(texts.unionByName(counts), parts, lambda it: trimmed(_sets(rows_of(it), k, num, den)), SETS), "sets", free=True)
    dropped(counts)
    return out


def _links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Of candidate pairs (a, b): those that share a prefix shingle under the other orders too, verified by their whole sets.

    The short prefixes decide first; whole sets are joined only to the pairs that are left.
    """
    side = lambda x, *columns: sets.select(F.col("row").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in columns))
    near = pairs.join(side("a", "second", "third"), "a").join(side("b", "second", "third"), "b")
    near = near.where(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b")).select("a", "b")
    both = near.join(side("a", "n", "tokens"), "a").join(side("b", "n", "tokens"), "b")
    both = both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), F.size(F.array_intersect("tokens_a", "tokens_b")).alias("c"))
    return both.where(den * F.col("c") >= num * (F.col("n") - F.col("c"))).select("a", "b")


def _possible(a: str, b: str, num: int, den: int):
    """Sizes and places of a shared shingle that still allow the threshold (the first shared one of any linked pair does)."""
    na, nb, pa_, pb = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.place"), F.col(f"{b}.place")
    most = F.least(na - pa_, nb - pb)
    return (den * F.least(na, nb) >= num * F.greatest(na, nb)) & ((den + num) * most >= num * (na + nb))


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text", fixed: bool = False) -> DataFrame:
    """(id, n_shingles, component_id) of every row: the smallest id that links lead to.

    Words are compared with A-Z lower-cased. Two documents link when den * intersection >= num * union of their sets of
    distinct k-word shingles; fewer words make one shingle of all of them; no words or null link with nothing. A null id counts
    as smaller than any other. Repeated rows stay; an empty table gives an empty result; other columns go. fixed: docs gives
    the same partitions on every pass, as tables read from files do; otherwise it is stored first.

    Equal sets are one node from the start. Candidates are checked in rounds, so that a group of near copies does not cost all
    its pairs: for each prefix shingle, all its documents against one of them, first the one with the fewest shingles of its
    own (in a group of copies of one text, that is the text or close to it), then one of those that are not yet connected
    with it, as long as this leaves far fewer pairs open; at last, all other pairs that share a prefix shingle and are not yet
    in one component. Every pair that could link is either checked or already connected.
    """
    sets = shingle_sets(docs, k, num, den, id_col, text_col, fixed)
    same = ["n", "s1", "s2"]
    nodes = stored(sets.groupBy(*same).agg(F.min(F.struct("doc_id", "row")).alias("r")).select(*same, F.col("r.row").alias("node"), F.col("r.doc_id").alias("least")), "nodes")
    active = sets.where(F.size("prefix") > 0).select("row", "n", "rare", "prefix").join(nodes.select(F.col("node").alias("row")), "row", "left_semi")
    listed = active.select("row", "n", "rare", F.posexplode("prefix").alias("at", "token")).select("token", "row", "n", "rare", (F.col("rare") + F.col("at")).alias("place"), F.col("row").alias("root"))
    rest = stored(listed.join(listed.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token"), "token", "left_semi"), "listed")
    ends = lambda: (F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b"))
    checked, linked, found, open_pairs = None, None, None, float("inf")
    while True:
        # the head: fewest shingles of its own, of the documents whose component is not that of the last round's head
        fresh = rest
        if checked is not None:
            last = heads.join(found.withColumnRenamed("node", "row").withColumnRenamed("root", "now"), "row", "left").select("token", F.coalesce("now", "row").alias("last"))
            fresh = rest.join(last, "token").where("root <> last")
        heads = fresh.groupBy("token").agg(F.min(F.struct("rare", "row", "n", "place", "root")).alias("h")).select("token", "h.row", "h.n", "h.place", "h.root")
        heads = stored(heads, "heads")
        star = rest.alias("y").join(heads.alias("x"), "token").where((F.col("y.root") != F.col("x.root")) & _possible("x", "y", num, den)).select(*ends()).distinct()
        star = stored(star if checked is None else star.join(checked, ["a", "b"], "left_anti"), "star")
        more = stored(_links(star, sets, num, den), "links")
        checked, linked = (star, more) if checked is None else (checked.unionByName(star), linked.unionByName(more))
        found = components(linked)
        old, rest = rest, stored(_open(rest, found), "rest")
        dropped(old)
        before, (open_pairs, rows) = open_pairs, _open_pairs(rest)
        if open_pairs <= FEW * rows or open_pairs > FALL * before:
            break
    pairs = rest.alias("x").join(rest.alias("y"), "token").where((F.col("x.row") < F.col("y.row")) & (F.col("x.root") != F.col("y.root")) & _possible("x", "y", num, den))
    pairs = pairs.select(F.col("x.row").alias("a"), F.col("y.row").alias("b")).distinct()
    pairs = stored(pairs.join(checked, ["a", "b"], "left_anti"), "pairs")
    more = stored(_links(pairs, sets, num, den), "links")
    found = components(linked.unionByName(more))
    named = stored(nodes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node")), "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of = stored(named.join(least, "root").select(*same, "component_id"), "classes")
    for x in (nodes, rest, pairs, more, found, named):
        dropped(x)
    known = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return sets.select("doc_id", *same).join(of, same).select(known("doc_id").alias(id_col), F.col("n").alias("n_shingles"), known("component_id").alias("component_id"))


def _open_pairs(rest: DataFrame) -> tuple[float, int]:
    """Pairs that share a token and are in different components (a pair counts for each token), and listed rows."""
    by_root = rest.groupBy("token", "root").agg(F.count(F.lit(1)).cast("double").alias("c"))
    by_token = by_root.groupBy("token").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
    r = by_token.agg((F.coalesce(F.sum(F.col("s") * F.col("s") - F.col("q")), F.lit(0.0)) / 2).alias("p"), F.coalesce(F.sum("s"), F.lit(0.0)).alias("n")).first()
    return r["p"], int(r["n"])


def _open(rest: DataFrame, found: DataFrame) -> DataFrame:
    """Listed documents with their present root, of the tokens whose documents are not all connected."""
    marked = rest.drop("root").join(found.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    several = marked.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("token")
    return marked.join(several, "token", "left_semi").select(*rest.columns)
