"""LM scoring with a probabilistic suffix tree over words.

Contexts are the last words before a word, as many as the corpus bears out: a context is a candidate if it stands LEAST
times in the training texts, and it is retained if its next-word counts diverge from those of its suffix (the context
without its first word) by more than the cost of describing them. Contexts of up to SURE words are all tested; longer ones
where their suffix was retained, level by level until none is, so depth follows the divergence test without a bound on
length or number. Where the next-word counts of a context hold less information than one description costs, no longer
context can be retained (the divergence of all that extends it is at most that), and growth stops there as well, which
loses nothing. A word's probability comes from the longest retained suffix of what stands before it, smoothed by
interpolation with the next shorter one down to the base. Counts of words, of (context, word) pairs and sums over contexts
are exact, over all training documents, and stay distributed: each block of texts asks for those that it needs. Words get
numbers by their frequency, in which all that follows is written; a context is decided on where its counts are added up.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ROW, batches, dropped, n_parts, rows_of, sent, spread, stored
from .textblocks import text_blocks
from .textcore import NULL_ID, U64, bounds, deltas, distinct, hash_spans, mix, pack, undeltas, unpack

#: The count that a context must have, and the length up to which contexts are tested whatever came of their suffixes.
LEAST, SURE = 8, 1
#: Next words of a context with more sightings than this are dealt to several buckets.
SPLIT = 20_000
#: Text bytes of a block.
BLOCK_BYTES = 2_000_000
#: Open places for each partition at least; levels with few of them use fewer partitions.
PART_PLACES = 200_000
#: Parts of the blocks that take their answers one after the other on the first levels, whose states are large.
TURNS = 4
#: COUNTS and CONTEXTS answer the blocks; the latter about contexts whose words are dealt to several buckets.
STATE, ASK, ANSWER, CONTEXT, SUM, TOTAL_N, TOTAL_V, COUNT, COUNTS, CONTEXTS = range(10)
KEPT, OPEN = 1, 2
_END = mix(np.array([0x454E44], U64))[0]
_R, _R2 = U64(0x9E3779B97F4A7C15), U64(0xD1342543DE82EF95)


def tokenized(it, parts):
    """Each block as word numbers of its own (frequent words first), and its distinct words with their training counts by bucket."""
    for block, rows, ids, part, s, e, first in text_blocks(it, 0, 1, BLOCK_BYTES):
        words, docs = hash_spans(part, s, e, 0, True), len(first) - 1
        h = np.full(len(words) + docs, _END)
        owner = np.repeat(np.arange(docs), np.diff(first))
        h[np.arange(len(words)) + owner] = words
        length = np.diff(first) + 1
        train = rows.column(2).to_numpy(zero_copy_only=False).astype(bool)
        keys, at, n = distinct(h)
        order = np.argsort(-n, kind="stable")
        number = np.empty(len(keys), np.int64)
        number[order] = np.arange(len(keys))
        yield spread(block, parts), block, STATE, pack(ids.view(U64), train, length, number[at], order)
        learnt = np.bincount(at, weights=np.repeat(train, length), minlength=len(keys)).astype(np.int64)
        edge = bounds(keys, parts)
        for p in np.flatnonzero(np.diff(edge)).tolist():
            i, j = edge[p], edge[p + 1]
            yield p, block, ASK, pack(deltas(keys[i:j]), learnt[i:j])


def _answers(came, tag, columns):
    """Columns of the answers of all buckets, in the order of the keys."""
    got = sorted((unpack(a) for a in came.get(tag, ())), key=lambda a: int(a[0][0]))
    return [np.concatenate(x) for x in zip(*(a[1:] for a in got), strict=True)] if got else [np.zeros(0, np.int64)] * columns


class Block:
    """A block at a level: tokens in runs that contexts cannot leave, and the places whose context of level words is asked about next.

    Of each place: its document, the count of its context or the most that it can be, the count of the word after the
    suffix and that of the suffix, and the word's probability so far. Of each document: its results so far.
    """

    DOCS = ("ids", "train", "n_tokens", "n_known", "base", "score")

    @classmethod
    def first(cls, body, came, n_tokens, n_words, limit) -> Block:
        b = cls()
        b.limit = limit
        ids, train, length, at, order = unpack(body)
        count, ident = _answers(came, ANSWER, 2)
        if len(count) != len(order):
            raise RuntimeError("a block's words and their counts come from different inputs; store the input first")
        order, length = order.astype(np.int64), length.astype(np.int64)
        by_number = np.argsort(ident[order], kind="stable")
        place = np.empty(len(order), np.int64)
        place[by_number] = np.arange(len(order))
        order = order[by_number]
        b.count, b.ident, b.at = count.astype(np.int64)[order], ident.astype(U64)[order], place[at.astype(np.int64)]
        b.ids, b.train, b.n_tokens, b.level = ids.astype(U64).view(np.int64), train.astype(bool), length, 1
        first = np.concatenate(([0], np.cumsum(length)))
        n = b.count[b.at]
        sums = lambda v: np.diff(np.concatenate(([0], np.cumsum(v)))[first])
        p = _base(n, n_tokens, n_words)
        before = np.concatenate(([0], n[:-1])) if len(n) else n
        before[first[:-1]] = 0  # no context crosses documents, nor holds a word seen less than LEAST times
        b.cut = before < LEAST
        b.pos = np.flatnonzero(~b.cut)
        b.doc = np.repeat(np.arange(len(length)), length)[b.pos]
        b.most, b.seen, b.of, b.p = before[b.pos], n[b.pos], np.full(len(b.pos), max(1, n_tokens)), p[b.pos]
        log = np.log10(p)
        b.n_known, b.base = sums((n > 0).astype(np.int64)), sums(log)
        log[b.pos] = 0
        b.score = sums(log)
        return b

    def pack(self) -> bytes:
        """Tokens that no open place's context can reach go."""
        start = self._start()
        many = len(self.at) + 1
        keep = np.cumsum(np.bincount(start, minlength=many) - np.bincount(self.pos + 1, minlength=many))[:-1] > 0
        cut = self.cut.copy()
        cut[1:] |= ~keep[:-1]
        used, at, _ = distinct(self.at[keep])
        order = np.argsort(self.ident[used], kind="stable")
        place = np.empty(len(used), np.int64)
        place[order] = np.arange(len(used))
        used, pos = used[order], (np.cumsum(keep) - 1)[self.pos]
        docs = [self.ids.view(U64), *(getattr(self, n) for n in self.DOCS[1:])]
        far = np.flatnonzero(self.most >= self.limit)
        values = [self.seen, self.of, self.p, np.diff(far, prepend=0), self.most[far]]
        if self.level == 1:
            values = []
        elif self.level == 2:
            values[1:3] = [self.kinds]
        return pack(np.array([self.level, int(keep.sum())]), *docs, deltas(self.ident[used]), self.count[used], place[at], np.packbits(cut[keep]), np.diff(pos, prepend=0), np.diff(self.doc, prepend=0), *values)

    @classmethod
    def unpacked(cls, body, n_tokens, n_words, limit) -> Block:
        """What a place holds before level one follows from its words' counts, and p after it from whole numbers, which are shorter."""
        b = cls()
        (level, tokens), *values = unpack(body)
        docs, (ident, count, at, cut, pos, doc, *values) = values[: len(cls.DOCS)], values[len(cls.DOCS) :]
        b.level, b.limit = int(level), limit
        for n, v in zip(cls.DOCS, docs, strict=True):
            setattr(b, n, v)
        b.ids, b.train = b.ids.astype(U64).view(np.int64), b.train.astype(bool)
        b.ident, b.count, b.at, b.cut = undeltas(ident), count.astype(np.int64), at.astype(np.int64), np.unpackbits(cut, count=int(tokens)).astype(bool)
        b.pos, b.doc = np.cumsum(pos.astype(np.int64)), np.cumsum(doc.astype(np.int64))
        if b.level == 1:
            b.seen, b.most = b.count[b.at[b.pos]], b.count[b.at[b.pos - 1]]
            b.of, b.p = np.full(len(b.pos), max(1, n_tokens)), _base(b.seen, n_tokens, n_words)
            return b
        seen, *between, far, most = values
        b.seen = seen.astype(np.int64)
        if b.level == 2:  # something follows each sighting of a word, be it the end
            b.of = b.count[b.at[b.pos - 1]]
            kinds = between[0].astype(np.float64)
            base = _base(b.count[b.at[b.pos]], n_tokens, n_words)
            b.p = np.where(kinds > 0, (b.seen + kinds * base) / (b.of + kinds), base)
        else:
            b.of, b.p = between[0].astype(np.int64), np.array(between[1])
        b.most = np.zeros(len(b.pos), np.int64)
        b.most[np.cumsum(far.astype(np.int64))] = most
        return b

    def _start(self) -> np.ndarray:
        """Where the run begins that each place's context lies in."""
        run = np.flatnonzero(self.cut)
        return np.repeat(run, np.diff(np.append(run, len(self.cut))))[self.pos - 1]

    def pairs(self, parts) -> None:
        """Distinct (context, next word) pairs, by unit; a context with many next words has several units. Units stand by bucket, then by their words."""
        before = [self.at[self.pos - n] for n in range(1, self.level + 1)]
        self.key = _context(self.ident[w] for w in before)
        word = self.at[self.pos]
        known = self.count[word] > 0
        hot = np.flatnonzero(self.most >= self.limit)
        salt = mix(self.ident[word[hot]]) % (1 + self.most[hot] // self.limit).astype(U64) * known[hot]
        unit = self.key.copy()
        unit[hot] = _salted(self.key[hot], salt)
        units, unit_at, _ = distinct(unit)
        example = np.empty(len(units), np.int64)
        example[unit_at] = np.arange(len(unit_at))
        edge, width = bounds(units, parts), max(1, len(self.count))
        order = np.repeat(np.arange(parts), np.diff(edge))
        for w in before[:2]:
            order = order * width + w[example]
        order = np.argsort(order, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.unit_at, self.edge = place[unit_at], edge
        self.words = [w[example[order]] for w in before]
        self.split, self.salt = np.zeros(len(units), bool), np.zeros(len(units), U64)
        self.split[self.unit_at[hot]], self.salt[self.unit_at[hot]] = True, salt
        self.apart = np.unique(self.key[hot])
        self.learnt = self.train[self.doc]
        self.asks = asks = known & (self.seen > 0)  # what never stands after the suffix never stands after the context
        pair, self.pair_at, _ = distinct(self.unit_at[asks] * width + word[asks])
        self.pair_unit, self.pair_word = pair // width, pair % width
        self.n = np.bincount(self.pair_at, weights=self.learnt[asks], minlength=len(pair)).astype(np.int64)

    def ask(self, block, parts):
        """Pairs with their training counts by bucket, and what the block's training words say of each context's divergence."""
        self.pairs(parts)
        sizes = np.bincount(self.pair_unit, minlength=len(self.split))
        upto = np.concatenate(([0], np.cumsum(sizes)))
        of, seen = np.zeros(len(sizes), np.int64), np.zeros(len(self.pair_unit), np.int64)
        of[self.unit_at], seen[self.pair_at] = self.of, self.seen[self.asks]
        home = bounds(self.apart, parts)
        for p in np.flatnonzero(np.diff(home)).tolist():
            yield p, block, CONTEXT, pack(deltas(self.apart[home[p] : home[p + 1]]))
        last, *more = (self.ident[w] for w in self.words)
        for p in np.flatnonzero(np.diff(self.edge)).tolist():
            x, y = self.edge[p], self.edge[p + 1]
            i, j = upto[x], upto[y]
            split = np.flatnonzero(self.split[x:y])
            yield p, block, ASK, pack(deltas(last[x:y]), sizes[x:y], self.ident[self.pair_word[i:j]], self.n[i:j], seen[i:j], of[x:y], split, self.salt[x:y][split], *(w[x:y] for w in more))

    def advance(self, came, parts) -> None:
        """Probabilities with the retained contexts of this level, and the places whose longer contexts are tested next."""
        self.pairs(parts)
        totals, n, kinds, flags = _answers(came, COUNTS, 4)
        if len(totals) != len(self.n):
            raise RuntimeError("a block's pairs and their counts come from different inputs; store the input first")
        mine = np.zeros(len(self.pos), np.int64)
        mine[self.asks] = totals.astype(np.int64)[self.pair_at]
        n, kinds, flags = n.astype(np.int64)[self.unit_at], kinds.astype(np.int64)[self.unit_at], flags[self.unit_at]
        far = np.flatnonzero(self.split[self.unit_at])
        if len(far):
            where = np.searchsorted(self.apart, self.key[far])
            for to, x in zip((n, kinds, flags), _answers(came, CONTEXTS, 3), strict=True):
                to[far] = x[where]
        kept = (flags & KEPT) > 0
        self.p[kept] = (mine[kept] + kinds[kept] * self.p[kept]) / (n[kept] + kinds[kept])
        seen = np.full(len(self.at), -1, np.int64)
        seen[self.pos] = mine
        if self.level == 1:  # no candidate holds two neighbours that stand together less than LEAST times
            self.cut |= seen < LEAST
        self.level += 1
        alive = (flags & OPEN) > 0
        if self.level > SURE:
            alive &= kept
        alive &= self.pos - self.level >= self._start()
        before = seen[self.pos - 1]  # the count of the longer context, where its last word was asked for
        at = np.flatnonzero(alive & ((before < 0) | (before >= LEAST)))
        gone = np.ones(len(self.pos), bool)
        gone[at] = False
        self.score = self.score + np.bincount(self.doc[gone], weights=np.log10(self.p[gone]), minlength=len(self.ids))
        self.pos, self.doc, self.seen, self.of, self.p = self.pos[at], self.doc[at], mine[at], n[at], self.p[at]
        self.most, self.kinds = np.where(before[at] < 0, self.of, before[at]), np.where(kept, kinds, 0)[at]


def _context(words) -> np.ndarray:
    """Keys of contexts, given their last words, the words before those, and so on."""
    key = U64(0)
    for n, w in enumerate(words, 1):
        key = mix(key * _R2 + w + U64(n))
    return key


def _salted(key, salt):
    """Units of contexts whose next words are dealt to several buckets."""
    return np.where(salt > 0, mix(key + salt * _R), key)


def _blocks(rows):
    """Each block's state, and what has come for it."""
    blocks: dict[int, dict[int, list]] = {}
    for _, block, tag, body in rows:
        blocks.setdefault(block, {}).setdefault(tag, []).append(body)
    for block in list(blocks):
        came = blocks.pop(block)
        if len(came.get(STATE, ())) != 1:
            raise RuntimeError("a block and its answers come from different inputs; store the input first")
        came = {tag: [x.as_py() for x in bodies] for tag, bodies in came.items()}
        yield block, came[STATE][0], came


def _base(count, n_tokens, n_words):
    return (count + 0.1) / (n_tokens + 0.1 * (n_words + 1))


def _cost(n_tokens) -> float:
    return 0.5 * float(np.log(max(2, n_tokens)))


def _home(block, parts):
    """A block's partition in a round; parts: all partitions, and those of the round."""
    return spread(block, parts[0]) * parts[1] // parts[0]


def _given(bucket, asked, tag, parts, *values):
    """The answers to each block; values: arrays with the number of their entries for each block."""
    upto = [0] * len(values)
    for block, *many in asked:
        part = []
        for k, (v, n) in enumerate(zip(values, many, strict=True)):
            part.append(v[upto[k] : upto[k] + n])
            upto[k] += n
        yield _home(block, parts), block, tag, pack(np.array([bucket]), *part)


def _answer_words(rows, parts):
    """Each word's training count, and its number: by rank in the bucket, so that frequent words have small ones."""
    asked, keys, ns, bucket = [], [], [], 0
    for bucket, block, _, body in rows:
        d, n = unpack(body.as_py())
        asked.append((block, len(d), len(d)))
        keys.append(undeltas(d))
        ns.append(n)
    if asked:
        d, inverse, _ = distinct(np.concatenate(keys))
        total = np.bincount(inverse, weights=np.concatenate(ns)).astype(np.int64)
        number = np.empty(len(d), np.int64)
        number[np.argsort(-total, kind="stable")] = np.arange(len(d)) * parts[0] + bucket
        number[total == 0] = 0
        yield from _given(bucket, asked, ANSWER, parts, total[inverse], number[inverse])
        yield 0, int(total.sum()), TOTAL_N, b""
        yield 0, int((total > 0).sum()), TOTAL_V, b""


def _answer_pairs(rows, parts, cost):
    """Counts of (context, word) pairs, and what is decided on contexts that are whole here; others' sums go to their own bucket."""
    asked, came, apart, bucket = [], [], [], 0
    for bucket, block, kind, body in rows:
        if kind == CONTEXT:
            yield bucket, block, kind, body.as_py()
            continue
        last, size, x, n, seen, of, at, salt, *more = unpack(body.as_py())
        key, at = _context([undeltas(last), *(w.astype(U64) for w in more)]), at.astype(np.int64)
        unit = key.copy()
        unit[at] = _salted(key[at], salt.astype(U64))
        asked.append((block, len(x), *[len(unit)] * 3))
        narrow = lambda a: a.astype(np.uint32 if not len(a) or int(a.max()) < 1 << 32 else U64)
        came.append((unit, size.astype(np.int64), *map(narrow, (x, n, seen, of))))
        apart.append((unit[at], key[at]))
    if not asked:
        return
    units, sizes, words, ns, seen, of = map(np.concatenate, zip(*came, strict=True))
    del came
    keys, unit_at, _ = distinct(units)
    row = np.repeat(unit_at, sizes)
    pair = mix(keys[row] * _R + words.astype(U64))
    del units, sizes, words
    d, inverse, _ = distinct(pair)
    del pair
    total = np.bincount(inverse, weights=ns, minlength=len(d)).astype(np.int64)
    unit_of, suffix, context_of = np.empty(len(d), np.int64), np.ones(len(d)), np.ones(len(keys))
    unit_of[inverse], suffix[inverse], context_of[unit_at] = row, np.maximum(seen, 1), np.maximum(of, 1)
    del row
    known = total > 0
    c, unit_of = total[known].astype(np.float64), unit_of[known]
    n, kinds, logs, cross = (np.bincount(unit_of, weights=w, minlength=len(keys)) for w in (c, np.ones(len(c)), c * np.log(c), c * np.log(suffix[known])))
    cross -= n * np.log(context_of)
    flags = _flags(n, kinds, logs, cross, cost)
    yield from _given(bucket, asked, COUNTS, parts, total[inverse], n.astype(np.int64)[unit_at], kinds.astype(np.int64)[unit_at], flags[unit_at])
    name, away = keys.copy(), np.zeros(len(keys), bool)
    for unit, context in apart:
        i = np.searchsorted(keys, unit)
        name[i], away[i] = context, True
    at = np.flatnonzero(away)
    at = at[np.argsort(name[at])]
    edge = bounds(name[at], parts[1])
    for p in np.flatnonzero(np.diff(edge)).tolist():
        i = at[edge[p] : edge[p + 1]]
        yield p, 0, SUM, pack(deltas(name[i]), n[i].astype(np.int64), kinds[i].astype(np.int64), logs[i], cross[i])


def _flags(n, kinds, logs, cross, cost):
    """Whether a context is retained, and whether longer ones can be (rounding must not close what is open by a hair)."""
    own = n * np.log(np.maximum(n, 1))
    return ((n >= LEAST) * ((logs - own - cross > kinds * cost) * KEPT + (own - logs > cost * (1 - 1e-9)) * OPEN)).astype(np.uint8)


def _answer_contexts(rows, parts, cost):
    """Of each asked context whose words lie in several buckets: its count, its number of next words, and what is decided on it."""
    asked, keys, sums, bucket = [], [], [], 0
    for bucket, block, kind, body in rows:
        if kind == SUM:
            d, *values = unpack(body.as_py())
            sums.append((undeltas(d), *(v.astype(np.float64) for v in values)))
        else:
            keys.append(undeltas(unpack(body.as_py())[0]))
            asked.append((block, *[len(keys[-1])] * 3))
    if not asked:
        return
    edge = sum(map(len, keys))
    d, inverse, _ = distinct(np.concatenate([*keys, *(s[0] for s in sums)]))
    n, kinds, logs, cross = (np.bincount(inverse[edge:], weights=np.concatenate([s[k] for s in sums] or [np.zeros(0)]), minlength=len(d)) for k in (1, 2, 3, 4))
    i, flags = inverse[:edge], _flags(n, kinds, logs, cross, cost)
    yield from _given(bucket, asked, CONTEXTS, parts, n[i].astype(np.int64), kinds[i].astype(np.int64), flags[i])


def _begun(rows, parts, totals):
    for block, state, came in _blocks(rows):
        b = Block.first(state, came, *totals)
        yield spread(block, parts), block, STATE, b.pack()
        yield 0, len(b.pos), COUNT, b""


def _ask_pairs(rows, parts, totals):
    for block, state, _ in _blocks(rows):
        yield from Block.unpacked(state, *totals).ask(block, parts)


def _advanced(rows, parts, totals):
    for block, state, came in _blocks(rows):
        b = Block.unpacked(state, *totals)
        b.advance(came, parts[1])
        yield spread(block, parts[0]), block, STATE, b.pack()
        yield 0, len(b.pos), COUNT, b""


def _results(rows, totals):
    for _, state, _ in _blocks(rows):
        b = Block.unpacked(state, *totals)
        docs = len(b.ids)
        out = [pa.array(b.ids, pa.int64(), mask=b.ids == NULL_ID), pa.array(~b.train), pa.array(b.n_tokens.astype(np.int64)), pa.array(b.n_known.astype(np.int64))]
        out += [pa.array(np.full(docs, totals[0]), pa.int64()), pa.array(b.base, pa.float64()), pa.array(b.score, pa.float64())]
        yield pa.RecordBatch.from_arrays(out, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def _in_turns(df, parts, fn, turns, free=True):
    """What fn makes of the rows of each partition, stored; a part of the partitions (three at least) is exchanged at a time."""
    each = min(parts, max(3, -(-parts // turns)))
    turn = lambda k: df.where(f"to div {each} = {k}").withColumn("to", F.expr(f"to % {each}"))
    return [stored(sent(turn(k), each, fn), "state", free=free) for k in range(-(-parts // each))]


def _all(tables):
    return reduce(DataFrame.unionByName, tables)


def score(docs: DataFrame, training, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    training: a boolean column; the model learns from rows where it holds (null: not). Words are lower-cased in A-Z; each
    text ends with an end token; a null text is its end token alone. Ids must be integers; a null id stays null, repeated
    rows are rows of their own. With no training rows, all tokens are unknown and score equals base_score. An empty table
    gives an empty result.

    One level of context length is a round: blocks ask the buckets of their contexts, and go on with the answers.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(training, F.lit(False)).alias("train"))
    parts = n_parts(source)
    begun = stored(source.mapInArrow(lambda it: batches(tokenized(it, parts)), ROW), "tokens", by="tag", free=True)
    words = stored(sent(begun.where(F.col("tag") == ASK), parts, lambda it: batches(_answer_words(rows_of(it), (parts, parts)))), "words", free=True)
    dropped(begun, f"tag={ASK}")
    sums = {r["tag"]: r["n"] for r in words.where(F.col("tag").isin(TOTAL_N, TOTAL_V)).groupBy("tag").agg(F.sum("block").alias("n")).collect()}
    totals = n_tokens, *_ = sums.get(TOTAL_N, 0), sums.get(TOTAL_V, 0), SPLIT
    cost, level = _cost(n_tokens), 1
    tables = _in_turns(begun.where(F.col("tag") == STATE).unionByName(words.where(F.col("tag") == ANSWER)), parts, lambda it: batches(_begun(rows_of(it), parts, totals)), TURNS)
    dropped(begun)
    dropped(words)
    while places := _all(tables).where(F.col("tag") == COUNT).agg(F.sum("block")).first()[0]:
        some = parts if level == 1 else int(max(1, min(parts, -(-places // PART_PLACES))))
        state = _all(tables).where(F.col("tag") == STATE).withColumn("to", F.expr(f"cast(cast(to as long) * {some} div {parts} as int)"))
        asked = state.mapInArrow(lambda it, p=some: batches(_ask_pairs(rows_of(it), p, totals)), ROW)
        pairs = stored(sent(asked, some, lambda it, p=(parts, some): batches(_answer_pairs(rows_of(it), p, cost))), "pairs", free=level < 4)
        found = stored(sent(pairs.where(F.col("tag").isin(SUM, CONTEXT)), some, lambda it, p=(parts, some): batches(_answer_contexts(rows_of(it), p, cost))), "contexts")
        both = state.unionByName(pairs.where(F.col("tag") == COUNTS)).unionByName(found)
        old, level = [*tables, pairs, found], level + 1
        tables = _in_turns(both, some, lambda it, p=(parts, some): batches(_advanced(rows_of(it), p, totals)), TURNS if level < 4 else 1, free=level < 5)
        for x in old:
            dropped(x)
    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = _all(tables).where(F.col("tag") == STATE).mapInArrow(lambda it: _results(rows_of(it), totals), schema)
    return out.withColumnRenamed("id", id_col)
