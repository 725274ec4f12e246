"""Exact quantiles by distributed selection: no task and no driver ever holds more than a bounded part of a column."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values that one task may select from at the end.
LIMIT = 1_000_000
#: A sketch places a rank to within rows / ACCURACY; the bracket around it is twice as wide on either side.
ACCURACY = 2_000


def _inside(x: Column, bracket: tuple) -> Column:
    low, high = bracket
    held = x.isNotNull()
    if low is not None:
        held = held & (x >= F.lit(low))
    return held if high is None else held & (x <= F.lit(high))


def selected(df: DataFrame, ranks: list[tuple[str, int]], counts: dict[str, int], limit: int = LIMIT, accuracy: int = ACCURACY) -> dict[tuple[str, int], float]:
    """The value of each (column, rank from 0) in the column's ascending order; counts: values of each column.

    Rounds over the table, all columns and ranks at once: a sketch gives two values of the column that should enclose the
    rank; exact counts below, inside and up to them prove it and say what rank to look for inside. Each round keeps about
    4 / accuracy of a bracket, until its first value is the one or it holds at most `limit` rows, of which one task takes it.
    """
    found: dict[tuple[str, int], float] = {}
    state = {key: (None, None, key[1], counts[key[0]]) for key in ranks}  # bracket, rank in it, rows in it
    margin = 2 / accuracy
    while state:
        small = {k: s for k, s in state.items() if s[3] <= limit}
        if small:
            keys = list(small)
            rows = df.select(*(F.when(_inside(F.col(c), small[c, r][:2]), F.col(c)).alias(f"v{i}") for i, (c, r) in enumerate(keys)))
            exact = [F.expr(f"percentile_disc({(small[k][2] + 0.5) / small[k][3]!r}D) WITHIN GROUP (ORDER BY v{i})") for i, k in enumerate(keys)]  # the first value with more than rank values up to it
            found |= {k: float(v) for k, v in zip(keys, rows.agg(*exact).first(), strict=True)}
        state = {k: s for k, s in state.items() if k not in small}
        if not state:
            break
        keys, sketches = list(state), []
        for i, (c, r) in enumerate(keys):
            low, high, rank, n = state[c, r]
            at = [min(1.0, max(0.0, rank / n + d)) for d in (-margin, margin)]
            sketches.append(F.approx_percentile(F.when(_inside(F.col(c), (low, high)), F.col(c)), F.array(*map(F.lit, at)), F.lit(accuracy)).alias(f"s{i}"))
        pivots = [tuple(x) for x in df.agg(*sketches).first()]
        tallies = []
        for i, ((c, r), (a, b)) in enumerate(zip(keys, pivots, strict=True)):
            held, x = _inside(F.col(c), state[c, r][:2]), F.col(c)
            tallies += [F.count_if(held & (x < F.lit(a))).alias(f"b{i}"), F.count_if(held & (x >= F.lit(a)) & (x <= F.lit(b))).alias(f"i{i}"), F.count_if(held & (x == F.lit(a))).alias(f"e{i}"), F.max(F.when(held & (x < F.lit(a)), x)).alias(f"l{i}"), F.min(F.when(held & (x > F.lit(a)), x)).alias(f"n{i}"), F.min(F.when(held & (x > F.lit(b)), x)).alias(f"h{i}")]
        row = df.agg(*tallies).first()
        for i, (key, (a, b)) in enumerate(zip(keys, pivots, strict=True)):
            low, high, rank, n = state[key]
            below, inside = row[f"b{i}"], row[f"i{i}"]
            if rank < below:  # the sketch was off: what lies below is searched
                state[key] = (low, row[f"l{i}"], rank, below)
            elif rank >= below + inside:
                state[key] = (row[f"h{i}"], high, rank - below - inside, n - below - inside)
            elif rank < below + row[f"e{i}"]:
                found[key] = float(a)
                del state[key]
            else:  # the first value goes each time, so a bracket always shrinks
                state[key] = (row[f"n{i}"], b, rank - below - row[f"e{i}"], inside - row[f"e{i}"])
    return found


def quantiles(df: DataFrame, asked: dict[str, tuple[float, ...]], limit: int = LIMIT, accuracy: int = ACCURACY) -> dict[str, list[float] | None]:
    """Exact quantiles of columns, with linear interpolation between ranks; null values take no part, a column without values gives none."""
    if not asked:
        return {}
    df = df.select(*(F.col(c).cast("double").alias(c) for c in asked))
    counts = df.agg(*(F.count(c).alias(c) for c in asked)).first().asDict()
    spots = {(c, p): p * (counts[c] - 1) for c, at in asked.items() for p in at if counts[c]}
    ranks = sorted({(c, int(f(x))) for (c, _), x in spots.items() for f in (math.floor, math.ceil)})
    value = selected(df, ranks, counts, limit, accuracy)

    def at(c: str, p: float) -> float:
        x = spots[c, p]
        low, high = math.floor(x), math.ceil(x)
        return value[c, low] if low == high or value[c, low] == value[c, high] else (high - x) * value[c, low] + (x - low) * value[c, high]

    return {c: [at(c, p) for p in ps] if counts[c] else None for c, ps in asked.items()}
