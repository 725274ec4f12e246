"""Isolation forest (Liu, Ting and Zhou 2008) on the numeric features; a score that never adds to the risk."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import quantiles
from .specs import ALL, Spec

#: Rows that a tree sees, drawn anew for each tree as in the paper; trees * SUBSAMPLE bounds what comes to the driver.
SUBSAMPLE = 256
#: Decimals to which values are rounded before they are compared.
DIGITS = 6
#: Path lengths are whole numbers of this part.
UNIT = 1_000_000_000
#: Fixed value: Euler's constant.
_EULER = 0.5772156649015329


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + _EULER) - 2 * (safe - 1) / safe, np.where(n == 2, 1.0, 0.0))


def _drawn(seed: int, tree: int, node: int) -> tuple[int, float]:
    """A whole number below 2^32 and a share below 1 for a node, the same on every engine."""
    h = hashlib.md5(f"{seed}:{tree}:{node}".encode()).hexdigest()
    return int(h[:8], 16), int(h[8:16], 16) / 2**32


def grow(x: np.ndarray, tree: int, seed: int, limit: int) -> list[tuple[int, int, int, float, int]]:
    """One tree as rows (tree, node, feature, value, credit): the root is node 1, the children of n are 2n (below value) and 2n + 1.

    Leaves have feature -1 and as credit their path length in units of UNIT. Neither child of a split is empty.
    """
    out = []
    stack = [(1, x)]
    while stack:
        node, part = stack.pop()
        depth = node.bit_length() - 1
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or not len(usable):
            out.append((tree, node, -1, 0.0, round((depth + float(average_path(np.array(len(part))))) * UNIT)))
            continue
        choice, share = _drawn(seed, tree, node)
        f = int(usable[choice % len(usable)])
        value = float(low[f] + share * (high[f] - low[f]))
        if value <= low[f]:
            value = float(high[f])
        out.append((tree, node, f, value, 0))
        below = part[:, f] < value
        stack += [(2 * node + 1, part[~below]), (2 * node, part[below])]
    return out


def subsamples(filled: DataFrame, numeric: list[str], trees: int, seed: int) -> list[np.ndarray]:
    """The rows of each tree: the SUBSAMPLE players with the smallest hashes of seed, tree and key.

    A bound on the hash that leaves a few more than that for each tree is applied before rows are multiplied, so what is
    shuffled and sorted does not grow with the players; a bound that leaves a tree too few is widened.
    """
    n = filled.count()
    wanted = min(n, SUBSAMPLE)
    margin = 2 * SUBSAMPLE
    while True:
        rank = lambda t: F.md5(F.concat_ws(":", F.lit(seed), t, "player_key"))
        ranks = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), rank(t).alias("rank")))
        if margin < n:
            bound = F.lit(f"{int(margin / n * 2**64):016x}")
            ranks = F.filter(ranks, lambda r: r["rank"] < bound)  # noqa: B023
        drawn = filled.select("player_key", *numeric, F.explode(ranks).alias("_r")).select("player_key", *numeric, "_r.*")
        order = F.row_number().over(Window.partitionBy("tree").orderBy("rank", "player_key"))
        pdf = drawn.withColumn("n", order).where(F.col("n") <= SUBSAMPLE).select("tree", "n", *numeric).toPandas().sort_values(["tree", "n"])
        if margin >= n or pdf.groupby("tree").size().reindex(range(trees), fill_value=0).min() >= wanted:
            return [pdf.loc[pdf["tree"] == t, numeric].to_numpy(float) for t in range(trees)]
        margin *= 4


def medians(wide: DataFrame, numeric: list[str]) -> dict[str, float]:
    """Exact medians of all columns that have values."""
    return {c: q[0] for c, q in quantiles(wide, {c: (0.5,) for c in numeric}).items() if q is not None}


def forest(samples: list[np.ndarray], seed: int) -> tuple[list[tuple[int, int, int, float, int]], int]:
    """All trees as one table of nodes, and the depth at which growth stops."""
    limit = int(np.ceil(np.log2(len(samples[0]))))
    return [row for tree, x in enumerate(samples) for row in grow(x, tree, seed, limit)], limit


def isolation_scores(wide: DataFrame, trees: int = 100, seed: int = 42, specs: dict[str, Spec] = ALL) -> DataFrame:
    """(player_key, iforest_score_untrusted): minus the anomaly score, so lower is odder; fewer than two players: 0.

    Missing values take the median, then 0; values are rounded to DIGITS decimals, so that equal ones are equal on every engine.
    Each tree is grown on the driver from its own SUBSAMPLE rows into a table of nodes (at most 2 * SUBSAMPLE a tree, so its
    size does not depend on the input). Players go down all trees by joins with that table, and path lengths are added as whole
    numbers, so the result does not depend on the order of rows.
    """
    numeric = [n for n, s in specs.items() if s.kind != "bool"]
    known = medians(wide, numeric)
    filled = wide.select("player_key", *(F.round(F.coalesce(F.col(n).cast("double"), F.lit(known.get(n, 0.0))), DIGITS).alias(n) for n in numeric))
    samples = subsamples(filled, numeric, trees, seed)
    if len(samples[0]) < 2:
        return wide.select("player_key", F.lit(0.0).alias("iforest_score_untrusted"))
    rows, limit = forest(samples, seed)
    nodes = F.broadcast(wide.sparkSession.createDataFrame(rows, "tree int, node int, feature int, value double, credit long"))
    inner, leaves = nodes.drop("credit"), nodes.select("tree", "node", "credit")
    at = filled.select("player_key", F.array(*numeric).alias("x"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")).withColumn("node", F.lit(1))
    step = F.when(F.col("feature") < 0, F.col("node")).otherwise(2 * F.col("node") + F.when(F.get("x", F.col("feature")) < F.col("value"), 0).otherwise(1))
    for _ in range(limit):
        at = at.join(inner, ["tree", "node"]).select("player_key", "x", "tree", step.alias("node"))
    lengths = at.join(leaves, ["tree", "node"]).groupBy("player_key").agg(F.sum("credit").alias("total"))
    scale = float(average_path(np.array(len(samples[0]))))
    return lengths.select("player_key", (-F.pow(F.lit(2.0), -(F.col("total") / F.lit(UNIT) / F.lit(trees) / F.lit(scale)))).alias("iforest_score_untrusted"))
