"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Among all rates of its documents that meet the target and stay between 0 and `most`,
those nearest to 1 in relative entropy are exponentially tilted: min(most, exp(multiplier * size ** tilt)). The multipliers,
one for each source, solve the convex dual; Newton steps on its gradient are Spark aggregations over classes of documents
with equal source and size. Rates are then rounded into copies.
"""

from __future__ import annotations

import math
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import ranked
from .shared import n_parts, settled, shared_dir, stored

#: A source is solved when its expected words are so near its target, as a share; sums are exact, in parts of UNIT.
NEAR, UNIT = 1e-6, 10**9
MOST_STEPS = 200
_KEY = ["_none", "_source"]


def words(text: Column) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+: each, with what stands before it, becomes one letter; nothing is listed."""
    blank = r"\x20\x09-\x0D"
    return F.length(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{blank}]*+[^{blank}]++", "x"), f"[{blank}]++", "")).cast("long")


class _Steps:
    """Tables of one run, below one folder that is emptied at the end."""

    def __init__(self, spark):
        self.spark, self.path, self.n = spark, f"{shared_dir(spark)}/mix-{uuid.uuid4().hex}", 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.n += 1
        at = f"{self.path}/{self.n}"
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def end(self) -> None:
        self.spark.createDataFrame([], "gone int").write.mode("overwrite").parquet(self.path)


def weighted(sources: DataFrame, weights: tuple[int, ...], buckets: int, step) -> DataFrame:
    """Sources in code point order, null last, with the weights in turn; numbered without one task that holds them all."""
    dealt = step(sources.repartitionByRange(buckets, *_KEY).withColumn("_part", F.spark_partition_id()))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    before = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*_KEY)) - 1 + F.col("_before")
    turn = F.array(*(F.lit(w) for w in weights))
    return dealt.join(before, "_part").withColumn("_place", place).withColumn("_weight", F.get(turn, F.pmod("_place", F.lit(len(weights))).cast("int"))).drop("_part", "_n", "_before", "_place")


def targets(sources: DataFrame, share: float, most: int) -> DataFrame:
    """`target` of each source: the weights share `share` times all words; targets stop at `most` times the source's size, and what is over is shared by weight again until none is above."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * most
    level, above = 0.0, None
    while True:  # the level only rises, so each round ends at least one more source
        full = cap <= F.col("_weight") * level
        words_full, weight_left, n = sources.agg(F.sum(F.when(full, cap).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("_weight"))), F.sum(full.cast("long"))).first()
        if not weight_left or n == above:
            break
        above, level = n, (share * total - words_full) / weight_left
    return sources.withColumn("target", F.when(cap <= F.col("_weight") * level, cap.cast("double")).otherwise(F.col("_weight") * F.lit(level)) if weight_left else cap.cast("double"))


def _exponent(multiplier: str, tilt: float) -> Column:
    return F.col(multiplier) * F.pow(F.col("size").cast("double"), F.lit(tilt))


def solved(classes: DataFrame, sources: DataFrame, most: int, tilt: float, step) -> DataFrame:
    """Sources with the multiplier that meets their target.

    Newton steps on the logarithm of the expected words (where the target is above the source's words: of what they leave of
    the cap), which is near a line; kept inside a bracket: below its lower end the words are too few, above its upper end too
    many. Sums are exact whole numbers, so that reruns and other partitions give the same bits.
    """
    least = classes.where("size > 0").groupBy(*_KEY).agg(F.min("size").alias("_least"))
    x = F.pow(F.col("_least").cast("double"), F.lit(tilt))
    low, high = F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) / x), F.log(F.lit(float(most))) / x
    full = F.col("target") >= F.col("source_size") * (most * (1 - NEAR))
    state = step(
        sources.join(least, _KEY).where("target > 0")
        .select(*_KEY, "source_size", "target", F.when(full, high).otherwise(F.lit(0.0)).alias("multiplier"), low.alias("_low"), high.alias("_high"), full.alias("_done"))
    )
    power = _exponent("multiplier", tilt)
    rate = F.when(power < math.log(most), F.exp(power)).otherwise(F.lit(float(most)))
    mass = (F.col("n") * F.col("size")).cast("decimal(20,0)")
    exact = lambda v: F.sum(mass * F.round(v).cast("decimal(18,0)")).cast("double")
    for _ in range(MOST_STEPS):
        open_, done = state.where(~F.col("_done")), state.where("_done")
        if open_.isEmpty():
            return done
        at = classes.join(open_.select(*_KEY, "multiplier"), _KEY).groupBy(*_KEY).agg(
            (exact(rate * UNIT) / UNIT).alias("_words"), (exact(F.when(power < math.log(most), rate * F.pow(F.col("size").cast("double"), F.lit(tilt)) * 1e6).otherwise(0.0)) / 1e6).alias("_slope")
        )
        few = F.col("_words") < F.col("target")
        low, high = F.when(few, F.col("multiplier")).otherwise(F.col("_low")), F.when(few, F.col("_high")).otherwise(F.col("multiplier"))
        left, aim = F.col("source_size") * most - F.col("_words"), F.col("source_size") * most - F.col("target")
        step_down = F.log(F.col("_words") / F.col("target")) * F.col("_words")  # F.log of what is not positive is null
        newton = F.col("multiplier") - F.when(F.col("target") > F.col("source_size"), -F.log(left / aim) * left).otherwise(step_down) / F.nullif(F.col("_slope"), F.lit(0.0))
        inside = (newton > low) & (newton < high)
        done_now = (F.abs(F.col("_words") - F.col("target")) <= NEAR * F.col("target")) | (high - low <= 1e-15)
        after = F.when(done_now, F.col("multiplier")).when(F.coalesce(inside, F.lit(False)), newton).otherwise((low + high) / 2)
        moved = open_.join(at, _KEY).select(*_KEY, "source_size", "target", after.alias("multiplier"), low.alias("_low"), high.alias("_high"), done_now.alias("_done"))
        state = step(done.unionByName(moved))
    raise RuntimeError(f"a source is not solved after {MOST_STEPS} steps")


def rounded(most: int, tilt: float):
    """Copies of the classes of one source, longest documents first; what rounding leaves over goes to the next class, so the smallest settle the sum."""

    def classes_of_source(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False, kind="stable", ignore_index=True)
        copies, left = [], 0.0
        for n, size, multiplier in zip(rows["n"].tolist(), rows["size"].tolist(), rows["multiplier"].tolist(), strict=True):
            if size == 0:
                copies.append(n)
                continue
            power = multiplier * float(size) ** tilt
            want = n * size * (math.exp(power) if power < math.log(most) else float(most)) + left
            taken = min(most * n, max(0, math.floor(want / size + 0.5)))
            left = want - taken * size
            copies.append(taken)
        return rows[[*_KEY, "size"]].assign(_copies=copies, _n=rows["n"])

    return classes_of_source


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, tilt: float = 1.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", fixed: bool = False
) -> DataFrame:
    """How often the mix takes each document.

    Sources in code point order, null last, have the weights in turn and share `share` times all words; no source gives more
    than `most` times its words. Size of a document: its words (null: 0). tilt: 1 is plain entropy balancing, each document
    counting alike, which takes a lack from long documents first and an excess to them; 0 gives all documents of a source one
    rate. Whole copies only, `most` at most; a source misses its target by about half its shortest documents. Documents
    without words are taken once and add nothing. Rows of one source and size differ in copies by one at most, those with the
    smallest hash of id and text having one more; repeated rows are rows of their own; an empty table gives an empty result;
    other columns take no part. A source may hold any share of the rows: what one task sees of it are its distinct sizes, at
    most the square root of twice its words. fixed: every pass over docs sees the same rows in the same partitions.
    Columns: the id, source, size, source_size, target, copies, taken (size times copies).
    """
    docs = settled(docs.select(id_col, text_col, source_col), fixed)
    step, buckets = _Steps(docs.sparkSession), n_parts(docs)
    source = F.col(source_col).cast("string")
    rows = stored(
        docs.select(F.col(id_col).alias("_id"), source.isNull().alias("_none"), F.coalesce(source, F.lit("")).alias("_source"), words(F.col(text_col)).alias("size"), F.xxhash64(id_col, text_col).alias("_order")), "mix-rows"
    )
    classes = step(rows.groupBy(*_KEY, "size").agg(F.count(F.lit(1)).alias("n")))
    sources = classes.groupBy(*_KEY).agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    sources = step(targets(step(weighted(sources, weights, buckets, step)), share, most))
    multipliers = solved(classes, sources, most, tilt, step).select(*_KEY, "multiplier")
    tilted = classes.join(multipliers, _KEY, "left").withColumn("multiplier", F.coalesce("multiplier", F.lit(0.0)))
    plan = tilted.groupBy(*_KEY).applyInPandas(rounded(most, tilt), "_none boolean, _source string, size long, _copies long, _n long")
    plan = stored(plan.join(sources.select(*_KEY, "source_size", "target"), _KEY), "mix-plan")
    step.end()
    whole, more = F.expr("_copies div _n"), F.expr("_copies % _n")
    out = ranked(rows, [*_KEY, "size"], ["_order", "_id"], buckets, "_rank").join(plan, [*_KEY, "size"])
    copies = (whole + (F.col("_rank") < more).cast("long")).alias("copies")
    out = out.select(F.col("_id").alias(id_col), F.when(~F.col("_none"), F.col("_source")).alias(source_col), "size", "source_size", "target", copies)
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def drawn(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mixed documents themselves, one row for each copy; ids must be there and unique."""
    often = plan.where("copies > 0").select(id_col, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return docs.join(often, id_col)
