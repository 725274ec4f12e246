"""Source divergence audit: how far the sources of a language use its common terms differently, and by which terms.

Plain relational, in built-in functions only: terms are exploded, counted by group, groups crossed with the language's kept
terms so that absent terms count as 0, joined with themselves on language and term, summed and ranked. All arithmetic is on
whole numbers.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import dropped, n_parts, stored

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]++"


def _share(count: Column, total: Column, kept: Column, prior: int, scale: int) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * kept)), exact beyond 64 bits."""
    wide = lambda x: x.cast("decimal(20,0)")
    above, below = F.lit(scale).cast("decimal(10,0)") * wide(count + prior), wide(total + kept * prior)
    return F.call_function("div", above, below) + 1


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, term, n occurrences, docs that have it); counted in each task before the exchange."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    terms = F.regexp_extract_all(F.translate(value(text_col), string.ascii_uppercase, string.ascii_lowercase), F.lit(TERM), F.lit(0))
    each = docs.select(value(lang_col).alias("lang"), value(source_col).alias("source"), terms.alias("_terms"))
    both = each.select("lang", "source", F.posexplode(F.array("_terms", F.array_distinct("_terms"))).alias("_once", "_list"))
    one = both.select("lang", "source", "_once", F.explode("_list").alias("term"))
    return one.groupBy("lang", "source", "term").agg(F.sum(1 - F.col("_once")).alias("n"), F.sum("_once").cast("long").alias("docs")).withColumn("n", F.col("n").cast("long"))


def divergence(
    docs: DataFrame, least: int = 30, prior: int = 5, top: int = 50, scale: int = 10**9, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """For every (lang, source): its distance from each other source of the language, and the terms it uses most above the language.

    A language keeps the terms that at least `least` of its documents have. A group gives a kept term the smoothed share
    p = 1 + floor(scale * (count + prior) / (N + prior * V)). Part `pair`: the sum of |p - q| over all kept terms, for each
    other source, all ranks; 0 where the language keeps no term. Part `term`: p minus the language's share, for kept terms
    that the group has and uses above it, ranks to `top`. Ties go by item.
    Null texts, languages and sources count as ''; repeated rows are documents of their own; an empty table gives an empty
    result; other columns take no part. A source's number of documents is no matter: counts are made in each task first, and
    what is joined has a row for each group and kept term, dealt by term. That table is read by the self-join, so the work
    grows with kept terms times pairs of sources, which the `pair` part lists anyway.
    Columns: lang, source, part, item, value, rank.
    """
    buckets = n_parts(docs)
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "divergence-counts")
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    groups = docs.select(value(lang_col).alias("lang"), value(source_col).alias("source")).distinct()

    kept = stored(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).where(F.col("docs") >= least).drop("docs"), "divergence-kept")
    present = stored(counts.join(kept, ["lang", "term"], "left_semi").select("lang", "source", "term", "n"), "divergence-present")
    dropped(counts)
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    of_group = present.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    shares = stored(groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["total", "kept", "lang_total"]), "divergence-groups")

    # every group meets every kept term of its language; both sides are dealt by a bucket of the term, so a language is no hot key
    spread = shares.where("kept > 0").withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    dealt = kept.withColumn("_bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))
    crossed = spread.join(dealt, ["lang", "_bucket"]).join(present, ["lang", "source", "term"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    p, q = _share(F.col("n"), F.col("total"), F.col("kept"), prior, scale), _share(F.col("lang_n"), F.col("lang_total"), F.col("kept"), prior, scale)
    dense = stored(crossed.select("lang", "source", "term", "n", p.alias("p"), q.alias("q")), "divergence-dense")
    dropped(present)

    # '' is no term: a row of it for each group makes pairs appear where no term is kept
    sides = dense.select("lang", "term", "source", "p").unionByName(shares.select("lang", F.lit("").alias("term"), "source", F.lit(0).cast("long").alias("p")))
    other = sides.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("_q"))
    half = sides.join(other, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(F.abs(F.col("p") - F.col("_q"))).alias("value"))
    half = stored(half, "divergence-pairs")
    pairs = half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    terms = dense.where("n > 0 and p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))
