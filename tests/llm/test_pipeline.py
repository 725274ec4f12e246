"""Each stage of the pipeline on its own input, and the whole."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

from .conftest import SCHEMA, odd_texts
from .test_corpus import brute_components, brute_repeats
from .test_tokens import library  # noqa: F401


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_quality_keeps_clean_documents(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.1")  # enough labels to tell a rate from chance
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = P.quality(spark, docs, sf_dir)
    assert kept.columns == list(P.COLUMNS)
    assert kept.join(docs, list(P.COLUMNS), "left_anti").count() == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rates = {r["quality"]: r["k"] for r in labels.join(kept.select("doc_id", F.lit(1).alias("k")), "doc_id", "left").groupBy("quality").agg(F.avg(F.coalesce("k", F.lit(0))).alias("k")).collect()}
    assert rates[1] > 0.97 and rates.get(0, 0) < 0.2


def test_near_duplicates_keep_one_of_each_group(spark, docs, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = {i for i, (_, c) in brute_components(rows).items() if i == c}
    kept = P.near_duplicates(spark, docs, sf_dir)
    assert kept.columns == list(P.COLUMNS) and {r["doc_id"] for r in kept.collect()} == want


def test_near_duplicates_keep_one_of_each_group_with_null_ids(spark):
    text = dict(odd_texts())[None]
    rows = [(None, text), (900, text), (901, text + " "), (5, "one two"), (6, "one two"), (6, "one two"), (7, "three"), (None, "three"), (None, "four"), (None, "four"), (8, None), (8, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).coalesce(1)
    kept = [(r["doc_id"], r["text"]) for r in P.near_duplicates(spark, docs, "").collect()]
    assert Counter(kept) == Counter([(900, text), (5, "one two"), (7, "three"), (None, "four"), (8, None), (8, None), (9, "")])


@pytest.fixture(scope="module")
def odd_tables(spark, odd, tmp_path_factory):
    """Documents and labels with every odd case, as files: null ids, null, empty and very long texts, repeated rows, an extra column."""
    at = str(tmp_path_factory.mktemp("odd"))
    extra = odd.withColumn("score", F.lit("x")).withColumn("component_id", F.lit(1)).withColumn("kept", F.lit(2))
    extra.union(extra.where("doc_id % 2 = 0 or doc_id is null")).repartition(3).write.parquet(f"{at}/documents.parquet")
    rows = [(i, int(k % 3 > 0), 0) for k, i in enumerate(sorted(i for i, _ in odd_texts() if i is not None))] + [(None, 1, 0), (1, None, 0)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def as_files(df, at):
    df.write.mode("overwrite").parquet(at)
    return df.sparkSession.read.parquet(at)


def test_stages_on_odd_documents(spark, odd_tables, library):
    docs = spark.read.parquet(f"{odd_tables}/documents.parquet")
    kept = as_files(P.quality(spark, docs, odd_tables), f"{odd_tables}/1")
    key = lambda r: (r["doc_id"], r["text"])
    before, after = Counter(map(key, docs.collect())), Counter(map(key, kept.collect()))
    assert kept.columns == list(P.COLUMNS) and after and all(after[x] == before[x] for x in after)  # equal rows share their fate
    whole = as_files(docs.select(*P.COLUMNS), f"{odd_tables}/whole")  # what the classifier rejects must not hide odd cases from the others
    unique = as_files(P.near_duplicates(spark, whole, odd_tables), f"{odd_tables}/2")
    rows = [(n, r["text"]) for n, r in enumerate(whole.collect())]
    groups = {c for _, c in brute_components(rows).values()}
    assert unique.columns == list(P.COLUMNS) and unique.count() == len(groups)
    assert Counter(map(key, unique.collect())) <= before
    bare = as_files(P.repeats(spark, unique, odd_tables), f"{odd_tables}/3")
    texts = Counter((i, k if n else dict_text) for (i, _, n, k), dict_text in zip(brute_repeats([key(r) for r in unique.collect()]), [r["text"] for r in unique.collect()], strict=True))
    assert bare.columns == list(P.COLUMNS) and Counter(map(key, bare.collect())) == texts
    assert all(r["n_chars"] in (0, len(r["text"] or "")) for r in bare.collect())
    pieces = P.packing(spark, bare, odd_tables).collect()
    tokens = sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in bare.collect())
    assert sum(r["length"] for r in pieces) == tokens and len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces)


def test_stages_on_an_empty_table(spark, odd_tables, none):
    docs = as_files(none, f"{odd_tables}/none")
    for _, stage in P.STAGES:
        assert stage(spark, docs, odd_tables).count() == 0


def test_repeats(spark, docs, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    texts = dict(rows)
    got = {r["doc_id"]: r["text"] for r in P.repeats(spark, docs, sf_dir).collect()}
    for i, _, removed, kept in brute_repeats(rows):
        assert got[i] == (kept if removed else texts[i])


def test_run(spark, sf_dir, library):
    """The whole equals its stages run one by one on brute force's input of each."""
    rows = P.run(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = [(r["doc_id"], r["text"]) for r in P.quality(spark, docs, sf_dir).collect()]
    firsts = {i for i, (_, c) in brute_components(left).items() if i == c}
    left = {i: (k if n else t) for (i, t), (_, _, n, k) in zip([x for x in left if x[0] in firsts], brute_repeats([x for x in left if x[0] in firsts]), strict=True)}
    lengths = {i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in left.items()}
    got = Counter()
    for r in rows:
        got[r["doc_id"]] += r["length"]
    assert got == lengths
    assert rows and all(0 < r["length"] <= P.CAPACITY and r["offset"] + r["length"] <= P.CAPACITY for r in rows)
    assert [n for n, _ in P.STAGES] == ["quality classifier", "n-gram Jaccard join", "substring dedup", "best-fit packing"]
