"""The corpus pipeline: quality classifier, n-gram Jaccard join, substring dedup, best-fit packing.

Every stage but the last takes and returns the columns of documents; others that a table may have go in the first stage.
Null ids, null and empty texts and repeated rows go through; an empty table stays empty.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakescope.llm.jaccard_join import jaccard_components
from stakescope.llm.packing import pack
from stakescope.llm.quality import fit, labelled_sample, score
from stakescope.llm.recompression import remove_repeats
from stakescope.llm.shared import dropped, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
WINDOW, CAPACITY, SHINGLE = 13, 2048, 5


def _vocabulary(name: str) -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is at least 0.5 stay, unchanged; empty and null texts are scored like any other."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(*labelled_sample(docs, labels, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    return score(docs.select(*COLUMNS), model).where("score >= 0.5").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id (no id counts as largest; of several such rows, the first).

    Rows are told apart by their place in the table, so repeated rows and rows without an id are documents like others.
    Documents without words are in no group and stay.
    """
    docs = docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row"))
    found = jaccard_components(docs, SHINGLE, id_col="_row", fixed=True)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    first = docs.select("_row", "doc_id").join(found, "_row").groupBy("component_id").agg(F.min(order)["_row"].alias("_row")).select("_row")
    return docs.join(first, "_row", "left_semi").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that a document with a smaller id has too go; texts without such passages stay as they are."""
    found = remove_repeats(docs.select(*COLUMNS), WINDOW, fixed=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    return found.withColumn("text", text).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, each with its sequence and offset."""
    return pack(docs, *_vocabulary("byte_bpe_50k.json"), CAPACITY)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeats), ("best-fit packing", packing)]
#: SQL can express neither the classifier nor the tokens; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's rows are written and read again as the next one's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    old = None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        if old is not None:
            dropped(old)
        old = docs
    return STAGES[-1][1](spark, docs, sf_dir)
