"""The queries opN_ over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import exact_top_k

    return exact_top_k(_table(spark, sf_dir, "embeddings"), 20, 20)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), *_vocabulary("byte_bpe_50k.json"))


def op3_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_tree import score

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .byte_bpe import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), *_vocabulary("byte_bpe_50k.tiktoken"), fixed=True)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .recompression import remove_repeats

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, 13, fixed=True).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_by_bytes

    out = shard_by_bytes(_table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, labelled_sample, score

    docs, labels = (_table(spark, sf_dir, name) for name in ("documents", "labels"))
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = fit(*labelled_sample(docs, labels, remainder != 1))
    return score(docs.select("doc_id", "text"), model).select("doc_id", (remainder == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .nn_descent import approximate_top_k

    return approximate_top_k(_table(spark, sf_dir, "embeddings"), 20, 20)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), *_vocabulary("byte_bpe_50k.json"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), fixed=True)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fill_in_middle import fill_in_middle, restored

    out = fill_in_middle(_table(spark, sf_dir, "documents"))
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    rebuilt = restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(rebuilt).alias("restored_sha256"))


def op12_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(_table(spark, sf_dir, "documents"), (3, 1, 2), 1.5, 2, fixed=True).select("doc_id", "size", "source_size", "target", "taken")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import divergence

    return divergence(_table(spark, sf_dir, "documents"), 30, 5, 50)


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


_WORDS = "regexp_extract_all({x}, '[^\\x20\\x09-\\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 20"""

_REPEATS_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(x="coalesce(text, '')")} AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
k AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM s),
f AS (SELECT t, min(doc_id) AS first FROM k GROUP BY t),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM k JOIN f USING (t) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, len(d.w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

_JACCARD_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(x=_LOWER)} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) m USING (doc_id)"""


_MIDDLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, len(u) AS n, list_transform(range(0, 4), lambda k: CAST('0x' || substr(h, CAST(8 * k + 1 AS INTEGER), 8) AS BIGINT)) AS g FROM d),
c AS (SELECT *, least(g[1] % (n + 1), g[2] % (n + 1)) AS a, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS b FROM x),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR g[3] % 100 >= 90 THEN 'plain' WHEN g[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p"""

_DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
l AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 30),
s AS (SELECT lang, count(*) AS v, sum(n) AS total FROM l GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN l USING (lang, term) GROUP BY ALL),
m AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (SELECT m.lang, m.source, l.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (m.total + 5 * s.v) AS p, 1 + (1000000000::HUGEINT * (l.n + 5)) // (s.total + 5 * s.v) AS q
  FROM m JOIN l ON l.lang = m.lang JOIN s ON s.lang = m.lang LEFT JOIN c ON c.lang = m.lang AND c.source = m.source AND c.term = l.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
e AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM e)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM k WHERE part = 'pair' OR rank <= 50"""


def oracle_sql() -> dict[str, str]:
    """SQL of what SQL can say; the others are held against brute force in tests."""
    return {"op1_exact_top_k": _TOP_K_SQL, "op5_substring_dedup": _REPEATS_SQL, "op10_jaccard_join": _JACCARD_SQL, "op11_fill_in_middle": _MIDDLE_SQL, "op13_source_divergence": _DIVERGENCE_SQL}
