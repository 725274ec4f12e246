"""Quality classifier: zstandard dictionaries of good and bad text; the normalised difference of compressed sizes, calibrated."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each class, and bytes of them, that fitting brings to the driver at most (whole texts, smallest hashes of the id first).
SAMPLE_DOCS, SAMPLE_BYTES = 1200, 32_000_000
#: Bytes of each dictionary at most, and of the chunks into which whole texts are cut, so that a dictionary counts all along a long text.
DICTIONARY_BYTES, CHUNK_BYTES, LEVEL = 440_000, 64, 9


class CompressionModel:
    """Two dictionaries, and the calibration from the difference of compressed sizes to a probability."""

    def __init__(self, good: bytes, bad: bytes, weights: np.ndarray) -> None:
        self.good, self.bad, self.weights = good, bad, weights

    def _tools(self):
        if "_made" not in self.__dict__:
            self._made = []
            for raw in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                self._made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return self._made

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_made"}

    def difference(self, text: bytes) -> float:
        """(size with the bad dictionary - size with the good one) / length, over all chunks of the text; 0 for an empty text."""
        if not text:
            return 0.0
        good, bad = (c.compress for c in self._tools())
        total = 0
        for i in range(0, len(text), CHUNK_BYTES):
            chunk = text[i : i + CHUNK_BYTES]
            total += len(bad(chunk)) - len(good(chunk))
        return total / len(text)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not (self.good and self.bad):
            return np.full(len(texts), 0.5)
        x = np.array([self.difference(t) for t in texts], float)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + self.weights[1] * x, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Intercept and slope of a ridge logistic regression on x (scaled to unit deviation while fitting), by Newton's method."""
    scale = float(x.std()) or 1.0
    design = np.column_stack([np.ones(len(x)), x / scale])
    penalty = np.diag([1e-9, ridge])
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        grad = design.T @ (p - y) + penalty @ w
        step = np.linalg.solve((design * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ design + penalty, grad)
        w -= step * min(1.0, 5 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-10:
            break
    return np.array([w[0], w[1] / scale])


def dictionary(texts: list[bytes], limit: int) -> bytes:
    """Whole texts in their order, as many as fit into limit; if none does, the shortest."""
    out, size = [], 0
    for t in texts:
        if t and size + len(t) + 1 <= limit:
            out.append(t)
            size += len(t) + 1
    return b"\n".join(out) or min(filter(None, texts), key=len, default=b"")


def fit(good: list[bytes], bad: list[bytes]) -> CompressionModel:
    """Dictionaries from the even documents of each class, calibration from the odd ones (from all of a class that has only one).

    Both dictionaries are made in the same way and get the same room: what the smaller class can fill, DICTIONARY_BYTES at
    most. If a class has no text, every text scores 0.5 (nothing tells the classes apart).
    """
    room = min(DICTIONARY_BYTES, *(sum(len(t) + 1 for t in texts[::2]) for texts in (good, bad)))
    model = CompressionModel(dictionary(good[::2], room), dictionary(bad[::2], room), np.zeros(2))
    if model.good and model.bad:
        classes = [texts[1::2] or texts for texts in (good, bad)]
        x = np.array([model.difference(t) for texts in classes for t in texts])
        model.weights = fit_logistic(x, np.repeat([1.0, 0.0], [len(texts) for texts in classes]))
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, usable, limit: int = SAMPLE_DOCS, most_bytes: int = SAMPLE_BYTES) -> tuple[list[bytes], list[bytes]]:
    """Texts of at most `limit` good and `limit` bad documents of those that `usable` (a column of the id) lets in, whole, in the order of the id's hash.

    A document with several labels counts as good only if all say so; labels without a document or value are left out, and
    so are documents that would take a class beyond most_bytes. Of an id with several texts the shortest counts.
    """
    per_doc = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality")).where(usable)
    picked = None
    for q in (1, 0):
        part = per_doc.where(F.col("quality") == q).select("doc_id", "quality", F.xxhash64("doc_id").alias("at")).orderBy("at", "doc_id").limit(limit)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    order = F.struct(F.octet_length("text").alias("n"), "text")
    sizes = texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality", "at").agg(F.min(F.octet_length("text")).alias("n")).collect()  # at most 2 * limit rows
    chosen, room = {}, {1: most_bytes, 0: most_bytes}
    for r in sorted(sizes, key=lambda r: (r["at"], r["doc_id"])):
        if r["n"] <= room[r["quality"]]:
            room[r["quality"]] -= r["n"]
            chosen[r["doc_id"]] = (r["quality"], r["n"])
    wanted = docs.sparkSession.createDataFrame([(i, n) for i, (_, n) in chosen.items()], "doc_id long, n int")
    rows = texts.join(F.broadcast(wanted), "doc_id").where(F.octet_length("text") == F.col("n")).groupBy("doc_id").agg(F.min(order)["text"].alias("text")).collect()
    found = {r["doc_id"]: r["text"].encode() for r in rows}
    return tuple([found[i] for i, (quality, _) in chosen.items() if quality == q and i in found] for q in (1, 0))


def score(docs: DataFrame, model: CompressionModel, text_col: str = "text") -> DataFrame:
    """docs with `score` (0 to 1, higher: good likelier) of every whole text; a null text scores as the empty one.

    Only the text decides; all columns and rows stay (a column named score is replaced). No shuffle.
    """
    docs = docs.drop("score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)

    def scored(it):
        for b in it:
            texts = [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in b.column(at).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.scores(texts), pa.float64())], names=[*names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scored, f"{fields}, score double")
