"""Token counts: whole-token shortcut, merges only for the rest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Counter, Vocabulary, WholeTokens, column_tokens
from .textcore import string_buffers


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_bytes, n_tokens and over_limit (n_tokens > limit) of every whole text.

    The strings of the vocabulary that encode alone as one token are found once on the driver (at most as many as
    the vocabulary has); a pre-token among them counts one, others are merged and remembered by each task.
    Null and empty texts have 0 bytes and 0 tokens; rows are neither merged nor dropped; other columns go. No shuffle.
    """
    vocabulary = Vocabulary.read(path, pattern)
    whole = WholeTokens(list(vocabulary.prove_whole()))
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, whole))

    def count(it):
        counter = Counter(*shared.value)
        for b in it:
            n = np.zeros(b.num_rows, np.int64)
            text = b.column(1)
            for i, part, s, e, keys, first in column_tokens(text, counter.vocabulary):
                running = np.concatenate(([0], np.cumsum(counter.counts(part, s, e, keys))))[first]
                n[i : i + len(first) - 1] = np.diff(running)
            n_bytes = np.diff(string_buffers(text)[1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
