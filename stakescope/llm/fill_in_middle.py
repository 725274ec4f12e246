"""Fill-in-the-middle: texts cut at whole units into prefix, middle and suffix, put in another order, and put back.

A unit is [A-Za-z]+ or one other code point. Units are never listed: a text is held as its maximal runs of letters and of
other characters with cumulative unit counts. The run that holds a cut is found by binary search, and the cut's place inside
the run follows from the counts: a run of letters is one unit, in any other run each code point is one.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import trimmed
from .textcore import NULL_ID, ids_back, ids_of, pieces, string_buffers

#: Markers of prefix, suffix and middle. None overlaps another or itself, so texts without them never form one where parts meet.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = tuple(x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True


class Runs(NamedTuple):
    """Documents as maximal runs of one class. Places are code points, counted from the first document on."""

    at: np.ndarray  #: byte of each code point, and the number of bytes
    first: np.ndarray  #: first code point of each document, and their number
    start: np.ndarray  #: first code point of each run, and their number
    letters: np.ndarray  #: whether the run is of letters
    units: np.ndarray  #: units before each run, and all
    base: np.ndarray  #: units before each document, and all


def runs_of(data: np.ndarray, offsets: np.ndarray) -> Runs:
    """The runs of documents given as UTF-8 bytes and offsets."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    letter = _LETTER[data[at]]
    first = np.searchsorted(at, offsets)
    new = np.ones(len(at) + 1, bool)
    np.not_equal(letter[1:], letter[:-1], out=new[1:-1]) if len(at) else None
    new[first] = True
    start = np.flatnonzero(new)  # the place after the last code point ends the last run
    letters = letter[start[:-1]]
    units = np.concatenate(([0], np.cumsum(np.where(letters, 1, np.diff(start)))))
    return Runs(np.append(at, len(data)), first, start, letters, units, units[np.searchsorted(start, first)])


def places(runs: Runs, document: np.ndarray, units: np.ndarray) -> np.ndarray:
    """The code point at which so many units of each document have ended."""
    upto = runs.base[document] + units
    run = np.searchsorted(runs.units, upto) - 1
    inside = np.where(runs.letters[run], runs.start[run + 1] - runs.start[run], upto - runs.units[run])
    return np.where(units > 0, runs.start[run] + inside, runs.first[document])


def _draws(document_id: int, seed: int) -> tuple[int, ...]:
    """Four numbers from the id: the first 8-digit groups of a hex digest. A null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if document_id == NULL_ID else document_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def transformed(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, seed: int, rate: int, spm: int):
    """(units, form, prefix and middle in code points, output) of each document."""
    runs, raw = runs_of(data, offsets), data.tobytes()
    n, every = np.diff(runs.base), np.arange(len(ids))
    draws = np.array([_draws(i, seed) for i in ids.tolist()], np.int64).reshape(-1, 4)
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    low, high = places(runs, every, cuts[:, 0]), places(runs, every, cuts[:, 1])
    forms, outputs = [], []
    for a, b, c, d, (_, _, h3, h4) in zip(offsets[:-1].tolist(), runs.at[low].tolist(), runs.at[high].tolist(), offsets[1:].tolist(), draws.tolist(), strict=True):
        if a == d or h3 % 100 >= rate or any(raw.find(m, a, d) >= 0 for m in _MARKS):
            forms.append("plain")
            outputs.append(raw[a:d])
        elif h4 % 100 < spm:
            forms.append("spm")
            outputs.append(b"".join((_MARKS[1], raw[c:d], _MARKS[0], raw[a:b], _MARKS[2], raw[b:c])))
        else:
            forms.append("psm")
            outputs.append(b"".join((_MARKS[0], raw[a:b], _MARKS[1], raw[c:d], _MARKS[2], raw[b:c])))
    plain = np.array([f == "plain" for f in forms], bool)
    return n, forms, pa.array(low - runs.first[:-1], pa.int64(), mask=plain), pa.array(high - low, pa.int64(), mask=plain), outputs


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, rate: int = 90, spm: int = 20) -> DataFrame:
    """Each document with its text transformed; without shuffle.

    Four numbers come from the sha256 of seed, colon and id: the first two cut the text after so many units, the third leaves
    100 - rate percent as they are, the fourth puts the suffix first in spm percent of the others. A text that is empty or
    holds a marker stays plain. Null texts count as empty, a null id as empty text; rows with equal ids are cut by the same
    numbers; an empty table gives an empty result; other columns take no part.
    Columns: the id, n (units), form (plain, psm or spm), prefix_chars and middle_chars (code points; null if plain), output.
    """

    def cut(batches):
        for b in batches:
            data, offsets = string_buffers(b.column(1))
            ids = ids_of(b.column(0))
            for i, j in pieces(offsets):
                part = data[offsets[i] : offsets[j]]
                n, forms, prefix, middle, outputs = transformed(part, offsets[i : j + 1] - offsets[i], ids[i:j], seed, rate, spm)
                columns = [ids_back(ids[i:j]), pa.array(n, pa.int64()), pa.array(forms, pa.string()), prefix, middle, pa.array(outputs, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    schema = f"`{id_col}` long, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(lambda it: trimmed(cut(it)), schema)


def restored(output: Column, form: Column) -> Column:
    """The text again, from an output and its form alone."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm, spm = (F.concat(*(F.get(part, F.lit(k)) for k in order)) for order in ((1, 3, 2), (2, 3, 1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
