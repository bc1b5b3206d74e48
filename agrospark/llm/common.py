"""Shared pieces of the text operators.

``hash_words`` turns an Arrow string column into 64-bit word hashes without a
Python object per word: words are the maximal runs of bytes other than
``\\x20`` and ``\\x09-\\x0D``, ASCII A-Z fold to a-z.  The hash of a word is a
polynomial over random 64-bit byte values modulo 2^64, finished with a mixer;
two different words collide with a probability of about 2^-60.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, read_table, scratch_path  # noqa: F401  (re-exported)

WORD = r"[^\x20\x09-\x0D]+"
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


_VALUE_EXACT = np.random.default_rng(20240607).integers(1, 2 ** 63, 256, dtype=np.uint64)
_VALUE = _VALUE_EXACT.copy()
_VALUE[65:91] = _VALUE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2 ** 64)
WINDOW = 1 << 20          # bytes hashed at a time; bounds the arrays, cuts no word
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n + 1:
        def up(b):
            a = np.full(n + 1, np.uint64(b), np.uint64)
            a[0] = 1
            return np.cumprod(a, dtype=np.uint64)
        have = _POWERS[0] = (up(_BASE), up(_INVERSE))
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null has no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text and the end); no word spans two texts."""
    full = ~_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    before = np.empty_like(full)
    after = np.empty_like(full)
    if len(data):
        before[0], before[1:] = False, full[:-1]
        after[-1], after[:-1] = False, full[1:]
    starts = np.flatnonzero(full & (~before | cut[:-1]))
    ends = np.flatnonzero(full & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hash_bounds(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """Hash of the bytes of every word; ``fold`` makes A-Z and a-z equal."""
    values = _VALUE if fold else _VALUE_EXACT
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + WINDOW, "right")))
        hi = int(ends[j - 1])
        p, q = _powers(hi - lo)
        h = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[data[lo:hi]] * p[:hi - lo], out=h[1:], dtype=np.uint64)
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((h[e] - h[s]) * q[s] + (e - s).astype(np.uint64))
        i = j
    return out


def hash_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, first word of each text and the end)."""
    starts, ends, first = word_bounds(data, offs)
    return hash_bounds(data, starts, ends), first


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch of about ``most`` bytes of text (a longer text alone)."""
    if not batch.num_rows:
        return
    i = batch.schema.get_field_index(column)
    _, offs = buffers(batch.column(i))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def kept_in_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: lineage is cut reliably."""
    return cut_lineage(df, name)


def n_words(text) -> F.Column:
    """Number of words of a text column, 0 for null (JVM side)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
