"""Words and word shingles of texts, as Columns and, inside Arrow functions, as numpy hashes.

A word is a run of characters other than space and tab to carriage return.
``bytes.split`` and ``bytes.lower`` know exactly these separators and A-Z, so
the numpy side works on UTF-8 bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_list(text: Column) -> Column:
    """Words of a text in order; none for a missing text."""
    parts = F.split(F.coalesce(text, F.lit("")), GAP)
    return F.filter(parts, lambda w: w != "")


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words in order, A-Z taken as a-z."""
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; of the whole if there are fewer."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64) * _STEP
    for i in range(k):
        out = mixed(out + words[i : i + n]) + _STEP
    return out


def utf8(column) -> list[bytes]:
    """Texts of an Arrow column as bytes, missing ones empty."""
    import pyarrow as pa

    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def small_batches(spark: SparkSession) -> None:
    """Bounds what Arrow functions hold at a time, so that long texts fit beside the JVM."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
