"""A Bloom filter of bounded size, to spare a shuffle what a join would drop anyway.

Results never depend on it. It has about twelve bits per key up to 64 MB, enough
for some hundred million keys; with more it only spares less.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 12
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 29
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _bits(keys: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of the keys in a filter of ``size`` bits, a power of two."""
    keys = keys.astype(np.int64, copy=False).view(np.uint64)
    return [(keys * np.uint64(m)) >> np.uint64(65 - size.bit_length()) for m in _MULTIPLIERS]


def _words_of(size: int):
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bits of a batch's keys, gathered into words of 64."""
        for batch in batches:
            bits = np.unique(np.concatenate(_bits(batch.column(0).to_numpy(zero_copy_only=False), size)))
            if not len(bits):
                continue
            word, first = np.unique(bits >> np.uint64(6), return_index=True)
            values = np.bitwise_or.reduceat(np.uint64(1) << (bits & np.uint64(63)), first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.astype(np.int64)), pa.array(values.view(np.int64))], names=["word", "bits"]
            )

    return words


class Filter:
    """Membership test of 64-bit integers; pickles as a reference to one broadcast bitmap."""

    def __init__(self, broadcast, size: int):
        self._broadcast = broadcast
        self._size = size

    def of(self, keys: np.ndarray) -> np.ndarray:
        words = np.frombuffer(self._broadcast.value, dtype=np.uint64)
        held = np.ones(len(keys), dtype=bool)
        for bit in _bits(keys, self._size):
            held &= ((words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)) > 0
        return held

    def mask(self, keys: pa.Array) -> pa.Array:
        """False for keys that are surely absent, null included."""
        held = self.of(keys.fill_null(0).to_numpy(zero_copy_only=False)) & keys.is_valid().to_numpy(zero_copy_only=False)
        return pa.array(held)


def build_filter(keys: DataFrame) -> Filter:
    """Filter of the one 64-bit integer column of ``keys``, whose bits are gathered in the executors."""
    name = keys.columns[0]
    keys = keys.filter(F.col(name).isNotNull())
    size = min(max(1 << (BITS_PER_KEY * keys.count()).bit_length(), LEAST_BITS), MOST_BITS)
    words = keys.mapInArrow(_words_of(size), "word long, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))
    bitmap = np.zeros(size // 64, dtype=np.int64)
    # At most MOST_BITS / 64 rows of 16 bytes.
    filled = words.toArrow()
    bitmap[filled["word"].to_numpy()] = filled["bits"].to_numpy()
    return Filter(keys.sparkSession.sparkContext.broadcast(bitmap.tobytes()), size)
