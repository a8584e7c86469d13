"""A set of 64-bit hashes as a bitmap of bounded size.

It may say yes to a hash that it does not hold, never no to one that it does, so it may only be used where a wrong yes
costs work and not correctness. The bitmap has ``BITS_PER_ITEM`` bits an item and never more than ``MOST_BITS``, whatever
the table's size. It is built on the executors: tasks set bits in their own words, words are joined with a bitwise or,
and the driver gets the finished words, at most ``MOST_BITS / 64`` of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.pretokens import mix

BITS_PER_ITEM = 16
MOST_BITS = 1 << 28
PROBES = 4


def bits_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places of each hash, (hashes, probes)."""
    step = mix(hashes) | np.uint64(1)
    return (hashes[:, None] + np.arange(PROBES, dtype=np.uint64)[None] * step[:, None]) & np.uint64(bits - 1)


class Bitmap:
    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = bits_of(hashes, 64 * len(self.words))
        return ((self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(1)


def bitmap_of(df: DataFrame, column: str) -> Bitmap:
    """Bitmap of a column of longs."""
    n = df.count()
    bits = min(MOST_BITS, 1 << max(10, int(n * BITS_PER_ITEM).bit_length()))

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(bits_of(batch.column(0).to_numpy().view(np.uint64), bits))
            if not len(at):
                continue
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
            yield pa.record_batch([pa.array(word.astype(np.int64)), pa.array(mask.view(np.int64))], names=["word", "mask"])

    found = (df.select(F.col(column).cast("long").alias("h")).mapInArrow(set_bits, "word long, mask long")
             .groupBy("word").agg(F.expr("bit_or(mask)").alias("mask"))).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return Bitmap(words)
