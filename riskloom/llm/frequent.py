"""The most frequent pre-tokens of a table of texts.

Every task reads all its texts and keeps a running count with at most ``TRACKED`` words (the rarest go when it is full),
so a task's memory and what it sends are bounded, and no pre-token is shuffled. The list only decides which words take
the fast path; results never depend on it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bpe_core import vocabulary
from riskloom.llm.common import sub_batches
from riskloom.llm.pretokens import Pieces, split

TRACKED = 200_000
SENT = 32_768
BATCH_BYTES = 3 << 20


def split_batches(texts: pa.Array, path: str) -> Iterator[tuple[int, int, Pieces]]:
    """Pieces of an Arrow column of texts, in runs of rows that fit in memory. A null has none."""
    vocab = vocabulary(path)
    sizes = texts.is_valid().to_numpy(zero_copy_only=False) * np.diff(offsets(texts))
    for a, b in sub_batches(sizes.tolist(), BATCH_BYTES):
        yield a, b, split([t or "" for t in texts.slice(a, b - a).to_pylist()], vocab.special, vocab.own_split)


def offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets of the rows of a string array."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            if not batch.num_rows:
                continue
            for _, _, p in split_batches(batch.column(0), path):
                _, at, n = np.unique(p.hash, return_index=True, return_counts=True)
                top = np.argsort(-n, kind="stable")[:SENT]
                for i, k in zip(at[top].tolist(), n[top].tolist(), strict=True):
                    if not p.special[i]:
                        seen[p.text(i)] += k
                if len(seen) > TRACKED:
                    seen = Counter(dict(seen.most_common(TRACKED // 2)))
        best = seen.most_common(SENT)
        yield pa.record_batch([pa.array([w for w, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())],
                              names=["word", "n"])
    return count


def frequent_words(docs: DataFrame, path: str, keep: int, text_col: str = "text") -> list[str]:
    """At most ``keep`` frequent pre-tokens, in order of their bytes."""
    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_counter(path), "word string, n long")
    top = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(keep)
    return sorted((r["word"] for r in top.select("word").collect()), key=lambda w: w.encode())
