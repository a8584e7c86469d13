"""Token counts of whole texts without shuffling a single pre-token.

First tier: token counts of frequent pre-tokens in a compact hash table, built once and broadcast; its size is fixed by
``TABLE_WORDS``. Second tier: pre-tokens that the table lacks are merged by the vocabulary's rules, and their lengths
stay in a cache of bounded size in each Python worker. Both tiers give the library's lengths.

Defined cases: a null text counts as empty and has 0 tokens; an empty table gives no rows; repeated rows each give a
row; further columns are ignored, whatever their names. Special-token strings inside a text are one token, as the
library's default has it. Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.bpe_core import Vocabulary, vocabulary
from riskloom.llm.frequent import frequent_words, split_batches
from riskloom.llm.pretokens import Pieces, split

TABLE_WORDS = 131_072
CACHE_WORDS = 400_000


class LengthTable:
    """Open addressing over 64-bit hashes of pre-tokens; a lookup handles a whole batch."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        size = 1 << max(4, int(2 * len(hashes)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.zeros(size, np.uint64)
        self.lengths = np.zeros(size, np.uint16)
        for h, n in zip(hashes.tolist(), lengths.tolist(), strict=True):
            at = h & (size - 1)
            while self.keys[at]:
                at = (at + 1) & (size - 1)
            self.keys[at], self.lengths[at] = h, n

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The length for each hash, -1 where the table has none."""
        out = np.full(len(hashes), -1, np.int64)
        rows = np.arange(len(hashes))
        at = hashes & self.mask
        while len(rows):
            keys = self.keys[at]
            hit = keys == hashes[rows]
            out[rows[hit]] = self.lengths[at[hit]]
            going = ~hit & (keys != 0)
            rows, at = rows[going], (at[going] + np.uint64(1)) & self.mask
        return out


def build_table(words: list[str], vocab: Vocabulary) -> LengthTable:
    hashes = _word_hashes(words, vocab)
    _, counts = vocab.merge([w.encode() for w in words])
    fits = counts < 65_536
    return LengthTable(hashes[fits], counts[fits])


def _word_hashes(words: list[str], vocab: Vocabulary) -> np.ndarray:
    p = split(words, None, vocab.own_split)
    if len(p.start) != len(words):
        raise ValueError("a frequent word must be one pre-token")
    return p.hash


def _lengths(p: Pieces, table: LengthTable, vocab: Vocabulary, cache: dict[int, int]) -> np.ndarray:
    out = table.find(p.hash)
    out[p.special] = 1
    missing = np.flatnonzero(out < 0)
    if len(missing):
        hashes, at, back = np.unique(p.hash[missing], return_index=True, return_inverse=True)
        new = [k for k, h in enumerate(hashes.tolist()) if h not in cache]
        if new:
            if len(cache) + len(new) > CACHE_WORDS:
                cache.clear()
                new = list(range(len(hashes)))
            _, counts = vocab.merge([p.text(missing[at[k]]).encode() for k in new])
            cache.update(zip(hashes[new].tolist(), counts.tolist(), strict=True))
        out[missing] = np.fromiter((cache[h] for h in hashes.tolist()), np.int64, len(hashes))[back]
    return out


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_tokens`` and whether the tokens exceed ``limit``."""
    sc = docs.sparkSession.sparkContext
    table = sc.broadcast(build_table(frequent_words(docs, path, TABLE_WORDS, text_col), vocabulary(path)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, lookup, cache = vocabulary(path), table.value, {}
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, tokens = batch.column(1), np.zeros(batch.num_rows, np.int64)
            for a, b, p in split_batches(texts, path):
                n = _lengths(p, lookup, vocab, cache)
                tokens[a:b] = np.bincount(p.doc, weights=n, minlength=b - a).astype(np.int64)
            size = pc.fill_null(pc.cast(pc.binary_length(texts), pa.int64()), 0)
            yield pa.record_batch([batch.column(0), size, pa.array(tokens), pa.array(tokens > limit)],
                                  names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType
    shape = T.StructType([T.StructField("id", kind), T.StructField("n_bytes", T.LongType()),
                          T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(count, shape).withColumnRenamed("id", id_col))
