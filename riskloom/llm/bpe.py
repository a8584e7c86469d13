"""Byte-level BPE encoding with a transducer of frequent words, and decoding.

The lexicon of frequent words (at most ``LEXICON_WORDS``, found over all texts) is compiled on the driver, broadcast and
mapped into memory by the workers. Each batch walks the automaton once for every distinct pre-token; pre-tokens that it
lacks are merged exactly by rank. Ids equal those of the library without added special tokens; special-token strings in
a text get the special id, as the library's default has it.

Defined cases: a null text is empty and has an empty id list, which decodes to an empty text; an empty table gives no
rows; repeated rows each give a row; further columns are ignored, whatever their names; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.bpe_core import Vocabulary, vocabulary
from riskloom.llm.frequent import frequent_words, split_batches
from riskloom.llm.pretokens import Pieces
from riskloom.llm.transducer import Lexicon, compile_lexicon, map_lexicon

LEXICON_WORDS = 131_072


def build_lexicon(words: list[str], vocab: Vocabulary) -> Lexicon:
    data = [w.encode() for w in words]
    return compile_lexicon(data, *vocab.merge(data))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All positions ``starts[i] .. starts[i] + counts[i] - 1``, one range after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _encode(p: Pieces, n_docs: int, lexicon: Lexicon, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and the number of ids of each text."""
    if not len(p.start):
        return np.zeros(0, np.int32), np.zeros(n_docs, np.int64)
    _, at, back = np.unique(p.hash, return_index=True, return_inverse=True)
    words = [p.text(i).encode() for i in at]
    place = lexicon.find(words)
    special = p.special[at]
    place[special] = -1
    unknown = np.flatnonzero((place < 0) & ~special)
    new_ids, new_counts = vocab.merge([words[k] for k in unknown])
    pool = np.concatenate([lexicon.ids, new_ids.astype(np.int32), np.array([vocab.special_id], np.int32)])
    start, count = np.zeros(len(at), np.int64), np.ones(len(at), np.int64)
    known = place >= 0
    start[known] = lexicon.id_start[place[known]]
    count[known] = lexicon.id_start[place[known] + 1] - start[known]
    start[unknown] = len(lexicon.ids) + np.cumsum(new_counts) - new_counts
    count[unknown] = new_counts
    start[special] = len(pool) - 1
    ids = pool[ranges(start[back], count[back])]
    return ids, np.bincount(p.doc, weights=count[back], minlength=n_docs).astype(np.int64)


def _encoder(data: Broadcast, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, vocab = map_lexicon(data.value), vocabulary(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            for a, b, p in split_batches(batch.column(1), path):
                ids, counts = _encode(p, b - a, lexicon, vocab)
                bounds = np.append(0, np.cumsum(4 * counts)).astype(np.int32)
                packed = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(bounds), pa.py_buffer(ids.astype("<u4"))])
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(counts), packed], names=["id", "n_tokens", "ids"])
    return run


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        blob = np.frombuffer(b"".join(vocab.bytes_of), np.uint8)
        size = np.array([len(b) for b in vocab.bytes_of], np.int64)
        begin = np.cumsum(size) - size
        for batch in batches:
            texts = []
            for packed in batch.column(2):
                ids = np.frombuffer(packed.as_buffer(), "<u4")
                texts.append(blob[ranges(begin[ids], size[ids])].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["id", "n_tokens", "ids", "decoded"])
    return run


def _shape(kind: T.DataType, decoded: bool) -> T.StructType:
    fields = [T.StructField("id", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    return T.StructType([*fields, T.StructField("decoded", T.StringType())] if decoded else fields)


def _encoding(docs: DataFrame, path: str, id_col: str, text_col: str):
    lexicon = build_lexicon(frequent_words(docs, path, LEXICON_WORDS, text_col), vocabulary(path))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows, _encoder(docs.sparkSession.sparkContext.broadcast(lexicon.to_bytes()), path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_tokens`` and ``ids``, the whole text's token ids, packed as little-endian unsigned 32-bit
    integers."""
    rows, run = _encoding(docs, path, id_col, text_col)
    return rows.mapInArrow(run, _shape(docs.schema[id_col].dataType, False)).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids; bytes that are no UTF-8 become replacement signs."""
    rows = encoded.select(F.col(id_col).alias("id"), "n_tokens", "ids")
    return rows.mapInArrow(_decoder(path), _shape(encoded.schema[id_col].dataType, True)).withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode`` of ``encode`` in one pass: a task's worker hands each run of encoded rows on to the decoder."""
    rows, run = _encoding(docs, path, id_col, text_col)
    back = _decoder(path)
    return rows.mapInArrow(lambda batches: back(run(batches)), _shape(docs.schema[id_col].dataType, True)).withColumnRenamed("id", id_col)


def ids_of(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The packed ids as arrays of integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(x.as_buffer(), "<u4").astype(np.int32) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["id", "ids"])

    shape = T.StructType([T.StructField("id", encoded.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return encoded.select(F.col(id_col).alias("id"), "ids").mapInArrow(run, shape).withColumnRenamed("id", id_col)
