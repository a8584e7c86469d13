"""Packing of tokenised documents into sequences of one length, online and in bounded space.

1. A task encodes its documents and keeps at most ``OPEN`` windows that are not full. Whole windows' worth of a long
   document leave at once. What is left of it goes into the open window in which it leaves the least room.
2. If it fits in none, a window is opened. With ``OPEN`` of them there, the fullest one is emitted: the head of the
   document fills it up to the last token, and the rest is placed anew. So no emitted sequence is padded, and a document
   is cut only when no window takes it whole.
3. Windows that are open when a task ends are its leftovers. They are merged in rounds, ``FAN`` tasks' leftovers to one
   task, by the same rule; what a task gets is bounded by ``FAN * OPEN`` windows. The last round fills the fullest from the
   emptiest, and cuts what remains of the last window into sequences whose lengths are powers of two.

Ids equal the tokenizer library's without added special tokens. Pre-tokens are looked up in a cache of each worker, and
merged by rank where it lacks them; a text is split once. Pieces are written once in the shared folder, and a round reads
those of the leftovers. Sequence numbers follow from task, round and order, so a task that runs again gives the same.

Defined cases: a null text is empty, and an empty one is its end token alone; repeated rows are documents of their own, even
under one id; an empty table gives no rows; further columns are ignored, whatever their names; texts are never cut short, and
a document longer than a window lies in many.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from riskloom.llm.bpe import ranges
from riskloom.llm.bpe_core import Vocabulary, vocabulary
from riskloom.llm.common import stored
from riskloom.llm.frequent import split_batches
from riskloom.llm.pretokens import Pieces

WINDOW, OPEN, FAN = 2048, 32, 64
END_ID = 1
CACHE_WORDS, CACHE_IDS = 1 << 20, 1 << 23
ROWS = 4096
TASK_BITS, ROUND_BITS = 28, 56


class WordCache:
    """Ids of the pre-tokens that a worker has met, by hash; emptied when it holds too many."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.clear()

    def clear(self) -> None:
        self.keys, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.count, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, keys: np.ndarray, words: list[bytes]) -> None:
        """``keys`` are in order and not held yet."""
        ids, count = self.vocab.merge(words)
        start = len(self.ids) + np.cumsum(count) - count
        at = np.searchsorted(self.keys, keys)
        self.keys, self.start, self.count = (np.insert(a, at, b) for a, b in ((self.keys, keys), (self.start, start), (self.count, count)))
        self.ids = np.append(self.ids, ids.astype(np.int32))

    def encode(self, p: Pieces, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if not len(p.start):
            return np.zeros(0, np.int32), np.zeros(texts, np.int64)
        keys, at, back = np.unique(p.hash, return_index=True, return_inverse=True)
        special = p.special[at]
        if len(self.keys) + len(keys) > CACHE_WORDS or len(self.ids) > CACHE_IDS:
            self.clear()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known & ~special)
        if len(new):
            self.add(keys[new], [p.text(i).encode() for i in at[new]])
            place = np.searchsorted(self.keys, keys)
        place = np.minimum(place, max(0, len(self.keys) - 1))
        pool = np.append(self.ids, np.int32(self.vocab.special_id))
        start = np.full(len(keys), len(pool) - 1)
        count = np.ones(len(keys), np.int64)
        start[~special], count[~special] = self.start[place[~special]], self.count[place[~special]]
        count = count[back]
        return pool[ranges(start[back], count)], np.bincount(p.doc, weights=count, minlength=texts).astype(np.int64)


@lru_cache(1)
def word_cache(path: str) -> WordCache:
    return WordCache(vocabulary(path))


# A piece: its document's id and number of tokens, its first token's place there, and its ids.
Piece = tuple[object, int, int, np.ndarray]


def split_at(pieces: list[Piece], size: int) -> tuple[list[Piece], list[Piece]]:
    """The first ``size`` tokens, and the others."""
    head: list[Piece] = []
    for k, (doc, total, start, ids) in enumerate(pieces):
        if size >= len(ids):
            head.append(pieces[k])
            size -= len(ids)
            continue
        if size:
            head.append((doc, total, start, ids[:size]))
        return head, [(doc, total, start + size, ids[size:]), *pieces[k + 1:]]
    return head, []


def tokens(pieces: list[Piece]) -> int:
    return sum(len(p[3]) for p in pieces)


class OpenWindows:
    """At most ``most`` windows that are not full; ``done`` collects the pieces of emitted sequences as rows."""

    def __init__(self, size: int, most: int, first_id: int):
        self.size, self.most, self.next_id = size, most, first_id
        self.free: list[tuple[int, int]] = []  # (room, number) in order
        self.held: dict[int, list[Piece]] = {}
        self.opened = 0
        self.done: list[tuple] = []

    def emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for doc, total, start, ids in pieces:
            self.done.append((doc, start, ids.tobytes(), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def place(self, pieces: list[Piece]) -> None:
        left = tokens(pieces)
        while left >= self.size:
            head, pieces = split_at(pieces, self.size)
            self.emit(head)
            left -= self.size
        while left:
            at = bisect_left(self.free, (left, -1))
            if at < len(self.free):
                room, number = self.free.pop(at)
                self.held[number] += pieces
                self._keep(room - left, number)
                return
            if len(self.free) < self.most:
                self.held[self.opened] = list(pieces)
                insort(self.free, (self.size - left, self.opened))
                self.opened += 1
                return
            room, number = self.free.pop(0)  # the fullest
            head, pieces = split_at(pieces, room)
            self.emit(self.held.pop(number) + head)
            left -= room

    def _keep(self, room: int, number: int) -> None:
        if room:
            insort(self.free, (room, number))
        else:
            self.emit(self.held.pop(number))

    def leftovers(self) -> list[list[Piece]]:
        return [self.held[number] for _, number in self.free]

    def finish(self) -> None:
        """Fills the fullest windows from the emptiest; the last one's rest leaves in powers of two."""
        windows = self.leftovers()
        self.free, self.held = [], {}
        while len(windows) > 1:
            head, rest = split_at(windows.pop(), self.size - tokens(windows[0]))
            windows[0] = windows[0] + head
            if tokens(windows[0]) == self.size:
                self.emit(windows.pop(0))
            if rest:
                windows.append(rest)
        for pieces in windows:
            while left := tokens(pieces):
                head, pieces = split_at(pieces, 1 << left.bit_length() - 1)
                self.emit(head)


def _rows(done: list[tuple], shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(done), ROWS):
        columns = zip(*done[at:at + ROWS], strict=True)
        full = [pa.array(c, f.type) for c, f in zip(columns, shape, strict=False)]
        none = [pa.nulls(len(full[0]), f.type) for f in list(shape)[len(full):]]
        yield pa.RecordBatch.from_arrays(full + none, schema=shape)


def _open_rows(windows: list[list[Piece]], part: int, shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Leftovers: ``part`` is set, and ``sequence_id`` is the window's number there."""
    rows = []
    for number, pieces in enumerate(windows):
        offset = 0
        for doc, total, start, ids in pieces:
            rows.append((doc, start, ids.tobytes(), total, number, offset, part))
            offset += len(ids)
    yield from _rows(rows, shape)


def _packer(path: str, size: int, most: int, end_id: int, shape: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part = word_cache(path), TaskContext.get().partitionId()
        windows = OpenWindows(size, most, part << TASK_BITS)
        for batch in batches:
            if not batch.num_rows:
                continue
            docs = batch.column(0).to_pylist()
            for a, b, p in split_batches(batch.column(1), path):
                ids, counts = cache.encode(p, b - a)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)  # an end token behind each document
                ends = (ends + np.arange(1, b - a + 1)).tolist()
                first = 0
                for doc, end in zip(docs[a:b], ends, strict=True):
                    windows.place([(doc, end - first, 0, ids[first:end].copy())])
                    first = end
                yield from _rows(windows.done, shape)
                windows.done.clear()
        yield from _open_rows(windows.leftovers(), part, shape)
    return run


def _merger(size: int, most: int, round_: int, last: bool, shape: pa.Schema):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        windows = OpenWindows(size, most, (round_ << ROUND_BITS) + (group << TASK_BITS))
        table = table.sort_by([("part", "ascending"), ("sequence_id", "ascending"), ("offset", "ascending")])
        columns = [table[c].to_pylist() for c in ("part", "sequence_id", "doc_id", "doc_tokens", "start", "ids")]
        item: list[Piece] = []
        before = None
        for part, number, doc, total, start, ids in zip(*columns, strict=True):
            if (part, number) != before and item:
                windows.place(item)
                item = []
            before = (part, number)
            item.append((doc, total, start, np.frombuffer(ids, np.int32)))
        windows.place(item)
        if last:
            windows.finish()
        left = [] if last else windows.leftovers()
        return pa.Table.from_batches([*_rows(windows.done, shape), *_open_rows(left, group, shape)], shape)
    return run


def pack(docs: DataFrame, path: str, window: int = WINDOW, open_windows: int = OPEN, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: id, start, length, ids (packed as little-endian unsigned 32-bit integers), doc_tokens, sequence_id and
    offset."""
    kind = docs.schema[id_col].dataType
    shape = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()),
                          T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
                          T.StructField("offset", T.LongType()), T.StructField("part", T.LongType())])
    arrow = to_arrow_schema(shape)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = stored(rows.mapInArrow(_packer(path, window, open_windows, end_id, arrow), shape), "packed")
    out, round_ = found.where("part is null"), 0
    while True:
        left = found.where("part is not null")
        parts = left.agg(F.max("part")).head()[0]
        if parts is None:
            break
        round_ += 1
        last = parts < FAN
        merged = left.groupBy(F.expr(f"part div {FAN}")).applyInArrow(_merger(window, open_windows, round_, last, arrow), shape)
        found = stored(merged, f"merged-{round_}")
        out = out.unionByName(found.where("part is null"))
        if last:
            break
    length = F.expr("octet_length(ids) div 4").cast("long")
    return out.select(F.col("doc_id").alias(id_col), "start", length.alias("length"), "ids", "doc_tokens", "sequence_id", "offset")

