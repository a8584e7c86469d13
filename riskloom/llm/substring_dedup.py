"""Removal of word passages that repeat across documents, by level-wise doubling.

A window is ``WINDOW`` consecutive words. A word goes if a window covers it whose word sequence also starts in a document
with a smaller id. Windows are judged on the input.

1. Documents with the same word sequence form a class. In all but the one with the smallest id every window repeats, so
   only that one takes part further on.
2. Level one looks at runs of half a window. Of all half runs inside a window only the one with the smallest hash is
   taken: equal windows take the same one, so none is lost, and about one run in thirteen is counted instead of each.
   Runs that occur in one class only are dropped.
3. Level two doubles the survivors: only windows whose smallest half run repeats are hashed in full, with 128 bits, and
   counted. The tasks know the repeated runs, and the rows that stand for their class, from bitmaps of bounded size; a
   bitmap that wrongly says yes adds a window to the count and changes no result. At the full length none is left.
4. A window repeats if its first document is smaller than its own. Its words go.

Counts are aggregated before they move; texts move once, to meet their windows, and never meet in a group.

Defined cases: a null text or one without words keeps nothing and loses nothing (kept text empty); a document of fewer
than ``WINDOW`` words has no window; repeated rows with the same id are not each other's earlier copy, both stay; a row
without an id is never smaller than another and loses nothing; an empty table gives no rows; further columns are ignored,
whatever their names; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.bloom import bitmap_of
from riskloom.llm.common import cut, stored
from riskloom.llm.minhash_forest import class_keys
from riskloom.llm.words import Words, sequence_hashes, word_batches

WINDOW = 50


def half(window: int) -> int:
    return (window + 1) // 2


def smallest_halves(w: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows, for each the start of its smallest half run, and the hashes of half runs by start."""
    size = half(window)
    hashes = sequence_hashes(w.hash, size)
    starts = np.flatnonzero(w.left() >= window)
    if not len(starts):
        return starts, starts, hashes
    view = np.lib.stride_tricks.sliding_window_view(hashes, window - size + 1)
    return starts, starts + view[starts].argmin(1) if len(starts) < len(view) // 2 else starts + view.argmin(1)[starts], hashes


def _half_runs(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for a, b, w in word_batches(batch.column(2), False):
                _, best, hashes = smallest_halves(w, window)
                at = np.unique(best)
                bounds = pa.array(np.searchsorted(at, w.first), pa.int32())
                runs = pa.ListArray.from_arrays(bounds, pa.array(hashes[at].view(np.int64)))
                yield pa.record_batch([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                                       pa.array(class_keys(w), pa.binary()), runs], names=["doc", "row", "class", "run"])
    return run


def _windows(window: int, repeated: Broadcast, standing: Broadcast):
    """Windows whose smallest half run repeats, of the rows that stand for their class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for a, b, w in word_batches(batch.column(2), False):
                starts, best, half_runs = smallest_halves(w, window)
                use = standing.value.has(ids[a:b])[w.row[starts]]
                starts, best = starts[use], best[use]
                runs, back = np.unique(half_runs[best], return_inverse=True)
                starts = starts[repeated.value.has(runs)[back]] if len(runs) else starts
                row = w.row[starts]
                hashes = [sequence_hashes(w.hash, window, salt)[starts].view(np.int64) for salt in (0, 1)]
                yield pa.record_batch([batch.column(0).slice(a, b - a).take(pa.array(row)), batch.column(1).slice(a, b - a).take(pa.array(row)),
                                       pa.array((starts - w.first[row]).astype(np.int32)), *map(pa.array, hashes)],
                                      names=["doc", "row", "start", "h0", "h1"])
    return run


def _removal(window: int, as_is: bool):
    """Words that stay, from each row's window starts; ``copy`` marks later copies of a whole text. The columns from the
    fifth on are passed through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            copy, starts = batch.column(2), batch.column(3)
            for a, b, w in word_batches(batch.column(1), False):
                count = w.count()
                steps = np.zeros(len(w.hash) + 1, np.int64)
                for i in range(a, b):
                    first, n = w.first[i - a], count[i - a]
                    if copy[i].as_py() and n >= window:
                        at, size = first, n
                    elif starts[i].is_valid:
                        at, size = first + starts[i].values.to_numpy(), window
                    else:
                        continue
                    np.add.at(steps, at, 1)
                    np.add.at(steps, at + size, -1)
                keep = np.cumsum(steps)[:-1] == 0
                texts = _joined(w, keep)
                gone = count - np.bincount(w.row[keep], minlength=b - a)
                if as_is:
                    texts = pc.if_else(pa.array(gone == 0), batch.column(1).slice(a, b - a), texts)
                rest = [c.slice(a, b - a) for c in batch.columns[4:]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(count), pa.array(gone), texts, *rest],
                                                 names=["doc", "n_words", "n_removed", "kept", *batch.schema.names[4:]])
    return run


def _joined(w: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one blank, taken from the bytes at once."""
    begin, size, row = w.begin[keep], w.size[keep], w.row[keep]
    rows = len(w.first) - 1
    if not len(begin):
        return pa.array([""] * rows, pa.string())
    last = np.append(row[1:] != row[:-1], True)
    width = size + ~last  # a blank behind all but a row's last word
    ends = np.cumsum(width)
    out = np.full(int(ends[-1]), 32, np.uint8)
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(ends - width, size) + place] = w.data[np.repeat(begin, size) + place]
    bound = np.append(0, np.cumsum(np.bincount(row, weights=width, minlength=rows))).astype(np.int32)
    return pa.StringArray.from_buffers(rows, pa.py_buffer(bound.tobytes()), pa.py_buffer(out.tobytes()))


def repeated_starts(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """For ``docs`` (doc, row, text): the rows that are later copies of a whole text (``row``, ``copy``), and where windows
    start that an earlier document has (``row``, ``starts``)."""
    sc = docs.sparkSession.sparkContext
    halves = stored(docs.mapInArrow(_half_runs(window), "doc long, row long, class binary, run array<long>"), "half-runs")
    firsts = halves.groupBy("class").agg(F.min("doc").alias("first"))
    rows = cut(halves.select("doc", "row", "class").join(firsts, "class")
               .select("row", F.coalesce(F.col("doc") > F.col("first"), F.lit(False)).alias("copy")).distinct())
    runs = halves.select(F.xxhash64("class").alias("c"), F.explode("run").alias("run"))
    repeated = cut(runs.groupBy("run").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("run"))
    filters = [sc.broadcast(bitmap_of(df, c)) for df, c in ((repeated, "run"), (rows.where("not copy"), "row"))]
    windows = stored(docs.mapInArrow(_windows(window, *filters), "doc long, row long, start int, h0 long, h1 long"), "windows")
    # one row for each window, written before the join, so that adaptive execution can split a passage that many documents share
    first = cut(windows.groupBy("h0", "h1").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").drop("last"))
    gone = windows.join(first, ["h0", "h1"]).where("first < doc")
    return rows.where("copy"), gone.groupBy("row").agg(F.collect_set("start").alias("starts"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   carry: Sequence[str] = (), as_is: bool = False) -> DataFrame:
    """Per row: id, n_words, n_removed, ``kept``, the kept words joined by one blank, and the columns of ``carry``. With
    ``as_is`` a text that loses nothing is returned as it was."""
    text = F.col(text_col).cast("string")
    row = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(text, F.lit("")))
    more = F.struct(*[F.col(c) for c in carry]) if carry else F.struct(F.lit(0))
    whole = docs.select(F.col(id_col).cast("long").alias("doc"), row.alias("row"), text.alias("text"), more.alias("carried"))
    copies, starts = repeated_starts(whole.select("doc", "row", "text"), window)
    j = whole.join(copies, "row", "left").join(starts, "row", "left")
    j = j.select("doc", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "starts", "carried")
    shape = T.StructType([T.StructField("doc", T.LongType()), T.StructField("n_words", T.LongType()),
                          T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()), j.schema["carried"]])
    out = j.mapInArrow(_removal(window, as_is), shape)
    return out.select(F.col("doc").alias(id_col), "n_words", "n_removed", "kept", *[F.col("carried")[c].alias(c) for c in carry])
