"""Periodic runs of words, found as maximal pairs.

A run is a stretch of consecutive words with smallest period ``q`` and a length of at least ``max(LEAST, EXPONENT * q)``
that no neighbouring word extends keeping the period. Take two occurrences of the same ``L`` words, ``q`` apart, whose left
words differ and whose right words differ (a maximal pair). The stretch from the first one's start to the second one's end
has ``q + L`` words and the period ``q``, and neither neighbour goes on with it. So the maximal pairs with
``L >= (EXPONENT - 1) * q`` and ``L >= LEAST - q`` are exactly the runs, each with its period and those multiples of it that
the length allows. Nothing is extended; of equal stretches the smallest period counts.

1. The words of a batch of texts get numbers that are equal for equal bytes. Texts in which no ``LEAST - 1`` words come twice
   have no pair and leave.
2. Suffixes are sorted within their text by prefix doubling, with array operations over the whole batch; only suffixes that
   are still tied take part in a round. The ranks of all rounds give the longest common prefixes (LCP) of neighbours.
3. The LCP-interval tree is built bottom-up. An interval keeps its occurrences in order together with their left words;
   when a child joins, each occurrence of the smaller side looks for partners of another left word within ``L // (EXPONENT - 1)``
   on the larger side, and the sides are merged. Occurrences that are so near to each other lie in one arithmetic
   progression, in which all but the first have the same left word and all but the last the same right word. So on each
   side only the farthest one within reach can make a maximal pair: the work is ``n log n``, however often words repeat.

There is no shuffle: a text is one unit of work, whose length bounds it.

Defined cases: a null text or one without words has no runs and an empty collapsed text; repeated rows each give a row; an
empty table gives no rows; further columns are ignored, whatever their names; texts are never cut.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.bpe import ranges
from riskloom.llm.substring_dedup import _joined
from riskloom.llm.words import Words, sequence_hashes, word_batches

LEAST, EXPONENT = 6, 4


def word_numbers(w: Words) -> np.ndarray:
    """A number for each word, the same for the same bytes. Hashes group the words; their bytes are compared."""
    _, at, number = np.unique(w.hash, return_index=True, return_inverse=True)
    first = at[number]
    if (w.size == w.size[first]).all():
        own = w.data[ranges(w.begin, w.size)]
        if (own == w.data[ranges(w.begin[first], w.size)]).all():
            return number
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w.data[b:b + n].tobytes(), len(seen))
                     for b, n in zip(w.begin.tolist(), w.size.tolist(), strict=True)], np.int64)


def with_repeats(w: Words, number: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in texts where some ``length`` words may come twice."""
    at = np.flatnonzero(w.left() >= length)
    rows = len(w.first) - 1
    hashes = sequence_hashes(number.astype(np.uint64), length)[at]
    order = np.lexsort((hashes, w.row[at]))
    twice = (hashes[order][1:] == hashes[order][:-1]) & (w.row[at][order][1:] == w.row[at][order][:-1])
    found = np.zeros(rows, bool)
    found[w.row[at][order][1:][twice]] = True
    return found[w.row]


def sorted_suffixes(number: np.ndarray, row: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, by text and then by words, and for each round ``k`` ranks that are equal for suffixes of one text
    with the same first ``2**k`` words. ``left`` is the number of words from each word on."""
    n = len(number)
    order = np.lexsort((number, row))
    opens = np.append(True, (number[order][1:] != number[order][:-1]) | (row[order][1:] != row[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(n), 0))
    ranks = [rank.copy()]
    tied = order[~(opens & np.append(opens[1:], True))]
    step = 1
    while len(tied):
        after = np.where(left[tied] > step, rank[np.minimum(tied + step, n - 1)] + 1, 0)
        key = rank[tied] * np.int64(n + 1) + after
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        old = rank[tied]
        group = np.append(True, old[1:] != old[:-1])
        opens = np.append(True, key[1:] != key[:-1])
        place = np.arange(len(tied))
        place = old + place - np.maximum.accumulate(np.where(group, place, 0))
        order[place] = tied
        rank[tied] = np.maximum.accumulate(np.where(opens, place, 0))
        ranks.append(rank.copy())
        tied = tied[~(opens & np.append(opens[1:], True))]
        step *= 2
    return order, ranks


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray], left: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``order`` whose suffix has at least ``least`` words in common with the next one's, and how many."""
    shown = min(least.bit_length() - 1, len(ranks) - 1)
    at = np.flatnonzero(ranks[shown][order[:-1]] == ranks[shown][order[1:]])
    a, b = order[at], order[at + 1]
    length = np.zeros(len(at), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        inside = (left[a] > length) & (left[b] > length)
        x, y = np.where(inside, a + length, a), np.where(inside, b + length, b)
        length += np.where(inside & (ranks[k][x] == ranks[k][y]), 1 << k, 0)
    far = length >= least
    return at[far], length[far]


def _join(large: list[int], small: list[int], depth: int, before: list[int], found: list[tuple[int, int, int]]) -> list[int]:
    """Merges two children of an interval and notes their maximal pairs as (start, length, period)."""
    if len(large) < len(small):
        large, small = small, large
    reach = depth // (EXPONENT - 1)
    for i in small:
        k = bisect_left(large, i - reach)
        if k < len(large) and large[k] < i and before[large[k]] != before[i]:
            found.append((large[k], depth + i - large[k], i - large[k]))
        k = bisect_right(large, i + reach) - 1
        if k >= 0 and large[k] > i and before[large[k]] != before[i]:
            found.append((i, depth + large[k] - i, large[k] - i))
    for i in small:
        insort(large, i)
    return large


def interval_runs(suffixes: list[int], common: list[int], before: list[int], found: list[tuple[int, int, int]]) -> None:
    """Maximal pairs of one tree: ``suffixes`` in order and the common prefixes of neighbours."""
    stack: list[tuple[int, list[int]]] = []
    node = [suffixes[0]]
    for depth, suffix in zip(common, suffixes[1:], strict=True):
        while stack and stack[-1][0] > depth:
            deeper, held = stack.pop()
            node = _join(held, node, deeper, before, found)
        if stack and stack[-1][0] == depth:
            stack[-1] = (depth, _join(stack[-1][1], node, depth, before, found))
        else:
            stack.append((depth, node))
        node = [suffix]
    while stack:
        deeper, held = stack.pop()
        node = _join(held, node, deeper, before, found)


def runs_of(w: Words) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of all rows; starts are places in ``w``."""
    if len(w.hash) < LEAST:
        return []
    number = word_numbers(w)
    at = np.flatnonzero(with_repeats(w, number, LEAST - 1))
    if not len(at):
        return []
    number, row, left = number[at], w.row[at], w.left()[at]
    order, ranks = sorted_suffixes(number, row, left)
    places, common = common_prefixes(order, ranks, left, LEAST - 1)
    if not len(places):
        return []
    before = np.append(-1, number[:-1])
    before[np.append(True, row[1:] != row[:-1])] = -1
    words_before = before.tolist()
    found: list[tuple[int, int, int]] = []
    cuts = np.append(np.append(0, np.flatnonzero(np.diff(places) > 1) + 1), len(places)).tolist()
    depths = common.tolist()
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        interval_runs(order[places[a]:places[b - 1] + 2].tolist(), depths[a:b], words_before, found)
    best: dict[tuple[int, int], int] = {}
    for start, length, period in found:
        if length >= LEAST and period < best.get((start, length), length):
            best[start, length] = period
    return [(int(at[start]), length, period) for (start, length), period in best.items()]


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        for a, b, w in word_batches(batch.column(1), False):
            runs = np.array(runs_of(w), np.int64).reshape(-1, 3)
            runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
            gone = np.zeros(len(w.hash) + 1, np.int64)
            np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
            np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
            row = w.row[runs[:, 0]]
            values = [runs[:, 0] - w.first[row], runs[:, 1], runs[:, 2]]
            bounds = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
            lists = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(list(map(pa.array, values)), ["start", "length", "period"]))
            yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(w.count()), lists, _joined(w, np.cumsum(gone)[:-1] == 0)],
                                  names=["id", "n_words", "runs", "collapsed"])


RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, ``runs`` (start, length and period, by start and then period) and ``collapsed``, the words
    that no run contains after its first period, joined by one blank."""
    shape = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                          T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_finder, shape).withColumnRenamed("id", id_col)


def _repeater(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        steps = batch.column(1).to_numpy(zero_copy_only=False)
        for a, b, w in word_batches(batch.column(2), False):
            source = np.arange(len(w.hash))
            for first, n, g in zip(w.first[:-1].tolist(), w.count().tolist(), steps[a:b].tolist(), strict=True):
                if n:
                    start = g % n
                    period = 1 + (n - start) // (3 + g % 8)
                    source[first + start:first + n] = first + start + np.arange(n - start) % period
            again = Words(w.hash[source], w.row, w.begin[source], w.size[source], w.first, w.data)
            yield pa.record_batch([batch.column(0).slice(a, b - a), _joined(again, np.ones(len(source), bool))], names=["id", "text"])


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and texts; in a tenth of the texts, chosen by the id's checksum, the last words repeat periodically. Other texts,
    and those without an id, stay."""
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.crc32(F.col(id_col).cast("string").cast("binary")).alias("h"),
                       F.col(text_col).cast("string").alias("text"))
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    shape = T.StructType([T.StructField("id", kind), T.StructField("text", T.StringType())])
    changed = rows.where(chosen).select("id", F.expr("h div 10").alias("g"), "text").mapInArrow(_repeater, shape)
    return rows.where(~chosen).select("id", "text").unionByName(changed).withColumnsRenamed({"id": id_col, "text": text_col})
