"""Words of many texts as arrays of 64-bit hashes.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return. In UTF-8 those
bytes never occur inside another character, so whole Arrow buffers are split at once, without making strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from riskloom.llm.common import sub_batches
from riskloom.llm.frequent import offsets
from riskloom.llm.pretokens import mix, powers

CHUNK_BYTES = 2 << 20


@dataclass
class Words:
    """Words of some rows in order: hash, row, first byte and length of each; ``first`` is each row's first word."""

    hash: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    size: np.ndarray
    first: np.ndarray
    data: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def left(self) -> np.ndarray:
        """How many words the row has from each word on, itself included."""
        return self.first[self.row + 1] - np.arange(len(self.row))


def split_words(data: np.ndarray, bounds: np.ndarray, fold: bool, inside_word: np.ndarray | None = None) -> Words:
    """Words of rows whose bytes lie between successive ``bounds``. ``fold`` lower-cases A-Z. ``inside_word`` tells for
    each byte whether it belongs to words; without it, all but white space does."""
    rows = len(bounds) - 1
    if fold:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13))) if inside_word is None else inside_word[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edge = bounds[:-1][bounds[:-1] < len(data)]
    opens[edge] = inside[edge]
    begin = np.flatnonzero(opens)
    closes = np.flatnonzero(np.append(inside[:-1] & (~inside[1:] | opens[1:]), inside[-1:])) if len(data) else begin
    size = closes + 1 - begin
    row = np.searchsorted(bounds, begin, side="right") - 1
    first = np.append(0, np.cumsum(np.bincount(row, minlength=rows)))
    if not len(begin):
        return Words(np.zeros(0, np.uint64), row, begin, size, first, data)
    own = data[inside]
    at = np.cumsum(size) - size
    place = np.arange(len(own)) - np.repeat(at, size)
    scaled = SIGNS[own] * powers(int(size.max()))[place]
    return Words(mix(np.add.reduceat(scaled, at) + size.astype(np.uint64)), row, begin, size, first, data)


SIGNS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def letters_and_digits() -> np.ndarray:
    """Bytes of words of lower-case ASCII letters, digits and all characters beyond ASCII."""
    b = np.arange(256)
    return (b >= 48) & (b <= 57) | (b >= 97) & (b <= 122) | (b >= 128)


def prefix_hashes(w: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``length`` bytes of the words that have so many, and those words' rows."""
    long = w.size >= length
    begin = w.begin[long]
    total = np.full(len(begin), length, np.uint64)
    for i, power in enumerate(powers(length)[:length]):
        total += SIGNS[w.data[begin + i]] * power
    return mix(mix(total) + np.uint64(length)), w.row[long]


def word_batches(texts: pa.Array, fold: bool, inside_word: np.ndarray | None = None) -> Iterator[tuple[int, int, Words]]:
    """Words of an Arrow column of texts, in runs of rows that fit in memory. A null has none."""
    bounds = offsets(texts)
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    sizes = np.diff(bounds) * valid
    for a, b in sub_batches(sizes.tolist(), CHUNK_BYTES):
        if valid[a:b].all():
            part, own = data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a]
        else:
            keep = [data[bounds[i]:bounds[i + 1]] for i in range(a, b) if valid[i]]
            part = np.concatenate(keep) if keep else np.zeros(0, np.uint8)
            own = np.append(0, np.cumsum(sizes[a:b]))
        yield a, b, split_words(part, own.astype(np.int64), fold, inside_word)


def sequence_hashes(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``length`` words that start at each word, whatever rows they are in; the last ones are shorter."""
    out = np.zeros(len(hashes), np.uint64)
    if not len(hashes):
        return out
    # prefix sums of hash * odd**i; the sum of a run, divided by odd**start, depends on the run alone
    odd = np.uint64(0x9E3779B97F4A7C15 if not salt else 0xC2B2AE3D27D4EB4F)
    inverse = np.uint64(pow(int(odd), -1, 1 << 64))
    n = len(hashes)
    up, down = np.full(n, odd), np.full(n, inverse)
    up[0] = down[0] = 1
    up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
    total = np.append(np.uint64(0), np.cumsum(mix(hashes + np.uint64(salt)) * up, dtype=np.uint64))
    end = np.minimum(np.arange(n) + length, n)
    return mix((total[end] - total[:-1]) * down + np.uint64(length))
