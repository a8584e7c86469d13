"""Pre-tokens of byte-level BPE, found for many texts at once with array operations.

The split is that of the pattern which byte-level vocabularies use: contractions; letters, digits or other signs with
one leading space; white space, whose last character goes to the next piece. Instead of a regular expression per text,
characters get classes from a table and the borders follow from neighbouring classes, so a batch costs a few passes
over its characters. Texts with characters that the library's older Unicode tables class differently are split by the
library itself.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import regex

LETTER, DIGIT, OTHER, SPACE, UNSURE = range(5)

# Ranges of code points that the tokenizer library classes by an older Unicode version.
NEWER_CHARACTERS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE),
    (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F),
    (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6),
    (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191),
    (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)

_ODD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def class_table() -> np.ndarray:
    chars = "".join(map(chr, [*range(0xD800), *([0xE000] * 0x800), *range(0xE000, 0x110000)]))
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, chars):
            table[m.start():m.end()] = kind
    for first, last in NEWER_CHARACTERS:
        table[first:last + 1] = UNSURE
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit image of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(4)
def _powers_to(n: int) -> np.ndarray:
    out = np.full(n, _ODD)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int) -> np.ndarray:
    """The first ``n`` or more powers of a fixed odd number, modulo 2**64."""
    return _powers_to(1 << max(8, int(n - 1).bit_length()))


@dataclass
class Pieces:
    """The pieces of a batch in order: code points, where each piece starts and ends, its text's place in the batch
    (``doc``) and a 64-bit hash."""

    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    special: np.ndarray

    def text(self, i: int) -> str:
        return self.points[self.start[i]:self.end[i]].tobytes().decode("utf-32-le")


def _segments(texts: list[str], special: str | None) -> tuple[list[str], list[int], list[bool]]:
    parts, docs, marks = [], [], []
    for i, text in enumerate(texts):
        if not text:
            continue
        if special is None or special not in text:
            parts.append(text)
            docs.append(i)
            marks.append(False)
            continue
        for k, part in enumerate(text.split(special)):
            if k:
                parts.append(special)
                docs.append(i)
                marks.append(True)
            if part:
                parts.append(part)
                docs.append(i)
                marks.append(False)
    return parts, docs, marks


def _contractions(points: np.ndarray, first: np.ndarray, opens: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where an apostrophe opens a contraction, and how many letters belong to it. ``left``: characters up to the
    segment's end."""
    at = opens[points[opens] == ord("'")]
    at = at[left[at] > 1]
    if len(at):
        at = at[first[at] | (points[at - 1] != ord(" "))]
    if not len(at):
        return at, at
    one = points[at + 1]
    two = points[np.minimum(at + 2, len(points) - 1)] * (left[at] > 2)
    single = np.isin(one, [ord(c) for c in "stmd"])
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    hit = single | pair
    return at[hit], np.where(single, 1, 2)[hit]


def split(texts: list[str], special: str | None, library) -> Pieces:
    """All pre-tokens of the texts. ``library`` splits one text the tokenizer's own way, for rare characters."""
    parts, docs, marks = _segments(texts, special)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes)
    if not len(points):
        none = np.zeros(0, np.int64)
        return Pieces(points, none, none, none, np.zeros(0, np.uint64), np.zeros(0, bool))
    kind = class_table()[points]
    first = np.zeros(len(points), bool)
    first[ends - sizes] = True
    space = kind == SPACE
    change = first.copy()
    change[1:] |= kind[1:] != kind[:-1]
    after_blank = np.zeros(len(points), bool)
    after_blank[1:] = (points[:-1] == ord(" ")) & ~first[1:]
    starts = change & ~(after_blank & ~space)
    starts[:-1] |= space[:-1] & ~space[1:] & ~first[1:]
    opens = np.flatnonzero(change & (kind == OTHER))
    left = np.zeros(0, np.int64)
    if len(opens):
        left = np.repeat(ends, sizes) - np.arange(len(points)) if np.any(points[opens] == ord("'")) else np.zeros(len(points), np.int64)
        at, letters = _contractions(points, first, opens, left)
        starts[at + 1] = False
        cut = at + 1 + letters
        inside = letters < left[at] - 1 if len(at) else np.zeros(0, bool)
        cut = cut[inside]
        starts[cut[kind[cut] == LETTER]] = True
    segment_of_unsure = np.unique(np.searchsorted(ends, np.flatnonzero(kind == UNSURE), side="right"))
    marked = np.flatnonzero(marks)
    for s in marked:
        starts[ends[s] - sizes[s] + 1:ends[s]] = False
    for s in segment_of_unsure:
        base = ends[s] - sizes[s]
        starts[base:ends[s]] = False
        starts[base + np.array([a for a, _ in library(parts[s])], np.int64)] = True
    start = np.flatnonzero(starts)
    end = np.append(start[1:], len(points))
    segment = np.searchsorted(ends, start, side="right")
    place = np.arange(len(points)) - np.repeat(start, end - start)
    scaled = mix(points.astype(np.uint64) + np.uint64(1)) * powers(int((end - start).max()))[place]
    hashes = mix(np.add.reduceat(scaled, start) + (end - start).astype(np.uint64))
    return Pieces(points, start, end, np.array(docs)[segment], hashes, np.array(marks)[segment])
