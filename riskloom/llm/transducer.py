"""A lexicon as a minimal acyclic transducer.

Words share their endings: a state stands for everything that may still follow. Each arc carries a number, and the
numbers on a word's path add up to the word's place in sorted order, which points at its ids. The arrays are plain and
can be mapped into memory from one file.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np

PARTS = (("arc_key", np.int64), ("arc_target", np.int32), ("arc_skip", np.int32), ("final", np.uint8),
         ("id_start", np.int64), ("ids", np.int32))


class Lexicon:
    """Words (bytes) with their ids. ``find`` walks the automaton for a whole batch of words, byte by byte."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts
        for name, _ in PARTS:
            setattr(self, name, parts[name])

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the lexicon, -1 for words it lacks."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(words), np.uint8)
        out = np.full(len(words), -1, np.int64)
        rows, state, total = np.arange(len(words)), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(rows) and len(self.arc_key):
            over = sizes[rows] == step
            ended = over & (self.final[state] == 1)
            out[rows[ended]] = total[ended]
            rows, state, total = rows[~over], state[~over], total[~over]
            key = state * 256 + data[begin[rows] + step]
            at = np.minimum(np.searchsorted(self.arc_key, key), len(self.arc_key) - 1)
            hit = self.arc_key[at] == key
            rows, at, total = rows[hit], at[hit], total[hit]
            state, total = self.arc_target[at].astype(np.int64), total + self.arc_skip[at]
            step += 1
        return out

    def to_bytes(self) -> bytes:
        arrays = [np.ascontiguousarray(self.parts[n], kind) for n, kind in PARTS]
        head = np.array([len(a) for a in arrays], np.int64).tobytes()
        padded = (a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)
        return head + b"".join(padded)

    @classmethod
    def from_file(cls, file) -> Lexicon:
        """Arrays that are views of the mapped file; pages are read as the automaton is walked."""
        data = np.memmap(file, np.uint8, "r")
        counts = data[:8 * len(PARTS)].view(np.int64)
        at, parts = 8 * len(PARTS), {}
        for (name, kind), n in zip(PARTS, counts.tolist(), strict=True):
            size = n * np.dtype(kind).itemsize
            parts[name] = data[at:at + size].view(kind)
            at += size + (-size % 8)
        return cls(parts)


def compile_lexicon(words: list[bytes], ids: np.ndarray, counts: np.ndarray) -> Lexicon:
    """``words`` sorted and distinct; ``ids`` of all words in a row, ``counts`` per word. States are merged as soon as
    nothing can be added below them."""
    known: dict[tuple, int] = {}
    arcs_of: list[tuple] = []  # finished states: (final, ((byte, target), ...))
    path: list[list] = [[False, []]]  # the open states along the last word
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            shape = (final, tuple(arcs))
            if shape not in known:
                known[shape] = len(arcs_of)
                arcs_of.append(shape)
            path[-1][1][-1] = (path[-1][1][-1][0], known[shape])

    for word in words:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        close(same)
        for b in word[same:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    close(0)
    root = len(arcs_of)
    arcs_of.append((path[0][0], tuple(path[0][1])))
    # the root becomes state 0; how many words each state leads to gives the numbers on the arcs
    number = {root: 0} | {s: s + 1 for s in range(root)}
    below = [0] * len(arcs_of)
    keys, targets, skips = [], [], []
    for s, (final, arcs) in enumerate(arcs_of):  # targets come before their sources
        n = int(final)
        for b, target in arcs:
            keys.append(number[s] * 256 + b)
            targets.append(number[target])
            skips.append(n)
            n += below[target]
        below[s] = n
    order = np.argsort(np.array(keys, np.int64), kind="stable") if keys else np.zeros(0, np.int64)
    final = np.zeros(len(arcs_of), np.uint8)
    for s, (ends, _) in enumerate(arcs_of):
        final[number[s]] = ends
    return Lexicon({"arc_key": np.array(keys, np.int64)[order], "arc_target": np.array(targets, np.int32)[order],
                    "arc_skip": np.array(skips, np.int32)[order], "final": final,
                    "id_start": np.append(0, np.cumsum(counts)).astype(np.int64), "ids": ids.astype(np.int32)})


_MAPPED: dict[str, Lexicon] = {}


def map_lexicon(data: bytes) -> Lexicon:
    """The lexicon mapped from a file in the worker's own temporary folder, once per worker. The file has no name any
    more once it is mapped, so nothing is left behind, and a new worker makes its own from the broadcast bytes."""
    digest = hashlib.sha256(data).hexdigest()
    if digest not in _MAPPED:
        _MAPPED.clear()
        with tempfile.TemporaryFile() as file:
            file.write(data)
            file.flush()
            _MAPPED[digest] = Lexicon.from_file(file)
    return _MAPPED[digest]
