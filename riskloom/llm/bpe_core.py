"""A byte-level BPE vocabulary and its merges, applied to many words at once."""

from __future__ import annotations

import heapq
import json
from functools import lru_cache

import numpy as np

NO_RANK = np.int32(2**31 - 1)
# Words above this many bytes are merged one by one with a heap, whose time does not grow with the square of the length.
LONG_WORD = 192


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary, as sign -> byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """Ids, bytes and ranked merges of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        signs = byte_signs()
        ids = spec["model"]["vocab"]
        added = spec["added_tokens"]
        specials = [a for a in added if a["special"]]
        plain = all(not a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if len(specials) > 1 or len(added) > len(specials) or not plain or spec["normalizer"] is not None:
            raise ValueError("only a plain byte-level vocabulary with at most one special token is supported")
        self.special = specials[0]["content"] if specials else None
        self.special_id = specials[0]["id"] if specials else -1
        size = max([*ids.values(), self.special_id]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(signs[c] for c in token) if token != self.special else token.encode()
        if self.special:
            self.bytes_of[self.special_id] = self.special.encode()
        self.byte_ids = np.zeros(256, np.int64)
        for sign, b in signs.items():
            self.byte_ids[b] = ids[sign]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.base = size
        keys = np.array([ids[a] * size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(pairs)), strict=True))

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)

    def own_split(self, text: str) -> list[tuple[int, int]]:
        return [span for _, span in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def merge_long(self, word: bytes) -> list[int]:
        """Merges of one word: always the lowest rank, the leftmost of equals."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.rank_of[k], i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (k := ids[i] * self.base + ids[i + 1]) in self.rank_of]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            for x, y in ((prv[i], i), (i, nxt[i])):
                if x >= 0 and y < n and (r := self.rank_of.get(ids[x] * self.base + ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each word has."""
        long = {i for i, w in enumerate(words) if len(w) > LONG_WORD}
        short = [w for i, w in enumerate(words) if i not in long] if long else words
        ids, counts = self._merge_short(short)
        if not long:
            return ids, counts
        done = np.split(ids, np.cumsum(counts)[:-1]) if short else []
        rest = iter(done)
        lists = [np.array(self.merge_long(w), np.int64) if i in long else next(rest) for i, w in enumerate(words)]
        return np.concatenate(lists), np.array([len(x) for x in lists], np.int64)

    def _merge_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), counts)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        ranks = np.full(len(ids), NO_RANK)
        if len(ids) > 1:
            ranks[:-1] = np.where(word[:-1] == word[1:], self.pair_ranks(ids[:-1], ids[1:]), NO_RANK)
        while len(ids):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.append(starts, len(ids)))
            open_ = best < NO_RANK
            if not open_.all():  # finished words leave
                stay = np.repeat(open_, sizes)
                out.append((word[~stay], ids[~stay]))
                word, ids, ranks = word[stay], ids[stay], ranks[stay]
                sizes, best = sizes[open_], best[open_]
                if not len(ids):
                    break
            hit = np.flatnonzero(ranks == np.repeat(best, sizes))
            hit = hit[np.append(True, word[hit][1:] != word[hit][:-1])]  # the leftmost in each word
            ids[hit] = self.merged[ranks[hit]]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            word, ids, ranks = word[keep], ids[keep], ranks[keep]
            at = place[hit]
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(ids) - 1)
                inside = (word[left] == word[right]) & (left < right)
                ranks[left] = np.where(inside, self.pair_ranks(ids[left], ids[right]), NO_RANK)
        if not out:
            return np.zeros(0, np.int64), counts * 0
        word, ids = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(words)).astype(np.int64)


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
