"""Token ids of words seen before, kept by a worker process as flat arrays.

A word is known by a 128-bit hash of its bytes; its ids lie in one growing array.  A word costs about
forty bytes and its ids, and looking up a batch of distinct words makes no Python object for the known ones.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from cribble.llm.common import U, span_hashes, text_buffers

VALUES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)


class IdCache:
    """Ids of up to about ``most`` words; beyond that it starts anew with the words of the batch."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 1_500_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        # sorted runs of (hash, second hash, start, size), merged when there are many
        self.runs: list[tuple[np.ndarray, ...]] = []
        self.ids, self.used, self.words = np.zeros(1 << 16, np.uint32), 0, 0

    def _add(self, h1: np.ndarray, h2: np.ndarray, ids: list[bytes]) -> None:
        size = np.array([len(i) // 4 for i in ids], np.int64)
        flat = np.frombuffer(b"".join(ids), "<u4")
        if self.used + len(flat) > len(self.ids):
            grown = np.zeros(max(2 * len(self.ids), self.used + len(flat)), np.uint32)
            grown[:self.used] = self.ids[:self.used]
            self.ids = grown
        self.ids[self.used:self.used + len(flat)] = flat
        start = self.used + np.cumsum(size) - size
        self.used += len(flat)
        self.words += len(size)
        self.runs.append((h1, h2, start, size))
        if len(self.runs) > 6:
            self.runs = [tuple(np.concatenate(c) for c in zip(*self.runs))]
        order = np.argsort(self.runs[-1][0], kind="stable")
        self.runs[-1] = tuple(c[order] for c in self.runs[-1])

    def look(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size): the ids of word i are ids[start[i]:start[i] + size[i]]."""
        if self.words > self.most:
            self.clear()
        raw, offs = text_buffers(words)
        h1 = span_hashes(raw, offs[:-1], offs[1:])
        h2 = span_hashes(raw, offs[:-1], offs[1:], VALUES)
        start, size = np.zeros(len(h1), np.int64), np.full(len(h1), -1, np.int64)
        todo = np.arange(len(h1))
        for turn in range(2):
            for k1, k2, s, n in self.runs if turn == 0 else self.runs[-1:]:
                at = np.minimum(np.searchsorted(k1, h1[todo]), len(k1) - 1)
                hit = (k1[at] == h1[todo]) & (k2[at] == h2[todo])
                start[todo[hit]], size[todo[hit]] = s[at[hit]], n[at[hit]]
                todo = todo[~hit]
                if not len(todo):
                    return self.ids, start, size
            if turn == 0:
                new, first = np.unique(h1[todo], return_index=True)
                miss = todo[first]
                self._add(new, h2[miss], self.encode(words.take(pa.array(miss)).to_pylist()))
        # two words of one hash and different second hashes: encoded by themselves
        for i in todo.tolist():
            ids = np.frombuffer(self.encode([words[i].as_py()])[0], "<u4")
            self.ids = np.concatenate((self.ids[:self.used], ids))
            start[i], size[i] = self.used, len(ids)
            self.used += len(ids)
        return self.ids, start, size
