"""Comparison of the members of a tile inside a task.

Rows come sorted by tile.  Parities of hashed elements bound the overlap of two sets
from above; the pairs that pass are united at once, so a tile gives at most one pair less than it has
members.  With the sets at hand a pair is settled by its sorted arrays before it is united;
without them the pairs go out to be settled elsewhere, and tiles with a pair that failed come again
with the verdicts on their pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from cribble.llm.common import U, common_count, text_buffers

SMALL = 16  # members up to which all pairs of many tiles are bounded at once
OUT = "key long, i int, j int, a long, b long"


def overlap_bound(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Upper bound of |X & Y| from parity maps (uint64 words): common elements cancel out, so every bit
    that differs stands for an element that one set lacks, whatever the size of the sets."""
    differ = np.bitwise_count(x ^ y).sum(axis=-1).astype(np.int64)
    return np.minimum(np.minimum(nx, ny), (nx + ny - differ) // 2)


def words_of(n: int, least: int = 8, most: int = 64) -> int:
    """64-bit words of the parity map of a set: a power of two with about two bits an element, within bounds."""
    return min(most, max(least, 1 << max(0, (n - 1) // 32).bit_length()))


def bitmap(hashes: np.ndarray, words: int) -> np.ndarray:
    """Parity map: a bit is set where an odd number of elements falls."""
    return np.packbits(np.bincount((hashes % U(64 * words)).astype(np.int64), minlength=64 * words).astype(np.uint8) & 1)


def folded(maps: list[np.ndarray], width: int) -> np.ndarray:
    """Parity maps of several power-of-two widths brought to one: the parts of a wider one add up."""
    return np.stack([m if len(m) == width else np.bitwise_xor.reduce(m.reshape(-1, width), axis=0) for m in maps])


def whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come sorted by (key, i, j), cut where no tile is split."""
    held: list[pa.RecordBatch] = []
    names = ("key", "i", "j")
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in names]
        edges = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        if held and any(held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in names):
            edges = np.concatenate(([0], edges))
        if len(edges):
            ready = [*held, batch.slice(0, int(edges[-1]))]
            if sum(b.num_rows for b in ready):
                yield pa.concat_batches(ready)
            held = []
            batch = batch.slice(int(edges[-1]))
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


class Tiles:
    """The tiles of a batch: compares members and collects the pairs that go out.

    Where members have a component (``comp``), only members of different ones are compared, and of these not two from one
    ``cell``, where they have been compared before; in a part of a larger tile those on side 1 are compared with those on
    side 0, else (side 2, or no side) all with all."""

    def __init__(self, batch: pa.RecordBatch, num: int, den: int, turn: int,
                 decode: Callable[[pa.Array], list[np.ndarray]] | None):
        self.num, self.den, self.turn = num, den, turn
        names = batch.schema.names
        self.key, self.i, self.j, self.rep = (batch.column(c).to_numpy() for c in ("key", "i", "j", "rep"))
        self.n = batch.column("n").fill_null(0).to_numpy()
        raw, offs = text_buffers(batch.column("bits"))
        self.words = np.frombuffer(raw.tobytes(), U)
        self.offs = offs // 8
        self.side, self.comp, self.cell = ((batch.column(c).fill_null(0).to_numpy() if c in names else None)
                                           for c in ("side", "comp", "cell"))
        self.other, self.ok = ((batch.column(c) if c in names else None) for c in ("other", "ok"))
        self.decode, self.sets = decode, {}
        self.column = batch.column("set") if decode else None
        self.out: list[tuple[int, int, int]] = []  # row of the tile, a, b

    # -- sets

    def maps(self, rows: np.ndarray) -> list[np.ndarray]:
        return [self.words[self.offs[r]:self.offs[r + 1]] for r in rows.tolist()]

    def fits(self, bound: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
        return (bound > 0) & (self.den * bound >= self.num * (nx + ny - bound))

    def load(self, rows: np.ndarray) -> None:
        rows = np.array([r for r in rows.tolist() if r not in self.sets], np.int64)
        if len(rows):
            self.sets.update(zip(rows.tolist(), self.decode(self.column.take(pa.array(rows)))))

    def linked(self, x: int, y: int) -> bool:
        """Whether two rows link, by their sorted arrays."""
        a, b = self.sets[x], self.sets[y]
        common = common_count(a, b)
        return common > 0 and self.den * common >= self.num * (len(a) + len(b) - common)

    # -- tiles

    def small(self, starts: np.ndarray, m: int) -> None:
        """Tiles of m members each, all compared with all: the bounds of all of them at once."""
        x, y = np.triu_indices(m, 1)
        for part in np.split(starts, np.arange(4096, len(starts), 4096)):
            rows = part[:, None] + np.arange(m)
            width = np.diff(self.offs)[rows].min(axis=1)
            for w in np.unique(width).tolist():
                here = rows[width == w]
                bits = folded(self.maps(here.reshape(-1)), w).reshape(len(here), m, w)
                size = self.n[here]
                fit = np.stack([self.fits(overlap_bound(bits[:, a], bits[:, b], size[:, a], size[:, b]),
                                          size[:, a], size[:, b]) for a, b in zip(x.tolist(), y.tolist())], axis=1)
                if self.comp is not None:
                    comp, cell = self.comp[here], self.cell[here]
                    fit &= (comp[:, x] != comp[:, y]) & (cell[:, x] != cell[:, y])
                some = np.flatnonzero(fit.any(axis=1))
                if self.decode:
                    self.load(here[some].reshape(-1))
                for t in some.tolist():
                    first, label = int(here[t, 0]), list(range(m)) if self.comp is None else comp[t].tolist()
                    for p in np.flatnonzero(fit[t]).tolist():
                        a, b = int(x[p]), int(y[p])
                        if label[a] != label[b] and (not self.decode or self.linked(first + a, first + b)):
                            old, new = label[b], label[a]
                            label = [new if v == old else v for v in label]
                            self.out.append((first, int(self.rep[first + a]), int(self.rep[first + b])))

    def large(self, lo: int, hi: int) -> None:
        """One tile: every row against the rows of other components."""
        rows, seen, failed = np.arange(lo, hi), [], set()
        if self.other is not None:
            told = self.other.slice(lo, hi - lo)
            verdict = ~told.is_null().to_numpy(zero_copy_only=False)
            seen = list(zip(self.rep[lo:hi][verdict].tolist(), told.filter(pa.array(verdict)).to_pylist(),
                            self.ok.slice(lo, hi - lo).filter(pa.array(verdict)).to_pylist()))
            rows = rows[~verdict]
        label = np.unique(self.comp[rows], return_inverse=True)[1] if self.comp is not None else np.arange(len(rows))
        at = {r: k for k, r in enumerate(self.rep[rows].tolist())}
        for a, b, ok in seen:
            if ok and a in at and b in at:
                label[label == label[at[b]]] = label[at[a]]
            elif not ok:
                failed.add((a, b))
        maps = self.maps(rows)
        bits = folded(maps, min((len(m) for m in maps), default=1)) if maps else np.zeros((0, 1), U)
        size, rep = self.n[rows], self.rep[rows]
        cell = self.cell[rows] if self.cell is not None else np.arange(len(rows))
        one_way = self.side is not None and not (self.side[rows] == 2).any()
        side = self.side[rows] if one_way else None
        outer = np.flatnonzero(side == 1) if one_way else np.arange(len(rows))
        # in later turns more pairs go out before their verdicts are taken for granted
        budget, sent = len(rows) * (4 ** self.turn - 1), 0
        for x in outer.tolist():
            y = np.flatnonzero((label != label[x]) & (cell != cell[x]) & (side == 0)) if one_way else (
                x + 1 + np.flatnonzero((label[x + 1:] != label[x]) & (cell[x + 1:] != cell[x])))
            if not len(y):
                continue
            y = y[self.fits(overlap_bound(bits[x], bits[y], size[x], size[y]), size[x], size[y])]
            if len(y) and self.decode:
                self.load(rows[np.append(y, x)])
            for k in y.tolist():
                pair = (min(int(rep[x]), int(rep[k])), max(int(rep[x]), int(rep[k])))
                if label[k] == label[x] or pair in failed:
                    continue
                if self.decode and not self.linked(int(rows[x]), int(rows[k])):
                    continue
                self.out.append((lo, *pair))
                sent += 1
                if self.decode or sent > budget:
                    label[label == label[k]] = label[x]

    def compare(self) -> pa.RecordBatch:
        new = (self.key[1:] != self.key[:-1]) | (self.i[1:] != self.i[:-1]) | (self.j[1:] != self.j[:-1])
        starts = np.concatenate(([0], np.flatnonzero(new) + 1))
        sizes = np.diff(np.append(starts, len(self.key)))
        plain = (sizes <= SMALL) & (sizes > 1) & (self.other is None)
        if self.side is not None:
            plain &= self.side[starts] == 2
        for m in np.unique(sizes[plain]).tolist():
            self.small(starts[plain & (sizes == m)], m)
        for s, m in zip(starts[~plain].tolist(), sizes[~plain].tolist()):
            if m > 1:
                self.large(s, s + m)
        row, a, b = (np.array(c, np.int64) for c in zip(*self.out)) if self.out else [np.zeros(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(self.key[row]), pa.array(self.i[row], pa.int32()), pa.array(self.j[row], pa.int32()),
             pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["key", "i", "j", "a", "b"])
