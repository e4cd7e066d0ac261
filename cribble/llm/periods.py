"""Periodic runs of words by recompression.

The words of a batch of texts become symbols.  Block compression (a maximal repetition of
one symbol becomes one symbol) and pair compression (symbols fall into left and right ones,
a left one takes its right neighbour) alternate and give a run-length grammar in which equal
stretches are cut alike up to their ends.  An LCE query climbs that grammar while both places
stand at the beginning of a symbol and descends where the symbols differ, so it takes a
step or two a level.  Candidates are the grid places (i, i + p), with a step that every run
of period p must contain; their extensions to both sides are LCE queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cribble.llm.common import MUL, U, mix, ranges, slices, text_buffers, word_spans

# -- fixed values: the contract's white space.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


# ------------------------------------------------------------ grammar

@dataclass
class Level:
    """Symbols of one level and how they group into those of the next."""
    symbol: np.ndarray
    parent: np.ndarray   # index of the parent in the next level
    first: np.ndarray    # of every symbol of the next level its first child here (and the end)
    block: bool          # children of a parent are copies of one symbol


def _names(*keys: np.ndarray) -> np.ndarray:
    """Equal tuples get equal numbers from 0."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def recompress(symbol: np.ndarray, starts: np.ndarray) -> list[Level]:
    """Levels of the grammar of all sequences (``starts`` are their first places; every one ends with a symbol
    of its own, so no stretch goes on past its end).  The last level is where no symbol has a neighbour in its
    sequence, and is given without parents."""
    levels: list[Level] = []
    begin = np.zeros(len(symbol), bool)  # first symbol of a sequence
    begin[starts] = True
    turn = 0
    while not begin.all():
        for block in (True, False):
            if block:
                head = np.concatenate(([True], symbol[1:] != symbol[:-1])) | begin
            else:
                side = mix((symbol.astype(U) + U(turn + 1)) * MUL) & U(1) == U(0)
                left = side[:-1] & ~side[1:] & ~begin[1:]
                right = ~side[:-1] & side[1:] & ~begin[1:]
                head = np.concatenate(([True], ~(left if left.sum() >= right.sum() else right)))
                turn += 1
            first = np.flatnonzero(head)
            if len(first) == len(symbol):
                continue
            ends = np.append(first, len(symbol))
            size = np.diff(ends)
            joined = np.flatnonzero(size > 1)
            up = symbol[first]
            more = size[joined] if block else symbol[first[joined] + 1]
            up[joined] = int(symbol.max()) + 1 + _names(symbol[first[joined]], more)
            up = np.unique(up, return_inverse=True)[1]
            levels.append(Level(symbol, np.cumsum(head) - 1, ends, block))
            symbol, begin = up, begin[first]
    levels.append(Level(symbol, np.zeros(0, np.int64), np.zeros(0, np.int64), False))
    return levels


def mirrored(levels: list[Level]) -> list[Level]:
    """The grammar of the sequences read backwards."""
    out = []
    for lev in levels:
        n, m = len(lev.symbol), len(lev.first) - 1
        out.append(Level(lev.symbol[::-1], (m - 1 - lev.parent)[::-1], (n - lev.first)[::-1], lev.block))
    return out


def lce(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the longest common stretch from x and from y, of all pairs at once (x != y).

    On the way up a pair of equal symbols is passed (in blocks: as many copies as both have left) until both
    places begin a parent; a pair of different symbols leaves for the way down, where at most one
    step is made on each level.
    """
    live, a, b = np.arange(len(x)), x, y
    stop: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # the queries that leave at every level
    for k, lev in enumerate(levels):
        same = lev.symbol[a] == lev.symbol[b]
        if k == len(levels) - 1:
            if same.any():
                raise AssertionError("equal symbols on the last level")
            stop.append((live, a, b))
            break
        up, vp = lev.parent[a], lev.parent[b]
        # a pair that does not begin parents on both sides passes what it shares
        step = (same & ~((lev.first[up] == a) & (lev.first[vp] == b))).astype(np.int64)
        if lev.block:
            step *= np.minimum(lev.first[up + 1] - a, lev.first[vp + 1] - b)
        a, b = a + step, b + step
        out = lev.symbol[a] != lev.symbol[b]
        stop.append((live[out], a[out], b[out]))
        live, a, b = live[~out], lev.parent[a[~out]], lev.parent[b[~out]]
    # the way down: all queries that left at k or above meet on level k - 1
    rows, a, b = stop[-1]
    for k in range(len(levels) - 2, -1, -1):
        lev = levels[k]
        a, b = lev.first[a], lev.first[b]
        same = lev.symbol[a] == lev.symbol[b]
        step = same.astype(np.int64)
        if lev.block:
            step *= np.minimum(lev.first[lev.parent[a] + 1] - a, lev.first[lev.parent[b] + 1] - b)
        a, b = a + step, b + step
        more, c, d = stop[k]
        rows, a, b = np.concatenate((rows, more)), np.concatenate((a, c)), np.concatenate((b, d))
    out = np.empty(len(x), np.int64)
    out[rows] = a - x[rows]
    return out


# ------------------------------------------------------------ runs

def find_runs(words: np.ndarray, counts: np.ndarray, least: int = 24, times: int = 3, most: int = 1 << 20,
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length, period) of all maximal runs of at least ``least`` words and ``times`` periods,
    sorted by row, start and period.  ``words`` are the symbols of all rows, ``counts`` their numbers per row.

    Grid places that lie in a run already found, whose period divides p, are left out: they would give
    that run again.
    """
    n_rows = len(counts)
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if not n_rows or counts.max() < least:
        return none
    # every row ends with a symbol of its own; one more stands before the first row
    base = np.cumsum(counts + 1) - counts
    top = int(words.max()) + 1
    symbol = np.empty(len(words) + n_rows + 1, np.int64)
    symbol[ranges(base, counts)] = words
    symbol[np.append(base - 1, len(symbol) - 1)] = top + np.arange(n_rows + 1)
    fore = recompress(symbol, np.append(0, base))
    back = mirrored(fore)
    last = len(symbol) - 1
    cover_end = np.zeros(len(symbol), np.int64)      # end and period of the longest run found over a place
    cover_period = np.ones(len(symbol), np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    low, high = 1, 8
    longest = int(counts.max()) // times
    while low <= longest:
        per = np.clip(counts // times - low + 1, 0, high - low + 1)
        row = np.repeat(np.arange(n_rows), per)
        p = low + ranges(np.zeros(n_rows, np.int64), per)
        step = np.maximum(least - p, (times - 1) * p)
        grid = np.where(counts[row] >= np.maximum(least, times * p), -(-(counts[row] - p) // step), 0)
        bounds = np.searchsorted(np.cumsum(grid), np.arange(0, int(grid.sum()), most)[1:])
        hits: list[tuple[np.ndarray, ...]] = []
        for at in np.split(np.arange(len(p)), bounds):
            g = grid[at]
            r, q = np.repeat(row[at], g), np.repeat(p[at], g)
            i = base[r] + ranges(np.zeros(len(g), np.int64), g) * np.repeat(step[at], g)
            ok = symbol[i] == symbol[i + q]
            r, q, i = r[ok], q[ok], i[ok]
            ok = (cover_end[i] <= i + q) | (q % cover_period[i] != 0)
            r, q, i = r[ok], q[ok], i[ok]
            if not len(r):
                continue
            ahead = lce(fore, i, i + q)
            behind = lce(back, last - (i - 1), last - (i + q - 1))
            size = ahead + behind + q
            ok = size >= np.maximum(least, times * q)
            hits.append((r[ok], (i - behind - base[r])[ok], size[ok], q[ok]))
        if hits:
            r, s, size, q = (np.concatenate(c) for c in zip(*hits))
            order = np.lexsort((q, size, s, r))
            r, s, size, q = r[order], s[order], size[order], q[order]
            new = np.ones(len(r), bool)  # of the same stretch only the smallest period
            new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1]) | (size[1:] != size[:-1])
            found.append((r[new], s[new], size[new], q[new]))
            place = base[r[new]] + s[new]
            for b, z, q_ in sorted(zip(place.tolist(), size[new].tolist(), q[new].tolist()), key=lambda t: t[1]):
                part = slice(b, b + z)
                longer = cover_end[b] - b < z
                if longer:
                    cover_end[part], cover_period[part] = b + z, q_
        low, high = high + 1, high * 2
    if not found:
        return none
    r, s, size, q = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((q, size, s, r))
    r, s, size, q = r[order], s[order], size[order], q[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1]) | (size[1:] != size[:-1])
    r, s, size, q = r[new], s[new], size[new], q[new]
    order = np.lexsort((q, s, r))
    return r[order], s[order], size[order], q[order]


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """Of (start, length, period) the one of the greatest exact exponent; ties: smallest start, then period."""
    return min(runs, key=lambda t: (-Fraction(t[1], t[2]), t[0], t[2]))


SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, "
          "runs array<struct<start: long, length: long, period: long>>, collapsed binary")


def collapse(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """Periodic runs of every text and the text without their repetitions: (doc_id, n_runs, start, length, period,
    exponent_milli, runs, collapsed).

    Words are what stands between white space.  A run is a maximal stretch of words with smallest period q, of at
    least ``least`` words and ``times * q``; ``runs`` lists all (by start, then period), the four columns name the one
    with the greatest length / period (null without a run).  ``collapsed`` holds the words that no run
    contains after its first q words, joined by one space.  Null, empty and white texts have no runs and an empty
    ``collapsed``; repeated rows are judged each; a null doc_id stays null; other columns are ignored; no rows give no
    rows.  Rows never leave their task; a batch of about a megabyte of text, or one longer text, is in memory at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            raw, offs = text_buffers(batch.column("text"))
            starts, ends, row = word_spans(raw, offs, SPACE)
            size, n = ends - starts, batch.num_rows
            counts = np.bincount(row, minlength=n)
            data = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(size), [None, pa.py_buffer(np.concatenate(([0], np.cumsum(size)))),
                                               pa.py_buffer(raw[ranges(starts, size)])])
            words = data.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            r, s, length, q = find_runs(words, counts, least, times)
            first = np.cumsum(counts) - counts
            drop = np.zeros(len(words) + 1, np.int64)
            np.add.at(drop, first[r] + s + q, 1)
            np.add.at(drop, first[r] + s + length, -1)
            kept = np.flatnonzero(np.cumsum(drop)[:-1] == 0)
            # every kept word with a space after it; the last one of a row goes without
            wide = size[kept] + 1
            flat = np.full(int(wide.sum()), 32, np.uint8)
            at = np.cumsum(wide) - wide
            flat[ranges(at, size[kept])] = raw[ranges(starts[kept], size[kept])]
            done = np.concatenate(([0], np.cumsum(wide)))
            edge = done[np.concatenate(([0], np.cumsum(np.bincount(row[kept], minlength=n))))]
            bounds = np.searchsorted(r, np.arange(n + 1))
            listed = list(zip(s.tolist(), length.tolist(), q.tolist()))
            rows = []
            for k in range(n):
                runs = listed[bounds[k]:bounds[k + 1]]
                b = best_run(runs) if runs else (None, None, None)
                rows.append((len(runs), *b, 1000 * b[1] // b[2] if runs else None,
                             [dict(zip(("start", "length", "period"), t)) for t in runs],
                             flat[edge[k]:max(edge[k], edge[k + 1] - 1)].tobytes()))
            triple = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            types = [pa.int64()] * 5 + [pa.list_(triple), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array([x[c] for x in rows], t) for c, t in enumerate(types)],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "collapsed"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, {SCHEMA}")
