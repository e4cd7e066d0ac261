"""Byte-level BPE encoding and decoding on padded matrices.

Texts are cut into pieces by the vocabulary's pattern.  The distinct pieces of a batch
are laid into matrices of token ids, one for each power-of-two width, and in every round
each row merges its leftmost pair of the lowest rank: pair ranks come from a hashed table,
the merged matrix is one column narrower, and rows without a pair left leave it.
Decoding gathers the bytes of all ids at once.
"""

from __future__ import annotations

import base64
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cribble.llm.common import MUL, U, ranges, slices, text_buffers
from cribble.llm.idcache import IdCache

NONE = np.int32((1 << 31) - 1)  # rank of a pair that is no token
WIDEST = 256  # bytes of a piece that still goes into a matrix


class PairTable:
    """(left id, right id) -> id of the merged pair, which also ranks it, in an open-addressing hash table."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        keys = np.fromiter((a << 32 | b for a, b in pairs), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.shift = U(64 - max(4, (4 * max(1, len(keys))).bit_length()))
        self.mask = (1 << 64 - int(self.shift)) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.values = np.full(self.mask + 1, NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            put, first = np.unique(slot[free], return_index=True)
            self.keys[put], self.values[put] = keys[free][first], values[free][first]
            left = self.keys[slot] != keys
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(U) * MUL) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair of ids; NONE where it is no token or an id is negative."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(keys.shape, NONE, np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.reshape(-1)[at]
        slot = self._slot(keys)
        flat = out.reshape(-1)
        while len(at):
            seen = self.keys[slot]
            hit = seen == keys
            flat[at[hit]] = self.values[slot[hit]]
            more = ~hit & (seen >= 0)
            at, keys, slot = at[more], keys[more], (slot[more] + 1) & self.mask
        return out


class Merger:
    """Merges pieces given as sequences of first ids: each round the leftmost pair of the lowest rank."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.table = PairTable(pairs)

    def merge_rows(self, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merge every row of a matrix padded with -1 to the end: (row numbers, their ids) in turn."""
        row, done = np.arange(len(ids)), []
        rank = self.table.get(ids[:, :-1], ids[:, 1:])
        while len(row):
            j = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
            best = rank[np.arange(len(row)), j] if rank.shape[1] else np.full(len(row), NONE)
            ended = best == NONE
            if ended.any():
                done.append((row[ended], ids[ended]))
                row, ids, rank, j, best = (x[~ended] for x in (row, ids, rank, j, best))
                if not len(row):
                    break
            here, cols = np.arange(len(row)), np.arange(ids.shape[1] - 1)
            ids[here, j] = best
            ids = np.take_along_axis(ids, cols + (cols > j[:, None]), axis=1)
            cols = cols[:-1]
            rank = np.take_along_axis(rank, cols + (cols >= j[:, None]), axis=1)
            inner = np.flatnonzero(j > 0)
            rank[inner, j[inner] - 1] = self.table.get(ids[inner, j[inner] - 1], best[inner])
            inner = np.flatnonzero(j < ids.shape[1] - 1)
            rank[inner, j[inner]] = self.table.get(best[inner], ids[inner, j[inner] + 1])
        return done

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """Merge one long piece.  All disjoint pairs of the lowest rank go in one round, from the left,
        as long as none of the pairs that arise on the way ranks lower; else only the first one goes."""
        rank = self.table.get(ids[:-1], ids[1:])
        while len(rank) and (low := rank.min()) != NONE:
            at = np.flatnonzero(rank == low)
            head = np.flatnonzero(np.diff(at, prepend=-2) > 1)  # of a run of such places every second one
            turn = np.arange(len(at)) - np.repeat(head, np.diff(head, append=len(at)))
            at = at[turn % 2 == 0]
            chosen = np.zeros(len(ids) + 2, bool)
            chosen[at] = True
            around = np.concatenate(([-1, -1], ids, [-1, -1]))
            before = np.where((at >= 2) & chosen[at - 2], low, around[at + 1])
            new = np.full(len(at), low, np.int32)
            if min(self.table.get(before, new).min(), self.table.get(new, around[at + 4]).min()) < low:
                at = at[:1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids[at] = low
            ids, place = ids[keep], at - np.arange(len(at))
            rank = rank[keep[:-1]] if keep[-1] else rank[:-1][keep[:-2]] if len(rank) > 1 else rank[:0]
            rank = rank[:len(ids) - 1]
            for k in (place - 1, place):
                k = k[(k >= 0) & (k < len(ids) - 1)]
                rank[k] = self.table.get(ids[k], ids[k + 1])
        return ids

    def merge(self, flat: np.ndarray, size: np.ndarray) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of every piece; ``flat`` holds the first ids of all in a row."""
        out = [b""] * len(size)
        start = np.cumsum(size) - size
        for i in np.flatnonzero(size > WIDEST).tolist():
            out[i] = self.merge_long(flat[start[i]:start[i] + size[i]].copy()).astype("<u4").tobytes()
        width = 1
        while width <= WIDEST:
            rows = np.flatnonzero((size > width // 2) & (size <= width))
            step = max(1, (1 << 20) // width)
            for lo in range(0, len(rows), step):
                part = rows[lo:lo + step]
                ids = np.full((len(part), width), -1, np.int32)
                ids[np.arange(width) < size[part][:, None]] = flat[ranges(start[part], size[part])]
                for got, merged in self.merge_rows(ids):
                    valid = merged >= 0
                    body = merged[valid].astype("<u4").tobytes()
                    ends = np.cumsum(valid.sum(axis=1)) * 4
                    for i, s, e in zip(part[got].tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                        out[i] = body[s:e]
            width *= 2
        return out


class ByteBpe:
    """Encoder and decoder of one rank table (every single byte must have a rank)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = 1_500_000):
        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.cache = IdCache(lambda words: self.encode_pieces([w.encode() for w in words]), remember)
        pairs = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.merger = Merger(pairs)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            size[rank] = len(token)
        self.size, self.start = size, np.cumsum(size) - size
        by_rank = sorted((rank, token) for token, rank in ranks.items())
        self.bytes = np.frombuffer(b"".join(token for _, token in by_rank), np.uint8)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of every piece; a piece that is a token is that token."""
        whole = [self.ranks.get(p) for p in pieces]
        rest = [i for i, w in enumerate(whole) if w is None]
        out = [b"" if w is None else int(w).to_bytes(4, "little") for w in whole]
        flat = self.byte_id[np.frombuffer(b"".join([pieces[i] for i in rest]), np.uint8)]
        for i, ids in zip(rest, self.merger.merge(flat, np.array([len(pieces[i]) for i in rest], np.int64))):
            out[i] = ids
        return out

    def merge_long(self, ids: np.ndarray) -> np.ndarray:
        """Ids of one long piece from its first ids."""
        return self.merger.merge_long(ids)

    # ---------------------------------------------------------------- batches

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows in a row, number of ids per row)."""
        pieces, per_row = [], []
        for t in texts.to_pylist():
            got = self.pattern.findall(t) if t else []
            per_row.append(len(got))
            pieces += got
        enc = pa.array(pieces, pa.large_string()).dictionary_encode()
        del pieces
        flat, starts, sizes = self.cache.look(enc.dictionary)
        code = enc.indices.to_numpy(zero_copy_only=False)
        per_piece = sizes[code]
        ids = flat[ranges(starts[code], per_piece)]
        done = np.concatenate(([0], np.cumsum(per_piece)))
        return ids, np.diff(done[np.concatenate(([0], np.cumsum(per_row, dtype=np.int64)))])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all ids in a row, bytes per id)."""
        size = self.size[ids]
        return self.bytes[ranges(self.start[ids], size)], size


def read_ranks(path: str) -> str:
    """The text of a rank file: a line holds the token in base 64 and its rank."""
    with open(path, encoding="ascii") as f:
        return f.read()


def codec(spec: str, pattern: str) -> ByteBpe:
    """The codec of this worker process, kept between its tasks."""
    kept = sys.modules.setdefault("_cribble_llm_codecs", types.ModuleType("_cribble_llm_codecs"))
    key = f"b{hash((spec, pattern))}"
    if not hasattr(kept, key):
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in spec.splitlines() if line)}
        setattr(kept, key, ByteBpe(ranks, pattern))
    return getattr(kept, key)


def _binary(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row: ``ids`` are little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded by itself; text between matches is left out, as the
    pattern leaves it (the public patterns match every character).  Null and empty texts have no ids;
    special tokens in a text are plain text; a row never leaves its task, repeated rows are encoded each,
    a null doc_id stays null, other columns are ignored, no rows give no rows.  A piece beyond 256 bytes is merged
    by itself, all pairs of the lowest rank at once where that equals one by one.  The rank file (bounded, read by the
    driver) goes out as a broadcast.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(spec.value, pattern)
        for batch in slices(batches, "text"):
            ids, counts = bpe.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts),
                 _binary(ids, np.concatenate(([0], np.cumsum(counts))) * 4)], names=["doc_id", "n_tokens", "ids"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, n_tokens long, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row of ``encode``: the bytes that ``ids`` stand for.

    Bytes need not be whole UTF-8 where ids were cut; null ids decode to no bytes; an id without a rank raises.
    """
    spec = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(spec.value, pattern)
        for batch in slices(batches, "ids"):
            raw, offs = text_buffers(batch.column("ids"))
            ids = np.frombuffer(raw.tobytes(), "<u4")
            if len(ids) and (ids.max() >= len(bpe.size) or not bpe.size[ids].all()):
                raise ValueError("an id has no rank")
            flat, size = bpe.decode(ids)
            ends = np.concatenate(([0], np.cumsum(size)))
            yield pa.RecordBatch.from_arrays([*batch.columns, _binary(flat, ends[offs // 4])],
                                             names=[*batch.schema.names, "decoded"])

    key = encoded.schema["doc_id"].dataType.simpleString()
    return (encoded.select("doc_id", "n_tokens", "ids")
            .mapInArrow(run, f"doc_id {key}, n_tokens long, ids binary, decoded binary"))
