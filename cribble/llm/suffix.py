"""Exact substring dedup with sharded suffix arrays.

A byte string of ``width`` bytes that occurs earlier is removed wherever it occurs again.

1. Documents are gathered into shards, written once.  Every window of ``width`` bytes has
   an anchor, its smallest k-gram by hash; equal windows have equal anchors.  Anchors
   that occur once cannot lie in a repeated window.
2. The contexts of repeated anchors (the bytes of all windows that have them) go to content
   shards by anchor, so equal windows meet.  Each content shard is cut into pieces that fit
   in memory; every piece gets a suffix array by Larsson-Sadakane refinement and common
   prefixes by Kasai's rule, which group its equal windows.
3. Pieces are merged by binary search of one piece's sorted windows in those of the pieces
   before.  The earliest start of every window is kept, all others become spans.
4. An anchor with very many contexts (a passage in many documents, each with its own text
   beside it) is dealt out by a hash of the context.  Each share keeps the earliest start of
   each of its windows; these meet by the hash of the window, where the earliest of all stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cribble.llm.common import MIX2, U, mix, powers, ranges, slices, span_hashes, stage, text_buffers


# ------------------------------------------------------------ suffix arrays (numpy)

def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank) of the suffixes of ``text`` by their first ``depth`` symbols at least.

    Larsson-Sadakane: suffixes sorted by h symbols are refined by the rank of the suffix h
    further on, which doubles h; suffixes alone in their group are settled and left out.
    Equal ranks share the first ``depth`` symbols (or end together).
    """
    n = len(text)
    bits = max(1, int(n).bit_length())
    take = min((63 - bits) // 9, depth)  # symbols + 1 take 9 bits, the end of the text is 0
    key = np.zeros(n, U)
    wide = np.concatenate((text.astype(U) + U(1), np.zeros(take, U)))
    for i in range(take):
        key = (key << U(9)) | wide[i:i + n]
    packed = np.sort((key << U(bits)) | np.arange(n, dtype=U))
    order = (packed & U((1 << bits) - 1)).astype(np.int64)
    lead = packed >> U(bits)
    rank = np.empty(n, np.int64)
    head = np.concatenate(([True], lead[1:] != lead[:-1])) if n else np.zeros(0, bool)
    starts = np.flatnonzero(head)
    rank[order] = np.repeat(starts, np.diff(np.concatenate((starts, [n]))))
    h = take
    while h < depth and n:
        ends = np.concatenate((head[1:], [True]))
        slot = np.flatnonzero(~(head & ends))  # places of the groups of two or more
        if not len(slot):
            break
        sfx = order[slot]
        ahead = sfx + h
        nxt = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        own = rank[sfx]
        by = np.lexsort((nxt, own)) if 3 * bits + 1 > 64 else None
        if by is None:
            # group, next rank and place in one word: one plain sort
            dense = np.cumsum(head[slot]) - 1
            word = (dense.astype(U) << U(bits + 1) | nxt.astype(U)) << U(bits) | np.arange(len(slot), dtype=U)
            by = (np.sort(word) & U((1 << bits) - 1)).astype(np.int64)
        order[slot] = sfx[by]
        own, nxt = own[by], nxt[by]
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (nxt[1:] != nxt[:-1])))
        head[slot] = new
        first = np.maximum.accumulate(np.where(new, slot, 0))
        rank[order[slot]] = first
        h *= 2
    return order, rank


def kasai(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix (up to ``most``) of every suffix in order with the one before.

    Kasai's rule: a suffix shares at least one symbol less with its predecessor in order
    than the suffix one place to the left does.  Where the symbols before both suffixes are
    equal the value follows from the left neighbour; only the others are compared.
    """
    n = len(text)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    before = np.empty(n, np.int64)  # predecessor in order of each suffix
    before[order[0]] = -1
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    left = np.where((at > 0) & (before > 0), text[at - 1] == text[np.maximum(before, 1) - 1], False)
    # a suffix whose left neighbour has the matching predecessor inherits its value less one
    inherits = left & (np.concatenate(([-2], before[:-1])) == before - 1)
    fresh = np.flatnonzero(~inherits & (before >= 0))
    length = np.zeros(len(fresh), np.int64)
    live = np.arange(len(fresh))
    a, b = fresh, before[fresh]
    wide = np.concatenate((text.astype(np.int32), np.full(1, -1, np.int32)))
    for step in range(most):
        if not len(live):
            break
        x, y = a[live] + step, b[live] + step
        same = (x < n) & (y < n)
        same &= wide[np.minimum(x, n)] == wide[np.minimum(y, n)]
        live = live[same]
        length[live] = step + 1
    plcp = np.full(n, -1, np.int64)
    plcp[before < 0] = 0
    plcp[fresh] = length
    known = plcp >= 0
    source = np.maximum.accumulate(np.where(known, at, 0))
    # capped values may follow a longer match: inside a run of inheritance the cap is checked again
    value = np.where(known, plcp, plcp[source] - (at - source))
    short = np.flatnonzero(~known & (plcp[source] >= most))
    if len(short):
        ok = np.zeros(len(short), np.int64)
        live = np.arange(len(short))
        a, b = short, before[short]
        base = np.maximum(most - (short - source[short]), 0)
        ok[:] = base
        for _ in range(most):
            if not len(live):
                break
            x, y = a[live] + ok[live], b[live] + ok[live]
            same = (x < n) & (y < n) & (ok[live] < most)
            same &= wide[np.minimum(x, n)] == wide[np.minimum(y, n)]
            live = live[same]
            ok[live] += 1
        value[short] = ok
    return np.minimum(np.maximum(value, 0), most)[order]


def window_groups(contexts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, offset, group) of every window of ``width`` bytes of the contexts; windows with equal
    bytes share a group, groups are numbered in the order of their bytes."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    # each context ends with a symbol of its own kind: windows never cross contexts
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    first = np.cumsum(sizes + 1) - (sizes + 1)
    body = ranges(first, sizes)
    text[body] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.int64) + 1
    order, _ = suffix_array(text, width)
    lcp = kasai(text, order, width)
    owner = np.searchsorted(first, order, side="right") - 1
    offset = order - first[owner]
    whole = offset + width <= sizes[owner]
    # a window that fits ends before the separator, so equal prefixes of that length are equal windows
    heads = np.cumsum(lcp < width)
    return owner[whole], offset[whole], heads[whole]


# ------------------------------------------------------------ anchors

def anchors(raw: np.ndarray, offs: np.ndarray, width: int, k: int,
            pq: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """(row, anchor hash, first and last window start) of every run of windows with one anchor.

    The anchor of a window is its k-gram of smallest hash, the leftmost of equal ones; ``pq`` are
    the powers for at least the length of ``raw``."""
    n = len(raw)
    m = n - k + 1
    empty = (np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64))
    if n < width:
        return empty
    p, q = pq
    total = np.zeros(n + 1, U)
    np.cumsum((raw.astype(U) + U(1)) * p[:n], out=total[1:])
    gram = mix((total[k:] - total[:m]) * q[:m])
    bits = max(1, int(m).bit_length())
    packed = (gram >> U(bits) << U(bits)) | np.arange(m, dtype=U)
    w = width - k + 1
    pad = -(-m // w) * w
    grid = np.full(pad, ~U(0), U)
    grid[:m] = packed
    grid = grid.reshape(-1, w)
    left = np.minimum.accumulate(grid, axis=1).reshape(-1)
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - width + 1
    low = np.minimum(right[:windows], left[w - 1:w - 1 + windows])
    where = (low & U((1 << bits) - 1)).astype(np.int64)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:windows]
    valid = np.arange(windows) + width <= offs[row + 1]
    start = valid & np.concatenate(([True], (where[1:] != where[:-1]) | (row[1:] != row[:-1]) | ~valid[:-1]))
    stop = valid & np.concatenate(((where[1:] != where[:-1]) | (row[1:] != row[:-1]) | ~valid[1:], [True]))
    lo, hi = np.flatnonzero(start), np.flatnonzero(stop)
    # minima crowd at the low end of the hash range: mixed again, anchors spread over all parts
    return row[lo], mix(gram[where[lo]] + MIX2), lo, hi


def prints(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 512) -> np.ndarray:
    """64-bit hash of every span of bytes, a few spans (given in order of their starts) at a time."""
    out = np.zeros(len(starts), U)
    for i in range(0, len(starts), step):
        a, b = starts[i:i + step], ends[i:i + step]
        out[i:i + step] = span_hashes(raw[a[0]:b.max()], a - a[0], b - a[0])
    return out


def changes(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the row before in any column."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return out


def binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary column of the given sizes over bytes that lie one after another."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def span_batches(shard: np.ndarray, spans: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(shard, packed spans, null) per shard of spans (document, start, stop)."""
    by = np.argsort(shard, kind="stable")
    shard, spans = shard[by], spans[by].astype(np.int64)
    edge = np.append(np.flatnonzero(changes(shard)), len(shard))
    for i in range(0, len(edge) - 1, 256):
        part = edge[i:i + 257]
        yield pa.RecordBatch.from_arrays([pa.array(shard[part[:-1]]), pa.array(
            [spans[a:b].tobytes() for a, b in zip(part[:-1], part[1:])], pa.binary()), pa.nulls(len(part) - 1, pa.binary())],
            names=["shard", "spans", "places"])


def place_batches(bucket: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(bucket, null, packed places) per bucket of places, the columns of a 5-row array."""
    by = np.argsort(bucket, kind="stable")
    bucket, places = bucket[by], places[:, by]
    edge = np.append(np.flatnonzero(changes(bucket)), len(bucket))
    for i in range(0, len(edge) - 1, 256):
        part = edge[i:i + 257]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[part[:-1]]), pa.nulls(len(part) - 1, pa.binary()), pa.array(
            [places[:, a:b].tobytes() for a, b in zip(part[:-1], part[1:])], pa.binary())],
            names=["shard", "spans", "places"])


def _blocks(values: np.ndarray, parts: int) -> np.ndarray:
    """Part of every hash by its leading bits."""
    return ((values >> U(32)) * U(parts) >> U(32)).astype(np.int64)


# ------------------------------------------------------------ the operator

def pack(raw: np.ndarray) -> bytes:
    """The bytes of a shard for shuffles and files, at the size of zstd instead of the shuffle's own codec."""
    return pa.Codec("zstd", compression_level=3).compress(pa.py_buffer(raw.tobytes()), asbytes=True)


def unpack(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the documents) of the shard in row ``i``."""
    offs = np.concatenate(([0], np.cumsum(batch.column("sizes")[i].values.to_numpy(), dtype=np.int64)))
    body = pa.Codec("zstd").decompress(batch.column("body")[i].as_buffer(), decompressed_size=int(offs[-1]))
    return np.frombuffer(body, np.uint8), offs


def anchor_contexts(docs: DataFrame, width: int = 100, k: int = 32, shard_bytes: int = 4 << 20,
                    anchors_per_part: int = 150_000,
                    contexts_per_share: int = 1 << 14) -> tuple[DataFrame, DataFrame, int, int]:
    """(shards, contexts, parts, load): the distinct contexts of repeated anchors in each shard, with the
    part and the key where they meet.  An anchor that stands more than ``contexts_per_share`` times has
    several keys, dealt out by a hash of the context; ``load`` is how often such anchors stand at most."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", shard_bytes):
            raw, offs = text_buffers(batch.column("text"))
            yield pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int64()), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([np.diff(offs)], pa.list_(pa.int64())), pa.array([pack(raw)], pa.binary())],
                names=["shard", "ids", "sizes", "body"])
            shard += 1

    body = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary")).alias("text")
    shards = stage(docs.select("doc_id", body).mapInArrow(
        gather, "shard long, ids array<long>, sizes array<long>, body binary"), "shards")
    size = shards.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n))).first()[0]
    parts = max(1, math.ceil((size or 0) * 2 / (width - k + 2) / anchors_per_part))

    def runs(raw: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Anchors of one shard, in pieces that overlap by a window less one byte."""
        reach = 1 << 16  # arrays of a piece stay in the processor's cache
        pq = powers(reach + width)
        for lo in range(0, max(1, len(raw)), reach):
            hi = min(len(raw), lo + reach + width - 1)
            local = np.clip(offs, lo, hi) - lo
            row, h, a, b = anchors(raw[lo:hi], local, width, k, pq)
            keep = a < reach  # later starts belong to the next piece
            yield row[keep], h[keep], a[keep] + lo, np.minimum(b[keep], reach - 1) + lo

    def shard_anchors(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
        got = list(runs(raw, offs))
        return tuple(np.concatenate([g[i] for g in got]) for i in range(4))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                _, h, _, _ = shard_anchors(*unpack(batch, i))
                values, times = np.unique(h, return_counts=True)
                part = _blocks(values, parts)
                cuts = np.searchsorted(part, np.arange(parts + 1))
                rows = [(p, values[a:b].tobytes(), np.frexp(times[a:b])[1].astype(np.uint8).tobytes())
                        for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([shard] * len(rows), pa.int64()),
                    pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                    names=["part", "shard", "values", "bits"])

    def find_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The anchors of each shard that occur more than once anywhere (rows come sorted by part), and
        with the number of their shares those that occur often."""
        for table in _by_key(batches, "part"):
            rows = table.to_pydict()
            values = [np.frombuffer(v, U) for v in rows["values"]]
            bits = np.concatenate([np.frombuffer(v, np.uint8) for v in rows["bits"]]).astype(np.int64)
            flat = np.concatenate(values)
            order = np.argsort(flat, kind="stable")
            s = flat[order]
            twice = np.zeros(len(s), bool)
            twice[1:] = s[1:] == s[:-1]
            twice[:-1] |= s[1:] == s[:-1]
            again = np.zeros(len(s), bool)
            again[order] = twice
            again |= bits > 1
            # a count of b bits is less than 2**b: at most twice the true number
            head = np.flatnonzero(changes(s))
            most = np.add.reduceat((1 << bits[order]) - 1, head) if len(s) else np.zeros(0, np.int64)
            heavy = most > contexts_per_share
            often, shares = s[head][heavy], -(-most[heavy] // contexts_per_share)
            ends = np.cumsum([len(v) for v in values])
            out = []
            for shard, v, e in zip(rows["shard"], values, ends.tolist()):
                v = v[again[e - len(v):e]]
                at = np.flatnonzero(np.isin(often, v))
                if len(v):
                    out.append((shard, v.tobytes(), np.stack((often[at], shares[at].astype(U))).tobytes()))
            load = np.zeros(len(out), np.int64)
            load[:1] = most[heavy].sum()
            yield pa.RecordBatch.from_arrays([
                pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()),
                pa.array([o[2] for o in out], pa.binary()), pa.array(load)], names=["shard", "values", "often", "load"])

    counted = shards.mapInArrow(count, "part long, shard long, values binary, bits binary")
    repeated = stage(counted.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(
        find_repeated, "shard long, values binary, often binary, load long"), "repeated-anchors")
    load = repeated.agg(F.sum("load")).first()[0] or 0
    marked = repeated.groupBy("shard").agg(F.collect_list("values").alias("repeated"),
                                           F.collect_list("often").alias("often"))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct contexts of a shard's repeated anchors with their first place; copies inside the
        shard become spans at once, since an equal context stands earlier in it."""
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                want = np.sort(np.concatenate([np.frombuffer(v.as_buffer(), U) for v in batch.column("repeated")[i].values]))
                ids = np.array([-(1 << 63) if x is None else x for x in batch.column("ids")[i].as_py()], np.int64)
                often = np.concatenate([np.frombuffer(v.as_buffer(), U).reshape(2, -1)
                                        for v in batch.column("often")[i].values], axis=1)
                often = often[:, np.argsort(often[0])]
                raw, offs = unpack(batch, i)
                row, h, a, b = shard_anchors(raw, offs)
                at = np.minimum(np.searchsorted(want, h), len(want) - 1)
                hit = want[at] == h
                row, h, a, b = row[hit], h[hit], a[hit], b[hit]
                size = b + width - a
                # equal contexts of one anchor are told by a 64-bit hash of their bytes; the order of
                # documents decides which place of a context is its first
                code = prints(raw, a, b + width)
                by = np.lexsort((a - offs[row], row, ids[row], size, code, h))
                row, h, a, size, code = row[by], h[by], a[by], size[by], code[by]
                lead = np.flatnonzero(changes(h, code, size))
                many = np.diff(np.append(lead, len(h))) - 1
                place = a - offs[row]
                copies = np.delete(np.stack((row, place, place + size), axis=1), lead, axis=0).astype(np.int64)
                ends = np.cumsum(many)
                heavy = np.zeros(len(h), bool)
                if often.size:
                    # equal contexts have equal hashes and meet in one share
                    at = np.minimum(np.searchsorted(often[0], h), often.shape[1] - 1)
                    heavy = often[0][at] == h
                    h = np.where(heavy, mix(h + (code % often[1][at] + U(1)) * MIX2), h)
                for lo in range(0, len(lead), 4096):
                    js, n = lead[lo:lo + 4096], many[lo:lo + 4096]
                    top = ends[lo:lo + 4096][-1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(_blocks(h[js], parts)), pa.array(h[js].view(np.int64)),
                        binaries(raw[ranges(a[js], size[js])], size[js]), pa.array(np.full(len(js), shard, np.int64)),
                        pa.array(row[js]), pa.array(ids[row[js]]), pa.array(place[js]),
                        binaries(np.ascontiguousarray(copies[top - n.sum():top]), n * 24), pa.array(heavy[js])],
                        names=["part", "anchor", "context", "shard", "doc", "doc_id", "start", "copies", "heavy"])

    found = shards.join(marked, "shard").mapInArrow(
        contexts, "part long, anchor long, context binary, shard long, doc long, doc_id long, start long, copies binary, "
                  "heavy boolean")
    return shards, found, parts, load


def repeated_spans(docs: DataFrame, width: int = 100, k: int = 32, piece_bytes: int = 1 << 20,
                   places_per_bucket: int = 1_000_000, **sizes: int) -> tuple[DataFrame, DataFrame]:
    """(shards, spans): shards (shard, ids, sizes, body) of the documents, their bytes one after
    another and compressed, and the removed spans (shard, spans), a packed array of (document in
    the shard, start, stop) per row."""
    shards, found, parts, load = anchor_contexts(docs, width, k, **sizes)
    buckets = max(1, math.ceil(load * (width - k + 1) / places_per_bucket))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches, "part"):
            yield from _settle(rows, width, piece_bytes, buckets)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans of the windows whose earliest start in their share is not the earliest of all."""
        for rows in _by_key(batches, "shard"):
            code, doc_id, shard, doc, start = np.concatenate(
                [np.frombuffer(v.as_buffer(), np.int64).reshape(5, -1) for v in rows.column("places")], axis=1)
            by = np.lexsort((start, doc, shard, doc_id, code))
            late = by[~changes(code[by])]
            yield from span_batches(shard[late], np.stack((doc[late], start[late], start[late] + width), axis=1))

    kinds = "shard long, spans binary, places binary"
    settled = stage(found.repartition(parts, "part").sortWithinPartitions("part", "anchor").mapInArrow(
        settle, kinds), "spans")
    spans = settled.where("places is null").select("shard", "spans")
    if load:
        met = settled.where("places is not null").repartition(buckets, "shard").sortWithinPartitions("shard").mapInArrow(
            meet, kinds)
        spans = spans.unionByName(stage(met.select("shard", "spans"), "met-spans"))
    return shards, spans


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of one key after another, from batches sorted by it."""
    kept: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else [0]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if kept and keys[lo] != current:
                yield pa.Table.from_batches(kept)
                kept = []
            current = keys[lo]
            kept.append(batch.slice(lo, hi - lo))
    if kept:
        yield pa.Table.from_batches(kept)


def _settle(rows: pa.Table, width: int, piece_bytes: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Spans of all windows of the contexts that start earlier somewhere else in the part, and the
    earliest places here (window hash, doc_id, shard, document, start) of the windows whose anchor
    is dealt out."""
    doc_id, start, shard, doc, anchor, heavy = (
        rows.column(c).to_numpy() for c in ("doc_id", "start", "shard", "doc", "anchor", "heavy"))
    raw, offs = text_buffers(rows.column("context"))
    size = np.diff(offs)
    code = prints(raw, offs[:-1], offs[1:])
    # equal contexts of one anchor are one: the earliest stands for them, the others go whole
    by = np.lexsort((start, doc, shard, doc_id, size, code, anchor))
    lead = changes(anchor[by], code[by], size[by])
    early, late = by[lead], by[~lead]
    data, cuts = text_buffers(rows.column("copies"))
    yield from span_batches(
        np.concatenate((np.repeat(shard, np.diff(cuts) // 24), shard[late])),
        np.concatenate((np.frombuffer(data.tobytes(), np.int64).reshape(-1, 3),
                        np.stack((doc[late], start[late], start[late] + size[late]), axis=1))))
    # windows of an anchor can meet only where it has several contexts
    first_of = np.flatnonzero(changes(anchor[early]))
    times = np.diff(np.append(first_of, len(early)))
    left = early[(np.repeat(times, times) > 1) | heavy[early]]
    doc_id, start, shard, doc, heavy = doc_id[left], start[left], shard[left], doc[left], heavy[left]
    rows = {"context": [raw[a:b].tobytes() for a, b in zip(offs[left].tolist(), offs[left + 1].tolist())]}
    sizes = np.array([len(c) for c in rows["context"]], np.int64)
    ends = np.cumsum(sizes)
    pieces, lo = [], 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + piece_bytes, side="right")))
        pieces.append((lo, hi))
        lo = hi
    # per piece: its distinct windows in order of their bytes, by a 64-bit print, and where each starts first
    table: list[tuple[np.ndarray, np.ndarray]] = []
    marks = []
    for lo, hi in pieces:
        ctx, off, group = window_groups(rows["context"][lo:hi], width)
        ctx = ctx + lo
        raw = np.frombuffer(b"".join(rows["context"][lo:hi]), np.uint8)
        base = np.concatenate(([0], np.cumsum(sizes[lo:hi])))[ctx - lo] + off
        p, q = powers(len(raw))
        total = np.zeros(len(raw) + 1, U)
        np.cumsum((raw.astype(U) + U(1)) * p[:-1], out=total[1:])
        code = mix((total[base + width] - total[base]) * q[base] + MIX2)
        # earliest of each group: by document, then start
        by = np.lexsort((start[ctx] + off, doc[ctx], shard[ctx], doc_id[ctx], group))
        ctx, off, group, code = ctx[by], off[by], group[by], code[by]
        lead = np.concatenate(([True], group[1:] != group[:-1])) if len(group) else np.zeros(0, bool)
        marks.append((ctx, off, code, lead))
        table.append((code[lead], np.flatnonzero(lead)))
    first: dict[int, np.ndarray] = {}
    codes = np.concatenate([t[0] for t in table]) if table else np.zeros(0, U)
    piece = np.repeat(np.arange(len(table)), [len(t[0]) for t in table])
    head = np.concatenate([t[1] for t in table]) if table else np.zeros(0, np.int64)
    if len(pieces) > 1:
        c = np.concatenate([ctx[lead] for ctx, _, _, lead in marks])
        o = np.concatenate([off[lead] for _, off, _, lead in marks])
        by = np.lexsort((start[c] + o, doc[c], shard[c], doc_id[c], codes))
        s = codes[by]
        best = np.concatenate(([True], s[1:] != s[:-1]))
        winners, where = s[best], by[best]
        for i in range(len(table)):
            # binary search of this piece's windows in the sorted windows of all pieces
            at = np.searchsorted(winners, table[i][0])
            mine = where[at]
            first[i] = (piece[mine] == i) & (head[mine] == table[i][1])
    out_shard, out = [np.zeros(0, np.int64)], [np.zeros((0, 3), np.int64)]
    for i, (ctx, off, code, lead) in enumerate(marks):
        gone = ~lead
        if i in first:
            gone[np.flatnonzero(lead)[~first[i]]] = True
        stays = np.flatnonzero(~gone & heavy[ctx])
        if len(stays):
            x = ctx[stays]
            yield from place_batches(_blocks(code[stays], buckets), np.stack(
                (code[stays].view(np.int64), doc_id[x], shard[x], doc[x], start[x] + off[stays])))
        ctx, off = ctx[gone], off[gone]
        by = np.lexsort((off, ctx))
        ctx, off = ctx[by], off[by]
        new = np.concatenate(([True], (ctx[1:] != ctx[:-1]) | (off[1:] != off[:-1] + 1))) if len(ctx) else np.zeros(0, bool)
        a = np.flatnonzero(new)
        b = np.concatenate((a[1:], [len(ctx)])) - 1
        x = ctx[a]
        spans = np.stack((doc[x], start[x] + off[a], start[x] + off[b] + width), axis=1) if len(a) else np.zeros((0, 3), np.int64)
        out_shard.append(shard[x])
        out.append(spans)
    yield from span_batches(np.concatenate(out_shard), np.concatenate(out))


def remove_repeats(docs: DataFrame, width: int = 100, **sizes: int) -> DataFrame:
    """(doc_id, kept, n_bytes, spans) per document: the bytes that stay and the removed runs.

    A byte is removed when it lies in a string of ``width`` bytes that also starts earlier,
    at a smaller doc_id or earlier in the same document; strings are judged on the input and
    never cross documents.  Null texts are empty; a null doc_id is the smallest; of rows with
    one doc_id, the one gathered first is the earlier; texts shorter than ``width`` stay
    whole; other columns are ignored; no rows give no rows.
    """
    shards, spans = repeated_spans(docs, width, **sizes)
    grouped = spans.groupBy("shard").agg(F.collect_list("spans").alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (ids, spans) in enumerate(zip(batch.column("ids"), batch.column("spans"))):
                raw, offs = unpack(batch, i)
                edge = np.zeros(len(raw) + 1, np.int64)
                for s in spans.values if spans.is_valid else ():
                    x = np.frombuffer(s.as_buffer(), np.int64).reshape(-1, 3)
                    np.add.at(edge, offs[x[:, 0]] + x[:, 1], 1)
                    np.add.at(edge, offs[x[:, 0]] + x[:, 2], -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept, runs, size = [], [], np.diff(offs)
                for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist()):
                    g = gone[lo:hi]
                    kept.append(raw[lo:hi][~g].tobytes())
                    step = np.diff(np.concatenate(([0], g.astype(np.int8), [0])))
                    runs.append([{"start": int(x), "stop": int(y)} for x, y in
                                 zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1))])
                kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(kept, pa.binary()), pa.array(size),
                                                  pa.array(runs, kind)], names=["doc_id", "kept", "n_bytes", "spans"])

    return (shards.join(grouped, "shard", "left").select("ids", "sizes", "body", "spans").mapInArrow(
        cut, "doc_id long, kept binary, n_bytes long, spans array<struct<start:bigint,stop:bigint>>"))

