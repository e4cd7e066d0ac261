"""Prefix trie of conversations from padded turn-id matrices.

Conversations become paths of turn digests and are dealt to shards by range, so the members
of a trie node stand next to each other and only nodes on the first or last path of a shard can
go on in another.  In a shard the turns become ids in order, rows are sorted by numpy's lexsort over
padded matrices (16 turns a block, so one long conversation does not widen all), an OR-accumulated
mask of changed columns marks where nodes start, and reduceat sums up every depth from the deepest.
All figures of boundary nodes are sums over the shards plus corrections from each pair of neighbouring
shards, so one grouped sum recombines them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cribble.llm.common import ranges, stage, text_buffers

BLOCK = 16   # turns of one padded matrix
DIGEST = 16  # bytes of a turn's digest
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

SHARD_SCHEMA = ("kind string, shard int, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, "
                "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends binary, "
                "first_path binary, last_path binary, last_chars array<long>")
NAMES = [c.split()[0] for c in SHARD_SCHEMA.split(", ")]
SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]


# ------------------------------------------------------------ paths

def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of every conversation in order as (digest in hex, code points).

    Order is by turn (null first), then digest.  Null role or text counts as empty, rows without a conv_id
    belong to no conversation and are left out, other columns are ignored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role in front keeps role and text apart
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    told = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn").isNotNull().alias("has"), "turn", digest.alias("digest"),
                                                F.length(text).cast("long").alias("chars")).alias("t"))
    return told.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(
        t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def share_openings(convs: DataFrame, step: int, shared: Column, most: int) -> DataFrame:
    """Every conversation c with its first ``shared`` (0 to ``most``) turns replaced by those of conversation
    c - c % step (fewer, or none, where that one has fewer or is absent); c's own turns after its first ``shared`` follow."""
    base = F.col("conv_id") - F.col("conv_id") % step
    heads = convs.where(F.col("conv_id") % step == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    rest = F.slice(F.col("turns"), F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    opening = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return (convs.withColumn("h", shared.cast("int")).withColumn("base", base).join(heads, "base", "left")
            .select("conv_id", F.concat(opening, rest).alias("turns")))


# ------------------------------------------------------------ one shard

def turn_ids(raw: np.ndarray) -> np.ndarray:
    """Ids from 1 of all digests (one after the other in ``raw``), in the order of their bytes."""
    words = raw.view(">u8").astype(np.uint64).reshape(-1, 2)
    order = np.lexsort((words[:, 1], words[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (words[order][1:] != words[order][:-1]).any(axis=1)
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def padded(ids: np.ndarray, start: np.ndarray, length: np.ndarray, block: int) -> np.ndarray:
    """Turns block * BLOCK to (block + 1) * BLOCK of every row, 0 after its end."""
    left = np.clip(length - block * BLOCK, 0, BLOCK)
    out = np.zeros((len(start), int(left.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < left[:, None]] = ids[ranges(start + block * BLOCK, left)]
    return out


def path_order(ids: np.ndarray, start: np.ndarray, length: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Order of the rows by path, then conversation.  Blocks are ranked from the last to the first,
    each only over the rows that reach it."""
    rank = np.zeros(len(start), np.int64)
    for block in range(-(-int(length.max(initial=0)) // BLOCK) - 1, -1, -1):
        rows = np.flatnonzero(length > block * BLOCK)
        m = padded(ids, start[rows], length[rows], block)
        order = np.lexsort((rank[rows], *m.T[::-1]))
        new = np.ones(len(rows), bool)
        new[1:] = (m[order][1:] != m[order][:-1]).any(axis=1) | (rank[rows][order][1:] != rank[rows][order][:-1])
        rank[rows[order]] = np.cumsum(new)
    return np.lexsort((conv, rank))


def node_starts(ids: np.ndarray, start: np.ndarray, length: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every depth from 1: the rows (sorted by path) that reach it, and which of them begin a node."""
    out = []
    changed = np.zeros(len(start), bool)  # the path so far differs from that of the row before
    for block in range(-(-int(length.max(initial=0)) // BLOCK)):
        rows = np.flatnonzero(length > block * BLOCK)
        m = padded(ids, start[rows], length[rows], block)
        mask = np.ones(m.shape, bool)
        mask[1:] = m[1:] != m[:-1]
        mask[:, 0] |= changed[rows] | np.concatenate(([True], np.diff(rows) > 1))
        mask = np.logical_or.accumulate(mask, axis=1)
        changed[rows] = mask[:, -1]
        for j in range(m.shape[1]):
            here = np.flatnonzero(m[:, j])
            out.append((rows[here], mask[here, j]))
    return out


def prefix_keys(path: bytes) -> list[bytes]:
    """Digest of every prefix of a path, the empty one first."""
    h, out = hashlib.md5(), [hashlib.md5().digest()]
    for i in range(0, len(path), DIGEST):
        h.update(path[i:i + DIGEST])
        out.append(h.digest())
    return out


def _joined(conv: np.ndarray) -> bytes:
    return ",".join(map(str, conv.tolist())).encode()


def shard_nodes(shard: int, conv: np.ndarray, raw: np.ndarray, offs: np.ndarray, chars: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard: whole ones, parts of those on its first or last path, and one row with these paths."""
    length = np.diff(offs) // DIGEST
    start = offs[:-1] // DIGEST
    ids = turn_ids(raw)
    order = path_order(ids, start, length, conv)
    conv, length, start = conv[order], length[order], start[order]
    depths = [(np.arange(len(conv)), np.arange(len(conv)) == 0), *node_starts(ids, start, length)]

    def path(row: int) -> bytes:
        return raw[start[row] * DIGEST:(start[row] + length[row]) * DIGEST].tobytes()

    first, last = path(0), path(-1)
    first_keys, last_keys = prefix_keys(first), prefix_keys(last)
    n_rows = len(conv)
    leaf_sum, saved_sum = np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
    child = np.zeros(n_rows, np.int64)  # a child of the depth above begins here
    below: dict | None = None

    def flush(t: dict, parent: np.ndarray, parent_key: list) -> pa.RecordBatch:
        n = len(t["conv_id"])
        cols = {"kind": ["part" if k else "node" for k in t["key"]], "shard": [shard] * n, "depth": [t["depth"]] * n,
                "key": t["key"], "parent_key": parent_key, "conv_id": t["conv_id"],
                "parent_conv_id": pa.array(parent, mask=np.array([k is not None for k in parent_key], bool)),
                **{c: t[c] for c in SUMS}, "ends_sha256": t["sha"], "ends": t["ends"]}
        return batch_of(n, cols)

    for depth in range(len(depths) - 1, -1, -1):
        rows, begins = depths[depth]
        at = np.flatnonzero(begins)
        ends = np.append(at[1:], len(rows))
        n = ends - at
        closing = np.add.reduceat((length[rows] == depth).astype(np.int64), at)
        children = np.add.reduceat(child[rows], at)
        text = chars[start[rows[at]] + depth - 1] if depth else np.zeros(1, np.int64)
        leaves = np.add.reduceat(leaf_sum[rows], at) + (children == 0)
        saved = np.add.reduceat(saved_sum[rows], at) + (n - 1) * text
        least = np.minimum.reduceat(conv[rows], at)
        for total, own in ((leaf_sum, leaves), (saved_sum, saved), (child, 1)):
            total[rows] = 0
            total[rows[at]] = own
        key: list[bytes | None] = [None] * len(at)
        if rows[0] == 0:
            key[0] = first_keys[depth]
        if rows[-1] == n_rows - 1:
            key[-1] = last_keys[depth]
        sha, pieces = [EMPTY_SHA] * len(at), [None] * len(at)
        for k in np.flatnonzero(closing).tolist():  # the ends of a node come before its children, by conv_id
            text_ids = _joined(conv[rows[at[k]:at[k] + closing[k]]])
            sha[k] = hashlib.sha256(text_ids).hexdigest()
            if key[k] is not None:
                pieces[k] = text_ids
        if below is not None:
            owner = np.searchsorted(rows[at], below["at"], side="right") - 1
            yield flush(below, least[owner], [key[k] for k in owner.tolist()])
        below = {"depth": depth, "at": rows[at], "conv_id": least, "key": key, "n_convs": n, "n_children": children,
                 "n_leaves": leaves, "saved_tokens": saved, "sha": sha, "ends": pieces}
    # the root is on every path; its parent stays null
    yield flush(below, np.zeros(1, np.int64), [b""])
    yield batch_of(1, {"kind": ["edge"], "shard": [shard], "first_path": [first], "last_path": [last],
                       "last_chars": [chars[start[-1]:start[-1] + length[-1]].tolist()]})


def batch_of(n: int, cols: dict) -> pa.RecordBatch:
    types = {"kind": pa.string(), "shard": pa.int32(), "ends_sha256": pa.string(), "last_chars": pa.list_(pa.int64()),
             **{c: pa.binary() for c in ("key", "parent_key", "ends", "first_path", "last_path")}}
    arrays = [pa.array(cols[c], types.get(c, pa.int64())) if c in cols else pa.nulls(n, types.get(c, pa.int64()))
              for c in NAMES]
    return pa.RecordBatch.from_arrays(arrays, names=NAMES)


def shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        raw, offs = text_buffers(t.column("path"))
        chars = t.column("chars").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        yield from shard_nodes(TaskContext.get().partitionId(), t.column("conv_id").to_numpy(),
                               np.frombuffer(raw.tobytes(), np.uint8), offs, chars)


# ------------------------------------------------------------ recombination

def corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two neighbouring shards count twice along the path that both share.

    A node on it is a child in both, its last text is left out of ``saved_tokens`` once too often, and
    where the path ends with the first shard, that node looked like a leaf there.
    """
    for batch in batches:
        for row in batch.to_pylist():
            a, b = row["last_path"], row["next_path"]
            shared = 0
            while shared < min(len(a), len(b)) // DIGEST and (
                    a[shared * DIGEST:(shared + 1) * DIGEST] == b[shared * DIGEST:(shared + 1) * DIGEST]):
                shared += 1
            keys = prefix_keys(a[:shared * DIGEST])
            texts = np.array([0, *row["last_chars"][:shared]], np.int64)
            n = shared + 1
            yield batch_of(n, {
                "kind": ["part"] * n, "shard": [row["shard"]] * n, "depth": list(range(n)), "key": keys,
                "parent_key": [b"", *keys[:-1]], "n_convs": [0] * n, "n_children": [-1] * shared + [0],
                "n_leaves": [-1 if len(a) == shared * DIGEST else 0] * n,
                "saved_tokens": np.cumsum(texts[::-1])[::-1]})


def stream_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends_sha256) from the pieces (key, ends), which come sorted by key and shard: a hash at a time."""
    key, state = None, None
    for batch in batches:
        keys, out = [], []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends")):
            if k != key:
                if key is not None:
                    keys.append(key)
                    out.append(state.hexdigest())
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())],
                                         names=["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])],
                                         names=["key", "ends_sha256"])


def shard_count(turns: int) -> int:
    """About 16 thousand turns a shard up to a thousand shards, then a quarter million."""
    return max(1, min(turns >> 14, 1024), turns >> 18)


def prefix_trie(convs: DataFrame, salts: int = 32) -> DataFrame:
    """One row per trie node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``convs`` (conv_id, turns: array of digest and chars) as made by ``paths``; a conv_id stands once.
    A node is a distinct sequence of first turns, the root (depth 0, parent null) the empty one.
    n_leaves and saved_tokens ((n_convs - 1) times the code points of the last text) are summed over the subtree.
    ends_sha256 is over the ascending conv_ids of the members that end at the node, joined by commas.
    A conversation without turns is a member of the root, no conversations give no nodes.  A path is in one shard whole, as
    are the about 16 thousand to a quarter million turns of a shard; equal paths are dealt by conv_id, so a
    conversation that stands in a third of the rows spreads over shards.
    """
    rows = stage(convs.select("conv_id", F.unhex(F.array_join("turns.digest", "")).alias("path"),
                              F.col("turns.chars").alias("chars")), "trie-paths")
    shards = shard_count(rows.agg(F.sum(F.size("chars"))).first()[0] or 0)
    told = stage(rows.repartitionByRange(shards, "path", "conv_id").mapInArrow(shard_rows, SHARD_SCHEMA), "trie-shards")

    # one row a shard: the neighbour of each, and what both count
    edges = told.where("kind = 'edge'").select("shard", "last_path", "last_chars", F.lead("first_path").over(
        Window.orderBy("shard")).alias("next_path")).where("next_path is not null")
    parts = told.where("kind = 'part'")
    both = parts.unionByName(edges.mapInArrow(corrections, SHARD_SCHEMA))
    hashes = (parts.where("ends is not null").select("key", "shard", "ends").repartition("key")
              .sortWithinPartitions("key", "shard").select("key", "ends")
              .mapInArrow(stream_hashes, "key binary, ends_sha256 string"))
    merged = stage(both.groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in SUMS]).join(hashes, "key", "left"), "trie-boundary")

    up = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    out = ["conv_id", "depth", "parent_conv_id", *SUMS, "ends_sha256"]
    boundary = (merged.join(up, "parent_key", "left")
                .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))).select(*out))
    whole = told.where("kind = 'node'")
    # children of one boundary node may be a third of all nodes: they meet it in salted copies
    salted = up.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    under = (whole.where("parent_key is not null").drop("parent_conv_id")
             .withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(salts)).cast("int"))
             .join(salted, ["parent_key", "salt"]).select(*out))
    return whole.where("parent_key is null").select(*out).unionByName(under).unionByName(boundary)
