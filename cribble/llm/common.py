"""Helpers shared by the operators: staged tables, connected components, flat text arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cribble.session import ensure_checkpoint_dir

U = np.uint64
# -- fixed values: odd multipliers of the hash functions (golden ratio, splitmix64 finaliser).
MUL = U(0x9E3779B97F4A7C15)
MIX1 = U(0xBF58476D1CE4E5B9)
MIX2 = U(0x94D049BB133111EB)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor rereads files instead of repeating the job,
    and rows are the same for every later reader.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(docs: DataFrame, *replaced: str) -> Column:
    """All columns of ``docs`` but the replaced ones in one struct, so that no name of theirs meets an operator's own."""
    gone = {c.lower() for c in replaced}
    names = [c for c in docs.columns if c.lower() not in gone]
    return F.struct(*[F.col(f"`{c}`") for c in names])


def given_back(docs: DataFrame, held: str, *replaced: str) -> list[Column]:
    """The columns that ``kept`` put into the struct ``held``."""
    gone = {c.lower() for c in replaced}
    return [F.col(f"{held}.`{c}`").alias(c) for c in docs.columns if c.lower() not in gone]


# ------------------------------------------------------------ connected components

def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
    return row[0], row[1] or 0


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node on an edge.

    Alternating large-star / small-star rounds.  Every round is a map-side
    combined minimum and a join; a hub with most edges is split by the adaptive
    skew join and each round is checkpointed.  Nulls and self-loops are ignored,
    repeated edges count once; without edges the result is empty.
    """
    e = (edges.where(F.col(a) != F.col(b))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().checkpoint())
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        old, e = e, small.checkpoint()
        new = _mark(e)
        # equal marks hint at the end, equal edge sets are it
        if new == mark and not e.join(old, ["u", "v"], "left_anti").limit(1).count():
            break
        mark = new
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


# ------------------------------------------------------------ flat text arrays (inside tasks)

def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, elementwise on uint64."""
    h = (h ^ (h >> U(30))) * MIX1
    h = (h ^ (h >> U(27))) * MIX2
    return h ^ (h >> U(31))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string/binary column and the row offsets into them; null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    n = len(col)
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``most`` text bytes (one longer text stays whole)."""
    for batch in batches:
        _, offs = text_buffers(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offs, offs[start] + most, side="right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for substring hashes by prefix sums."""
    base = 0x9E3779B97F4A7C15
    inv = pow(base, -1, 1 << 64)
    p, q = np.full(n + 1, U(base)), np.full(n + 1, U(inv))
    p[0] = q[0] = U(1)
    return np.multiply.accumulate(p), np.multiply.accumulate(q)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of every byte span [start, end): equal bytes give equal hashes in any task.

    ``values`` (one number for each byte) makes it another hash function."""
    p, q = powers(len(raw))
    total = np.zeros(len(raw) + 1, U)
    np.cumsum((raw.astype(U) + U(1) if values is None else values[raw]) * p[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * q[starts] + (ends - starts).astype(U) * MIX1)


def sorted_set(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; for the many short arrays of a task a plain sort is faster than ``np.unique``."""
    s = np.sort(values)
    new = np.ones(len(s), bool)
    np.not_equal(s[1:], s[:-1], out=new[1:])
    return s[new]


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """Number of values in both of two sorted arrays of distinct values."""
    return int(np.count_nonzero(b.take(b.searchsorted(a), mode="clip") == a)) if len(a) and len(b) else 0


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


def word_spans(raw: np.ndarray, offs: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, row) of the maximal runs of bytes that are no space, never across rows."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~space[raw]
    first = np.zeros(len(raw), bool)
    first[offs[:-1][offs[:-1] < len(raw)]] = True  # a row starts a new run
    start = word & (np.concatenate(([True], ~word[:-1])) | first)
    last = np.concatenate((~word[1:] | first[1:], [True])) & word
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offs, starts, side="right") - 1


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + c) for every (s, c)."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)
