"""Embedding near-duplicates by random-hyperplane sign hashing.

Several tables hash every vector to the signs of its projections on random hyperplanes.
Vectors of one bucket are compared in blocks by matrix products in double precision; a
pair counts in the first table where both share a bucket, so counts and links need no
list of pairs.  Components come from the blocks' spanning forests.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cribble.llm.common import connected_components, stage


def table_plan(rows: int, cosine: float, recall: float, bucket: int) -> tuple[int, int]:
    """(bits, tables): buckets hold about ``bucket`` unrelated vectors, and a pair at exactly
    ``cosine`` shares one in some table with probability ``recall`` at least."""
    bits = max(1, math.ceil(math.log2(max(2.0, rows / bucket))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - same)))


def signatures(x: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """Bucket of every vector in every table (rows x tables)."""
    planes = np.random.default_rng([seed, x.shape[1]]).standard_normal((x.shape[1], bits * tables))
    signs = (x @ planes > 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Indices of the pairs that join two trees (union-find with path halving)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        root.setdefault(x, x)
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[max(rx, ry)] = min(rx, ry)
            kept.append(i)
    return kept


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9,
                    recall: float = 0.998, bucket: int = 256, block: int = 512, seed: int = 7) -> DataFrame:
    """One row per ``key``: n_links, component_id (smallest key reachable) and kept.

    Links are pairs of cosine at least ``cosine`` that share a bucket in some table; bits
    and tables follow from the row count by one formula (``table_plan``), and no bucket
    or partner list is cut: a bucket of more than ``block`` rows is compared as tiles of
    blocks.  Equal vectors are one class first, so copies are counted by multiplicity,
    never paired.  Null, empty, zero or non-finite vectors and vectors with a null
    component link with nothing; vectors of different length never meet; repeated rows
    count once; of several vectors under one key the smallest by its values stands; a
    null key is one key; other columns are ignored; no rows give no rows.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.groupBy("id").agg(F.min("x").alias("x"))
    good = (F.col("x").isNotNull() & (F.size("x") > 0)
            & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
            & F.exists("x", lambda v: v != 0))
    rows = stage(rows.withColumn("ok", F.coalesce(good & F.col("id").isNotNull(), F.lit(False)))
                 .withColumn("x", F.when(F.col("ok"), F.col("x"))), "vectors")
    classes = stage(rows.where("ok").groupBy("x").agg(F.min("id").alias("rep"), F.count("*").alias("copies")),
                    "vector-classes")
    n = classes.count()
    bits, tables = table_plan(n, cosine, recall, bucket)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps = batch.column("rep").to_numpy(zero_copy_only=False)
            copies = batch.column("copies").to_numpy(zero_copy_only=False)
            lists = batch.column("x")
            sizes = np.asarray(lists.value_lengths())
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for lo in range(0, len(at), 1024):
                    part = at[lo:lo + 1024]
                    x = np.asarray(lists.take(pa.array(part)).flatten()).reshape(len(part), size)
                    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares stay finite
                    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
                    sig = signatures(unit, bits, tables, seed)
                    packed = [u.tobytes() for u in unit]
                    sigs = [s.tobytes() for s in sig]
                    for t in range(tables):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(part), t, np.int32)), pa.array(np.full(len(part), size, np.int32)),
                            pa.array(sig[:, t]), pa.array(reps[part]), pa.array(copies[part]),
                            pa.array(packed, pa.binary()), pa.array(sigs, pa.binary())],
                            names=["t", "dim", "bucket", "rep", "copies", "unit", "sig"])

    spread = stage(classes.repartition(max(1, min(4096, math.ceil(n * tables / 200_000)) * 2)).mapInArrow(
        hashed, "t int, dim int, bucket long, rep long, copies long, unit binary, sig binary"), "buckets")
    counts = spread.groupBy("t", "dim", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    # tile (i, j), i <= j, compares block i with block j; a row goes to the tiles of its block
    tiled = (spread.join(counts.withColumn("blocks", blocks).drop("n"), ["t", "dim", "bucket"])
             .withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("rep", kind="stable")
        rep, copies = g["rep"].to_numpy(), g["copies"].to_numpy()
        dim, t = int(g["dim"].iloc[0]), int(g["t"].iloc[0])
        unit = np.frombuffer(b"".join(g["unit"]), np.float64).reshape(len(g), dim)
        sig = np.frombuffer(b"".join(g["sig"]), np.int64).reshape(len(g), -1)
        left = np.flatnonzero(g["mine"].to_numpy() == g["i"].iloc[0])
        right = np.flatnonzero(g["mine"].to_numpy() == g["j"].iloc[0])
        same = g["i"].iloc[0] == g["j"].iloc[0]
        links = np.zeros(len(g), np.int64)
        pa_, pb_ = [], []
        for lo in range(0, len(left), 256):
            a = left[lo:lo + 256]
            x, y = np.nonzero(unit[a] @ unit[right].T >= cosine)
            x, y = a[x], right[y]
            if same:
                x, y = x[x < y], y[x < y]
            first = (sig[x, :t] != sig[y, :t]).all(axis=1)  # no earlier table brought them together
            x, y = x[first], y[first]
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            kept = _forest(rep[x], rep[y])
            pa_.append(rep[x][kept])
            pb_.append(rep[y][kept])
        a, b = np.concatenate(pa_), np.concatenate(pb_)
        kept = _forest(a, b)
        hit = links > 0
        return pd.DataFrame({"a": np.concatenate((a[kept], rep[hit])), "b": np.concatenate((b[kept], rep[hit])),
                             "links": np.concatenate((np.zeros(len(kept), np.int64), links[hit]))})

    found = stage(tiled.groupBy("t", "dim", "bucket", "i", "j").applyInPandas(
        compare, "a long, b long, links long"), "vector-links")
    degree = found.where("links > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    component = connected_components(found.where("links = 0"), "a", "b")
    per_class = (classes.join(degree, "rep", "left").join(component.withColumnRenamed("node", "rep"), "rep", "left")
                 .select("x", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("component", "rep").alias("component_id")))
    return (rows.where("ok").join(per_class, "x").select("id", "n_links", "component_id")
            .unionByName(rows.where("not ok").select("id", F.lit(0).cast("long").alias("n_links"),
                                                     F.col("id").alias("component_id")))
            .select(F.col("id").alias(key), "n_links", "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))
