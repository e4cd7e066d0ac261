"""Vector helpers, centroid assignment and inertia.

Centres are statistics (clusters x dimensions values): they are collected
once and inlined as literal arrays, so assignment is a narrow projection
with no join or shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # for the functions that run in tasks

MAX_CENTRE_VALUES = 1_000_000  # clusters x dims allowed on the driver


def as_double_array(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("array<double>")


def class_means(df: DataFrame, vec: str, label: str) -> dict:
    """Per-class mean vector: posexplode + groupBy(label, pos) (partial aggregation); a row without a label is of no class."""
    long = df.where(F.col(label).isNotNull()).select(F.col(label).alias("k"), F.posexplode(as_double_array(vec)).alias("pos", "x"))
    means = long.groupBy("k", "pos").agg(F.avg("x").alias("m"))
    n = means.count()
    if n > MAX_CENTRE_VALUES:
        raise ValueError(f"{n} centre values are too many to inline")
    out: dict = {}
    for r in means.collect():
        out.setdefault(r["k"], {})[r["pos"]] = r["m"]
    return {k: [v[i] for i in sorted(v)] for k, v in out.items()}


def sq_dist(v: Column, centre: list[float]) -> Column:
    c = F.array(*[F.lit(float(x)) for x in centre])
    return F.aggregate(F.zip_with(v, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)


def abs_dist(v: Column, centre: list[float]) -> Column:
    c = F.array(*[F.lit(float(x)) for x in centre])
    return F.aggregate(F.zip_with(v, c, lambda a, b: F.abs(a - b)), F.lit(0.0), lambda acc, x: acc + x)


def assign(df: DataFrame, vec: str, centres: dict, out: str = "cluster", dist_out: str | None = "dist2",
           metric: str = "l2") -> DataFrame:
    """Nearest centre per row (ties -> smallest centre key); optionally its distance."""
    keys = sorted(centres)
    v = as_double_array(vec)
    fn = sq_dist if metric == "l2" else abs_dist
    staged = df.withColumn("_v", v)
    dcols = {f"_d{i}": fn(F.col("_v"), centres[k]) for i, k in enumerate(keys)}
    staged = staged.withColumns(dcols)
    best = F.least(*[F.col(c) for c in dcols])
    pick = None
    for i, k in enumerate(keys):
        cond = F.col(f"_d{i}") == best
        pick = F.when(cond, F.lit(k)) if pick is None else pick.when(cond, F.lit(k))
    staged = staged.withColumn(out, pick)
    if dist_out:
        staged = staged.withColumn(dist_out, best)
    return staged.drop("_v", *dcols)


def inertia(assigned: DataFrame, dist2: str = "dist2") -> DataFrame:
    """Within-cluster sum of squared distances."""
    return assigned.agg(F.sum(dist2).alias("inertia"))


# ---------------------------------------------------------------- many k-means runs in common passes

ROWS_AT_ONCE = 1024  # rows whose distances to all centres a task holds


def packed_vectors(df: DataFrame, vec: str):
    """The vectors as numpy blocks, one for each Arrow batch: a cached RDD, read once for each pass."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column(0).flatten(), np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([b.num_rows], pa.int32())],
                                                 names=["x", "n"])

    rows = df.select(as_double_array(vec).alias("x")).mapInArrow(pack, "x binary, n int")
    return rows.rdd.map(lambda r: np.frombuffer(r["x"], np.float64).reshape(r["n"], -1)).persist(StorageLevel.MEMORY_AND_DISK)


def nearest(x: np.ndarray, centres: np.ndarray, ends: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per run the nearest of its centres and the squared distance of every row; ``centres`` stacks those of all runs, which
    end at ``ends``."""
    d = centres @ x.T
    d *= -2
    d += (centres ** 2).sum(axis=1)[:, None]
    square = (x ** 2).sum(axis=1)
    lo = 0
    for hi in ends:
        best, least = np.zeros(len(x), np.int32), d[lo].copy()
        for j in range(lo + 1, hi):  # a strictly smaller distance only: the first of equals stays
            best[d[j] < least] = j - lo
            np.minimum(least, d[j], out=least)
        yield best, np.maximum(least + square, 0)
        lo = hi


def _pass_sums(blocks: Iterator[np.ndarray], centres: np.ndarray, ends: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """Of a task's rows per run: number and sum of the rows of every centre, and at the end the sum of squared distances."""
    width, firsts = centres.shape[1], [0, *ends[:-1]]
    total = np.zeros((len(centres), width + 1))
    cost = np.zeros(len(ends))
    for block in blocks:
        for lo in range(0, len(block), ROWS_AT_ONCE):
            x = block[lo:lo + ROWS_AT_ONCE]
            member = np.empty((len(centres), len(x)))
            for run, (best, dist) in enumerate(nearest(x, centres, ends)):
                for j in range(firsts[run], ends[run]):
                    np.equal(best, j - firsts[run], out=member[j])
                cost[run] += dist.sum()
            total[:, 0] += member.sum(axis=1)
            total[:, 1:] += member @ x
    for run, (lo, hi) in enumerate(zip(firsts, ends)):
        yield run, np.append(total[lo:hi].reshape(-1), cost[run])


def lloyd(blocks, starts: Sequence[np.ndarray], max_iter: int = 300, tol: float = 1e-4) -> list[tuple[np.ndarray, float, int]]:
    """Lloyd's iterations of all runs at once: (centres, cost, iterations) of each.

    Every pass over the rows serves all runs that still move.  A run ends when no centre moved by more than ``tol``; its cost is
    that of its last pass, as Spark ML's k-means reports it.  A centre without rows stays where it is.
    """
    centres = [np.array(c, np.float64) for c in starts]
    cost, turns, live = [0.0] * len(centres), [0] * len(centres), list(range(len(centres)))
    for _ in range(max_iter):
        if not live:
            break
        stacked, ends = np.concatenate([centres[i] for i in live]), np.cumsum([len(centres[i]) for i in live]).tolist()
        got = blocks.mapPartitions(lambda b, c=stacked, e=ends: _pass_sums(b, c, e)).reduceByKey(np.add).collectAsMap()
        still = []
        for run, i in enumerate(live):
            sums = got[run][:-1].reshape(len(centres[i]), -1)
            new = np.where(sums[:, :1] > 0, sums[:, 1:] / np.maximum(sums[:, :1], 1), centres[i])
            moved = ((new - centres[i]) ** 2).sum(axis=1).max()
            centres[i], cost[i], turns[i] = new, float(got[run][-1]), turns[i] + 1
            if moved > tol * tol:
                still.append(i)
        live = still
    return list(zip(centres, cost, turns))


def assign_all(df: DataFrame, vec: str, runs: Sequence[np.ndarray], out: str) -> DataFrame:
    """``df`` with an array column: the nearest centre (by number) of every run, in one pass."""
    from pyspark.sql.functions import pandas_udf
    centres, ends = np.concatenate(runs), np.cumsum([len(r) for r in runs]).tolist()

    def label(v):
        import pandas as pd
        x = np.stack(v.to_numpy()).astype(np.float64) if len(v) else np.zeros((0, centres.shape[1]))
        each = []
        for lo in range(0, len(x), ROWS_AT_ONCE):
            each.append(np.stack([b for b, _ in nearest(x[lo:lo + ROWS_AT_ONCE], centres, ends)], axis=1))
        return pd.Series(list(np.concatenate(each).astype(np.int32)) if each else [], index=v.index)

    return df.withColumn(out, pandas_udf(label, "array<int>")(as_double_array(vec)))
