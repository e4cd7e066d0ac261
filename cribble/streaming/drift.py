"""Numeric drift per event-time window, with the counts in the state store.

The reference is fitted once: cut points of every feature and the reference counts between them.  A stream is
counted per (window, feature, bin); the watermark closes a window, its counts leave the state in append mode,
and the two-sample statistic at the cut points is computed once for each closed window.  State is windows still open x
features x bins, whatever the number of rows; a row later than the watermark is dropped by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cribble.functions.numeric import rnd
from cribble.functions.quantiles import exact_quantiles
from cribble.operators.drift import ks_pvalue


@dataclass
class Reference:
    """Cut points and reference counts per feature; bin b holds the values above b of the cut points."""
    cuts: dict[str, list[float]]
    counts: dict[str, list[int]]


def bin_of(value: Column, cuts: Sequence[float]) -> Column:
    """Number of cut points below the value (null for null and NaN)."""
    out = F.lit(0)
    for c in cuts:
        out = out + (value > F.lit(float(c))).cast("int")
    return F.when(value.isNotNull() & ~F.isnan(value), out)


def fit_reference(df: DataFrame, features: Sequence[str], bins: int = 10) -> Reference:
    """Cut points are the exact quantiles i / bins of the reference rows (equal ones count once)."""
    probs = [i / bins for i in range(1, bins)]
    q = exact_quantiles(df, features, probs)
    cuts = {f: sorted({float(q[((), f, p)]) for p in probs if q[((), f, p)] is not None}) for f in features}
    rows = counted(df, features, cuts).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {f: [0] * (len(cuts[f]) + 1) for f in features}
    for r in rows:
        counts[r["feature"]][r["bin"]] = r["n"]
    return Reference(cuts, counts)


def counted(df: DataFrame, features: Sequence[str], cuts: dict[str, list[float]], *keep: str) -> DataFrame:
    """One row (feature, bin) for every value that is not null."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), bin_of(F.col(f).cast("double"), cuts[f]).alias("bin")) for f in features])
    return df.select(*keep, F.inline(pairs)).where(F.col("bin").isNotNull())


def window_counts(stream: DataFrame, ts: str, features: Sequence[str], reference: Reference, window: str = "1 day",
                  delay: str = "1 hour") -> DataFrame:
    """(w, feature, bin, n) of a stream or table; on a stream each window's counts come once, when it is closed."""
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return counted(s, features, reference.cuts, ts).groupBy(F.window(ts, window).alias("w"), "feature", "bin").agg(
        F.count(F.lit(1)).alias("n"))


def window_drift(counts: DataFrame, reference: Reference, min_n: int = 10) -> DataFrame:
    """Per closed window and feature: n_ref, n_cur, ks_statistic, p_value, drift_detected.

    Windows with fewer than ``min_n`` values of a feature, on either side, are left out for it.
    """
    per = counts.groupBy("w", "feature").agg(F.sum("n").alias("n_cur"),
                                             F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("by_bin"))
    share = {}
    for f, c in reference.counts.items():
        total, run = sum(c), 0
        share[f] = []
        for n in c[:-1]:
            run += n
            share[f].append(run / total if total else 0.0)
    n_ref = F.element_at(F.create_map(*[x for f, c in reference.counts.items() for x in (F.lit(f), F.lit(int(sum(c))))]), F.col("feature"))
    ref = F.element_at(F.create_map(*[x for f, s in share.items() for x in (
        F.lit(f), F.array(*[F.lit(v) for v in s]) if s else F.array().cast("array<double>"))]), F.col("feature"))

    def upto(b):
        return F.aggregate(F.filter(F.map_entries("by_bin"), lambda e: e["key"] <= b), F.lit(0).cast("long"),
                           lambda a, e: a + e["value"]).cast("double")

    gaps = F.transform(ref, lambda r, i: F.abs(r - upto(i) / F.col("n_cur").cast("double")))
    d = F.coalesce(F.array_max(gaps), F.lit(0.0))
    rows = per.select("w", "feature", n_ref.cast("long").alias("n_ref"), "n_cur", d.alias("d")).where(
        (F.col("n_ref") >= min_n) & (F.col("n_cur") >= min_n))
    p = ks_pvalue(F.col("d"), F.col("n_ref"), F.col("n_cur"))
    return rows.select("w", "feature", "n_ref", "n_cur", rnd("d", 4).alias("ks_statistic"), rnd(p, 4).alias("p_value"),
                       (p < F.lit(0.05)).alias("drift_detected"))
