"""Numeric and text drift.

Two-sample Kolmogorov-Smirnov: the samples are pre-aggregated to distinct
``(feature, value)`` rows with per-side counts (a hot value becomes one
row), then empirical CDFs are running sums in value order.  The running sum
is not a single-task window: distinct values are cut into value buckets by
approximate quantiles, summed inside each (feature, bucket) partition, and
shifted by the totals of the earlier buckets (a table of features x buckets
rows).  The p-value is the asymptotic Kolmogorov series, evaluated in SQL.

Text drift: Jensen-Shannon distance between the token distributions of two
corpora over their joint top-V vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cribble.functions.numeric import rnd

KS_TERMS = 100


def ks_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sided p-value, effective n = n1*n2/(n1+n2), with the
    usual small-sample correction of the argument; clamped to [0, 1]."""
    en = n1.cast("double") * n2.cast("double") / (n1 + n2).cast("double")
    lam = (F.sqrt(en) + F.lit(0.12) + F.lit(0.11) / F.sqrt(en)) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
        lambda acc, k: acc + F.lit(2.0) * F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * (k * k).cast("double") * lam * lam))
    return F.when(lam < F.lit(0.05), F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def _distinct_values(df: DataFrame, side: str, ref_value, features: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
    long = df.select((F.col(side) == F.lit(ref_value)).alias("is_ref"), F.explode(F.array(*pairs)).alias("p"))
    long = long.select("is_ref", "p.feature", "p.value").where(
        F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy("feature", "value").agg(
        F.sum(F.col("is_ref").cast("long")).alias("n_ref"),
        F.sum((~F.col("is_ref")).cast("long")).alias("n_cur"))


def ks_two_sample(df: DataFrame, side: str, ref_value, features: Sequence[str], min_n: int = 10,
                  rows_per_bucket: int = 100_000) -> DataFrame:
    """Per feature: n_ref, n_cur, ks_statistic, p_value, drift_detected.

    Features with fewer than ``min_n`` non-null values on either side are omitted.
    """
    # the distinct-value table feeds three jobs (totals, bucket bounds, CDF): keep it
    dv = _distinct_values(df, side, ref_value, features).persist(StorageLevel.MEMORY_AND_DISK)
    totals = {r["feature"]: r for r in dv.groupBy("feature").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"),
        F.count(F.lit(1)).alias("n_distinct")).collect()}
    keep = [f for f in features if f in totals and totals[f]["n_ref"] >= min_n and totals[f]["n_cur"] >= min_n]
    spark = df.sparkSession
    schema = "feature string, n_ref long, n_cur long, ks_statistic double, p_value double, drift_detected boolean"
    if not keep:
        return spark.createDataFrame([], schema)
    dv = dv.where(F.col("feature").isin(keep))

    # value buckets from approximate quantiles of the distinct values
    n_b = {f: max(1, math.ceil(totals[f]["n_distinct"] / rows_per_bucket)) for f in keep}
    bounds: dict[str, list[float]] = {f: [] for f in keep}
    multi = [f for f in keep if n_b[f] > 1]
    if multi:
        probs = sorted({i / n_b[f] for f in multi for i in range(1, n_b[f])})
        for r in (dv.where(F.col("feature").isin(multi)).groupBy("feature")
                  .agg(F.percentile_approx("value", probs, max(10_000, 10 * max(n_b.values()))).alias("q")).collect()):
            bounds[r["feature"]] = sorted(set(r["q"]))
    # bucket ids by binary search (Spark ML Bucketizer) on each feature's slice of
    # the distinct values; features with one bucket get bucket 0
    sliced = []
    for f in keep:
        part = dv.where(F.col("feature") == f)
        if bounds[f]:
            splits = [float("-inf")] + [float(b) for b in bounds[f]] + [float("inf")]
            part = Bucketizer(splits=splits, inputCol="value", outputCol="_b").transform(part)
            part = part.withColumn("bucket", F.col("_b").cast("int")).drop("_b")
        else:
            part = part.withColumn("bucket", F.lit(0))
        sliced.append(part)
    dv = sliced[0]
    for part in sliced[1:]:
        dv = dv.unionByName(part)
    w = Window.partitionBy("feature", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    local = dv.select("feature", "bucket", "value",
                      F.sum("n_ref").over(w).alias("run_ref"), F.sum("n_cur").over(w).alias("run_cur"))
    btot = dv.groupBy("feature", "bucket").agg(F.sum("n_ref").alias("b_ref"), F.sum("n_cur").alias("b_cur"))
    wo = Window.partitionBy("feature").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = btot.select("feature", "bucket",
                          F.coalesce(F.sum("b_ref").over(wo), F.lit(0)).alias("off_ref"),
                          F.coalesce(F.sum("b_cur").over(wo), F.lit(0)).alias("off_cur"))
    # offsets: features x buckets rows, one for every rows_per_bucket distinct values
    cdf = local.join(F.broadcast(offsets), ["feature", "bucket"])
    n_ref = F.element_at(F.create_map(*[x for f in keep for x in (F.lit(f), F.lit(int(totals[f]["n_ref"])))]),
                         F.col("feature"))
    n_cur = F.element_at(F.create_map(*[x for f in keep for x in (F.lit(f), F.lit(int(totals[f]["n_cur"])))]),
                         F.col("feature"))
    diff = F.abs((F.col("off_ref") + F.col("run_ref")).cast("double") / n_ref.cast("double")
                 - (F.col("off_cur") + F.col("run_cur")).cast("double") / n_cur.cast("double"))
    stat = cdf.groupBy("feature").agg(F.max(diff).alias("d"), F.first(n_ref).alias("n_ref"),
                                      F.first(n_cur).alias("n_cur"))
    p = ks_pvalue(F.col("d"), F.col("n_ref"), F.col("n_cur"))
    return stat.select("feature", F.col("n_ref").cast("long"), F.col("n_cur").cast("long"),
                       rnd("d", 4).alias("ks_statistic"), rnd(p, 4).alias("p_value"),
                       (p < F.lit(0.05)).alias("drift_detected"))


def drift_summary(ks: DataFrame) -> DataFrame:
    """Number and sorted list of drifted features."""
    return ks.agg(F.sum(F.col("drift_detected").cast("long")).alias("n_features_drifted"),
                  F.array_join(F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))), ",")
                  .alias("drifted_features"))


def js_text_drift(ref: DataFrame, cur: DataFrame, text: str, vocab_size: int = 1000,
                  threshold: float = 0.1) -> DataFrame:
    """Jensen-Shannon distance (natural log) between token distributions.

    Tokens are ``lower(text)`` split on whitespace; the vocabulary is the
    ``vocab_size`` most frequent tokens of both corpora (ties by token); each
    side's distribution over it gets +1e-10 and is renormalised.
    """
    from cribble.functions.text import whitespace_words  # local: avoid import cycle

    def side_counts(df, tag):
        return (df.select(F.explode_outer(whitespace_words(F.lower(F.col(text)))).alias("term"))
                .where(F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias(tag)))

    both = side_counts(ref, "n_ref").join(side_counts(cur, "n_cur"), "term", "full").na.fill(0, ["n_ref", "n_cur"])
    vocab = both.orderBy(F.desc(F.col("n_ref") + F.col("n_cur")), F.asc("term")).limit(vocab_size)
    eps = F.lit(1e-10)
    w = Window.partitionBy()  # over at most vocab_size rows
    tot_r, tot_c = F.sum("n_ref").over(w), F.sum("n_cur").over(w)
    p0 = F.when(tot_r > 0, F.col("n_ref") / tot_r).otherwise(F.col("n_ref").cast("double")) + eps
    q0 = F.when(tot_c > 0, F.col("n_cur") / tot_c).otherwise(F.col("n_cur").cast("double")) + eps
    d = vocab.select(p0.alias("p0"), q0.alias("q0"))
    d = d.select((F.col("p0") / F.sum("p0").over(w)).alias("p"), (F.col("q0") / F.sum("q0").over(w)).alias("q"))
    m = (F.col("p") + F.col("q")) / F.lit(2.0)
    kl = F.col("p") * F.log(F.col("p") / m) + F.col("q") * F.log(F.col("q") / m)
    agg = d.agg(F.sum(kl).alias("js2"), F.count(F.lit(1)).alias("vocab_size"))
    dist = F.sqrt(F.greatest(F.col("js2") / F.lit(2.0), F.lit(0.0)))
    return agg.select(rnd(dist, 4).alias("js_distance"), rnd(dist * dist, 6).alias("js_divergence"),
                      (dist > F.lit(threshold)).alias("drift_detected"), F.col("vocab_size").cast("long"))


def perf_alert(acc: DataFrame, col: str = "accuracy", minimum: float = 0.70) -> DataFrame:
    """Performance alert when accuracy falls below the gate (D3)."""
    return acc.select(F.col(col).alias("current_accuracy"), (F.col(col) < F.lit(minimum)).alias("alert"),
                      F.lit(minimum).alias("threshold"))


def report_document(ks: DataFrame, text: DataFrame, accuracy: DataFrame, minimum: float = 0.70) -> DataFrame:
    """One nested row: numeric_drift (a struct a feature, by name), numeric_drift_summary, text_drift and
    performance_alert (D4).

    ``text`` and ``accuracy`` are the one-row results of ``js_text_drift`` and of a measurement (column accuracy); the rows of ``ks``
    are as many as there are features.
    """
    row = F.struct("feature", "ks_statistic", "p_value", "drift_detected", "n_ref", "n_cur")
    numeric = ks.agg(F.array_sort(F.collect_list(row)).alias("numeric_drift")).withColumn("numeric_drift_summary", F.struct(
        F.size(F.filter("numeric_drift", lambda x: x["drift_detected"])).cast("long").alias("n_features_drifted"),
        F.transform(F.filter("numeric_drift", lambda x: x["drift_detected"]), lambda x: x["feature"]).alias("drifted_features")))
    sections = [numeric, text.select(F.struct(*text.columns).alias("text_drift")),
                perf_alert(accuracy, minimum=minimum).select(F.struct("current_accuracy", "alert", "threshold").alias("performance_alert"))]
    out = sections[0].withColumn("one", F.lit(1))
    for part in sections[1:]:  # one row each
        out = out.join(part.withColumn("one", F.lit(1)), "one")
    return out.drop("one")
