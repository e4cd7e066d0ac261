"""Many k-means runs in common passes: each equals Spark ML's fit from the same start."""

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cribble.operators import cluster
from cribble.operators import models as ML


def made(spark, n=400, width=4):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(0, 1, (n, width)) + rng.integers(0, 3, n)[:, None] * 2, 3)
    df = spark.createDataFrame([([float(v) for v in r],) for r in x], "a array<double>").repartition(3)
    return ML.vector_from_array(df, "a", "features").select("features").persist()


def test_runs_equal_spark_and_share_their_passes(spark):
    df = made(spark)
    runs = [(k, s) for k in (2, 3, 5) for s in (42, 43, 44)]
    starts, want = [], []
    for k, s in runs:
        starts.append(np.array(KMeans(k=k, seed=s, maxIter=0).fit(df).clusterCenters()))
        want.append(KMeans(k=k, seed=s, maxIter=300).fit(df))
    sc, group = spark.sparkContext, "common-passes"
    blocks = cluster.packed_vectors(df.select(vector_to_array("features").alias("x")), "x")
    sc.setJobGroup(group, group)
    got = cluster.lloyd(blocks, starts)
    jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    sc.setLocalProperty("spark.jobGroup.id", None)
    for (centres, cost, turns), m in zip(got, want):
        assert np.allclose(centres, np.array(m.clusterCenters()), atol=1e-9)
        assert abs(cost - m.summary.trainingCost) < 1e-6 and turns == m.summary.numIter
    assert jobs == max(t for _, _, t in got)


def test_sweep_equals_single_fits(spark):
    df = made(spark)
    out = {r.k: r for r in ML.kmeans_sweep(df, "features", 2, 4, 3, 7).collect()}
    from pyspark.ml.evaluation import ClusteringEvaluator
    for k in (2, 3, 4):
        fits = [KMeans(k=k, seed=7 + r, maxIter=300).fit(df) for r in range(3)]
        best = min(fits, key=lambda m: m.summary.trainingCost)
        sil = ClusteringEvaluator(featuresCol="features").evaluate(best.transform(df))
        assert abs(out[k].inertia - best.summary.trainingCost) < 1e-6 and abs(out[k].silhouette - sil) < 1e-9


def test_a_centre_without_rows_stays_and_copies_need_fewer_centres(spark):
    df = spark.createDataFrame([([0.0, 0.0],)] * 5 + [([1.0, 0.0],)] * 5, "a array<double>")
    blocks = cluster.packed_vectors(df, "a")
    (centres, cost, turns), = cluster.lloyd(blocks, [np.array([[0.0, 0.1], [1.0, 0.1], [50.0, 50.0]])])
    assert centres.tolist() == [[0, 0], [1, 0], [50, 50]] and abs(cost) < 1e-12 and turns == 2
    got = cluster.assign_all(df, "a", [centres, centres[:1]], "c").groupBy(F.col("a")[0].alias("x")).agg(F.collect_set("c").alias("c"))
    assert {r.x: [list(v) for v in r.c] for r in got.collect()} == {0.0: [[0, 0]], 1.0: [[1, 0]]}
