"""The published penalties of the ridge regression are searched over folds."""

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cribble.operators import models as ML
from cribble.plans import q_models as Q


def made(spark, n=120, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3)) * [1, 1, 0.2]
    y = x @ [1.0, -1.0, 0.3] * 0.4 + rng.normal(0, 5, n) + 1000
    split = np.where(np.arange(n) % 6 == 5, "test", "train")
    rows = [(i, *[float(v) for v in x[i]], float(y[i]), str(split[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, split string")
    return x, y, split, VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def brute_ridge(x, y, alpha):
    xm, ym = x.mean(axis=0), y.mean()
    b = np.linalg.solve((x - xm).T @ (x - xm) + alpha * np.eye(x.shape[1]), (x - xm).T @ (y - ym))
    return lambda z: (z - xm) @ b + ym


def test_ridge_penalties_are_searched(spark):
    x, y, split, df = made(spark)
    fold = {r["id"]: r["f"] for r in df.select("id", F.pmod(F.xxhash64("id"), F.lit(5)).alias("f")).collect()}
    at = np.array([fold[i] for i in range(len(y))])
    use = split == "train"
    want = {}
    for alpha in ML.Grids().ridge_alpha:
        r2 = []
        for f in np.unique(at[use]):
            hold, fit = use & (at == f), use & (at != f)
            e = y[hold] - brute_ridge(x[fit], y[fit], alpha)(x[hold])
            r2.append(1 - (e ** 2).sum() / ((y[hold] - y[hold].mean()) ** 2).sum())
        want[alpha] = np.mean(r2)
    folds = df.where("split = 'train'").withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(5)))
    got = ML.ridge_search(folds, ["a", "b", "c"], "y", "fold", ML.Grids().ridge_alpha)
    assert set(got) == set(want) and all(abs(got[a] - want[a]) < 1e-9 for a in want)
    best = max(want, key=want.get)
    assert best != 1.0  # the one penalty that was tried before
    r = Q.best_ridge(df, ["a", "b", "c"], "y", "id").first()
    e = y[~use] - brute_ridge(x[use], y[use], best)(x[~use])
    assert r.alpha == best and abs(r.cv_r2 - want[best]) < 1e-6 and abs(r.rmse - np.sqrt((e ** 2).mean())) < 1e-4


def test_ridge_search_with_a_constant_fold_and_one_fold(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0), (1.0, 1.0, 0), (2.0, 3.0, 1), (4.0, 5.0, 1)], "a double, y double, fold int")
    got = ML.ridge_search(df, ["a"], "y", "fold", [0.1, 1.0])
    assert all(np.isfinite(v) for v in got.values())
    one = ML.ridge_search(df.where("fold = 1"), ["a"], "y", "fold", [0.1])
    assert np.isnan(one[0.1])
