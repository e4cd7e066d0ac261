"""Fits run to the published maxima, over whole grids, and do not depend on session settings."""

import numpy as np
from pyspark.sql import functions as F

from cribble.operators import drift
from cribble.operators import models as ML
from cribble.plans import q_models as Q


def test_published_maxima_and_grids(spark):
    points = Q.search_points(64)
    assert {k: len(v) for k, v in points.items()} == {"logreg": 6, "rf": 12, "gbt": 8, "svc": 6}
    assert {len({p.params for p in v}) for v in points.values()} == {6, 8, 12}
    assert all(p.spec.rounds == 200 for p in points["gbt"]) and all(p.spec.trees == 200 for p in points["rf"])
    assert all(p.spec.max_iter == 2000 for p in points["svc"]) and sum(p.spec.fourier is not None for p in points["svc"]) == 3
    assert all(p.spec.max_iter == 500 for p in points["logreg"])
    ests = {v: Q.matrix_specs(v) for v in ("bow", "tfidf", "word2vec", "subword")}
    assert sum(map(len, ests.values())) == 14
    assert all(e["logreg"].max_iter == 500 and e["linear_svc"].max_iter == 2000 for e in ests.values())


def test_stacked_scores_are_scores_of_every_class(spark):
    from cribble.operators import joint, linear, trees
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(i % 3, 1, 2)], float(i % 3), i % 4 if i < 80 else None) for i in range(90)]
    d = joint.design(spark.createDataFrame(rows, "doc_id long, f array<double>, y double, fold int"), "doc_id", "f", "y", "fold")
    bases = {"svc": linear.Linear("hinge", 1.0), "rf": trees.Forest(5, 3)}
    got = Q.stacked(d, bases, 4).collect()
    assert len(got) == 90 and {len(r.meta) for r in got} == {6} and len({tuple(r.meta) for r in got}) > 50
    # rows that train are scored by the fit without their fold, the others by the fit on all
    own = [linear.fit_linear(d, [linear.Linear("hinge", 1.0, f)])[0] for f in (0, 1, 2, 3, None)]
    for r in got:
        m = own[4 if r.id >= 80 else r.id % 4]
        assert np.allclose(r.meta[:3], m.scores(np.array([rows[r.id][1]]))[0], atol=1e-6)


def test_subword_vectors_follow_the_context(spark):
    def vectors(texts):
        d = spark.createDataFrame([(i, t.split()) for i, t in enumerate(texts)], "doc_id long, toks array<string>")
        return {r.word: list(r.vector) for r in Q.subword_vectors(d.coalesce(1)).collect()}

    one, two = vectors(["red car", "blue sky"] * 3), vectors(["red sky", "blue car"] * 3)
    assert one.keys() == two.keys() == {"red", "car", "blue", "sky"}
    assert all(len(v) == 100 and any(v) for v in one.values()) and one["red"] != two["red"]


def test_word2vec_partitions_follow_the_tokens(spark):
    df = spark.createDataFrame([(["a"] * 7,), (["b"] * 5,), (None,)], "t array<string>")
    assert ML.token_partitions(df, "t") == 1
    assert ML.token_partitions(df.repartition(6), "t", 4) == ML.token_partitions(df, "t", 4) == 3


def test_ks_buckets_grow_with_the_values(spark, monkeypatch):
    splits = []
    real = drift.Bucketizer
    monkeypatch.setattr(drift, "Bucketizer", lambda **kw: splits.append(len(kw["splits"])) or real(**kw))
    df = spark.range(12_000).select((F.col("id") % 2).alias("side"), (F.sqrt("id") + F.col("id") % 2).alias("x"))
    r = drift.ks_two_sample(df, "side", 0, ["x"], rows_per_bucket=2).first()
    a, b = (np.sort([v.x for v in df.where(F.col("side") == k).collect()]) for k in (0, 1))
    at = np.concatenate((a, b))
    want = np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()
    assert splits[0] > 4098 and abs(r.ks_statistic - want) < 1e-4
