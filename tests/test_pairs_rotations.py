"""Word pairs counted from tokens; all rotated features scored in one pass."""

from collections import Counter

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cribble.operators import models as ML
from cribble.operators import vectorize as V
from cribble.plans import q_models as Q


def test_pairs_are_counted_inside_their_row(spark, monkeypatch):
    rng = np.random.default_rng(0)
    rows = [(i, [f"w{j}" for j in rng.integers(0, 5, rng.integers(0, 30))]) for i in range(40)] + [(40, []), (41, None), (42, ["w1"])]
    df = spark.createDataFrame(rows, "doc_id long, t array<string>").coalesce(1)
    for most in (250_000, 20):
        monkeypatch.setattr(V._row_slices, "__defaults__", (most,))
        got = {r.doc_id: Counter(dict(zip(r.terms, r.ns))) for r in V.count_in_rows(df, ["doc_id"], "t", pairs=True).collect()}
        want = {i: Counter([*(t or ()), *(" ".join(p) for p in zip(t or (), (t or ())[1:]))]) for i, t in rows}
        assert got == want
    nulls = V.count_in_rows(spark.createDataFrame([(1, ["a", None, "b", "a"])], "doc_id long, t array<string>"), ["doc_id"], "t", True)
    assert dict(V.as_counts(nulls, ["doc_id"]).select("term", "n").collect()) == {"a": 2, "b": 1, "b a": 1}


def test_rotated_features_are_scored_in_one_pass(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (60, 2))
    rows = [(i + 1, float(x[i, 0] > 0), float(x[i, 0]), float(x[i, 1])) for i in range(60)]
    df = spark.createDataFrame(rows, "_pos long, y double, a double, b double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                             ML.rf_classifier(5, 3, featuresCol="features", labelCol="y")]).fit(df)
    got = Q.rotated_accuracies(df, 60, ["a", "b"], model)
    for i, f in enumerate(["a", "b"]):
        moved = df.join(df.select((F.col("_pos") % 60 + 1).alias("_pos"), F.col(f).alias("v")), "_pos").withColumn(f, F.col("v"))
        assert abs(got[i] - ML.evaluate(model.transform(moved), "y")["accuracy"]) < 1e-12
    assert abs(got[-1] - ML.evaluate(model.transform(df), "y")["accuracy"]) < 1e-12 and got[0] < got[-1]
