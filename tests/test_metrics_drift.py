"""Metric and drift invariants (SURVEY 5 (c)); drift samples as in FIXTURES F6."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cribble.operators import drift as D
from cribble.operators import metrics as M


def test_identical_labelings(spark):
    df = spark.createDataFrame([(i % 4, i % 4) for i in range(100)], "a int, b int")
    assert M.ari(df, "a", "b").first()[0] == pytest.approx(1.0)
    assert M.nmi(df, "a", "b").first()[0] == pytest.approx(1.0)
    assert M.accuracy(df, "a", "b").first()[0] == 1.0
    assert M.weighted_f1(df, "a", "b").first()[0] == 1.0


def test_ari_matches_formula(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 3, 300), rng.integers(0, 4, 300)
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a int, b int")
    import collections
    c = collections.Counter(zip(a, b))
    comb = lambda n: n * (n - 1) / 2
    idx = sum(comb(v) for v in c.values())
    sa = sum(comb(v) for v in collections.Counter(a).values())
    sb = sum(comb(v) for v in collections.Counter(b).values())
    exp = sa * sb / comb(300)
    ari = (idx - exp) / ((sa + sb) / 2 - exp)
    assert M.ari(df, "a", "b").first()[0] == pytest.approx(ari, abs=1e-6)


def _samples(spark, ref, cur):
    rows = [("ref", float(v)) for v in ref] + [("cur", float(v)) for v in cur]
    return spark.createDataFrame(rows, "side string, x double")


def test_ks_identical_no_drift(spark):
    v = np.arange(200.0)
    r = D.ks_two_sample(_samples(spark, v, v), "side", "ref", ["x"]).first()
    assert r["ks_statistic"] == 0.0 and not r["drift_detected"]


def test_ks_shift_detected_and_buckets_agree(spark):
    rng = np.random.default_rng(3)
    df = _samples(spark, rng.normal(0, 1, 2000), rng.normal(0.5, 1, 2000))
    one = D.ks_two_sample(df, "side", "ref", ["x"]).first()
    many = D.ks_two_sample(df, "side", "ref", ["x"], rows_per_bucket=50).first()
    assert one["drift_detected"] and one["ks_statistic"] == many["ks_statistic"]


def test_ks_small_side_omitted(spark):
    df = _samples(spark, np.arange(50.0), np.arange(5.0))
    assert D.ks_two_sample(df, "side", "ref", ["x"]).count() == 0


def test_js_disjoint_vocabularies(spark):
    ref = spark.createDataFrame([("alpha beta gamma",)] * 5, "text string")
    cur = spark.createDataFrame([("delta epsilon zeta",)] * 5, "text string")
    r = D.js_text_drift(ref, cur, "text").first()
    assert r["js_distance"] == pytest.approx(math.sqrt(math.log(2)), abs=1e-3) and r["drift_detected"]


def test_js_identical(spark):
    ref = spark.createDataFrame([("a b c a",)] * 3, "text string")
    assert D.js_text_drift(ref, ref, "text").first()["js_distance"] == 0.0
