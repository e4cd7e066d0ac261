"""Gated publishing, the nested report, dictionary lookup inside arrays."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cribble.operators import drift as D
from cribble.operators import lookup
from cribble.sources import publish


def test_gate_publishes_nothing_when_it_is_not_met(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.6), (2, None), (3, 0.9)], "id long, acc double")
    measures = {**publish.load_profile(df), "acc": F.avg("acc")}
    bad, good = str(tmp_path / "bad"), str(tmp_path / "deep" / "good")
    with pytest.raises(publish.GateError):
        publish.write_gated(df, bad, measures, lambda m: m["acc"] >= 0.8)
    assert not os.path.exists(bad)
    got = publish.write_gated(df, good, measures, lambda m: m["acc"] >= 0.7)
    assert got == {"n_rows": 3, "null_id": 0, "null_acc": 1, "acc": 0.75} and spark.read.parquet(good).count() == 3
    with pytest.raises(FileExistsError):
        publish.write_gated(df, good, measures)
    assert publish.write_gated(df.where("false"), good, measures, mode="keep") == {} and spark.read.parquet(good).count() == 3


def test_measures_equal_a_second_scan(spark, tmp_path):
    df = spark.range(10_000).select("id", F.when(F.col("id") % 7 > 0, F.col("id")).alias("v")).repartition(9)
    got = publish.write_gated(df, str(tmp_path / "t"), publish.load_profile(df))
    assert got == {"n_rows": 10_000, "null_id": 0, "null_v": df.where("v IS NULL").count()}


def test_assertion_aborts_the_job(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", 0.7)], "m string, acc double")
    assert [r.acc for r in publish.assert_at_least(df, "acc", 0.7).collect()] == [0.9, 0.7]
    for low in (df.unionByName(spark.createDataFrame([("c", 0.69)], df.schema)),
                df.unionByName(spark.createDataFrame([("c", None)], df.schema))):
        with pytest.raises(Exception, match="acc below 0.7"):
            publish.assert_at_least(low, "acc", 0.7).collect()


def test_report_is_one_document_that_reads_back(spark, tmp_path):
    ks = spark.createDataFrame([("b", 5, 6, 0.5, 0.01, True), ("a", 5, 6, 0.1, 0.9, False)],
                               "feature string, n_ref long, n_cur long, ks_statistic double, p_value double, drift_detected boolean")
    text = spark.createDataFrame([(0.2, 0.04, True, 7)], "js_distance double, js_divergence double, drift_detected boolean, vocab_size long")
    doc = D.report_document(ks, text, spark.createDataFrame([(0.65,)], "accuracy double"))
    path = str(tmp_path / publish.content_name("ks", "text"))
    publish.write_gated(doc, path, {"n": F.count("*")}, lambda m: m["n"] == 1)
    assert spark.read.parquet(path).collect() == doc.collect()
    d = json.loads(doc.toJSON().first())
    assert [x["feature"] for x in d["numeric_drift"]] == ["a", "b"]
    assert d["numeric_drift_summary"] == {"n_features_drifted": 1, "drifted_features": ["b"]}
    assert d["text_drift"]["vocab_size"] == 7 and d["performance_alert"] == {"current_accuracy": 0.65, "alert": True, "threshold": 0.7}
    none = D.report_document(ks.where("false"), text, spark.createDataFrame([(0.9,)], "accuracy double")).first()
    assert none.numeric_drift == [] and none.numeric_drift_summary.n_features_drifted == 0 and not none.performance_alert.alert


@pytest.mark.parametrize("most", [500_000, 1])
def test_lookup_in_arrays(spark, most):
    df = spark.createDataFrame([(1, ["cats", "dog", "cats", None]), (2, []), (3, None), (None, ["mice"]), (4, ["cats"] * 3)],
                               "id long, toks array<string>")
    table = spark.createDataFrame([("cats", "cat"), ("cats", "zat"), ("mice", "mouse"), ("dog", None), (None, "x")],
                                  "word string, lemma string")
    got = {r.id: r.lemmas for r in lookup.lookup(df, "id", "toks", table, broadcast_rows=most).collect()}
    assert got == {1: ["cat", "dog", "cat", None], 2: [], 3: None, None: ["mouse"], 4: ["cat"] * 3}
    same = {r.id: r.lemmas for r in lookup.lookup(df, "id", "toks", table.where("false")).collect()}
    assert same == {r.id: r.toks for r in df.collect()}
