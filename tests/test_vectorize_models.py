"""TF-IDF invariants (FIXTURES F3) and model invariants on separable blobs."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cribble.functions import text as T
from cribble.operators import models as ML
from cribble.operators import vectorize as V

CORPUS = ["métal conducteur rigide lourd", "plastique souple léger emballage",
          "verre transparent fragile bouteille", "papier carton feuille journal",
          "métal lourd conducteur acier", "plastique emballage souple pvc"]


def _counts(spark, texts, start=0):
    df = spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    d = T.with_clean_text(df, "text", "c").withColumn("vt", T.vector_tokens("c"))
    d = d.withColumn("ng", T.ngrams_1_2(F.col("vt")))
    return df, V.term_counts(d, "doc_id", F.col("ng"))


def test_tfidf_norms_and_bounds(spark):
    df, counts = _counts(spark, CORPUS)
    vocab = V.fit_vocab(counts, df.count(), min_df=2, max_features=10)
    assert len(vocab.terms) <= 10
    w = V.tfidf(counts, "doc_id", vocab)
    assert w.where(F.col("weight") < 0).count() == 0
    norms = w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n")).collect()
    assert all(abs(r["n"] - 1.0) < 1e-9 for r in norms)
    assert w.select("doc_id").distinct().count() <= len(CORPUS)


def test_unseen_words_give_empty_rows(spark):
    df, counts = _counts(spark, CORPUS)
    vocab = V.fit_vocab(counts, df.count(), min_df=1)
    _, unseen = _counts(spark, ["zzz yyy xxx"], start=100)
    assert V.tfidf(unseen, "doc_id", vocab).count() == 0


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(42)
    centres = rng.normal(0, 5, (4, 7))
    rows = []
    for i in range(500):
        k = i % 4
        rows.append((i, [float(x) for x in centres[k] + rng.normal(0, 1, 7)], float(k)))
    df = spark.createDataFrame(rows, "row_id long, f array<double>, y double")
    return ML.vector_from_array(df, "f", "features")


def test_logreg_accuracy_probabilities_labels(spark, blobs, tmp_path):
    train = blobs.where(F.col("row_id") % 5 != 0)
    test = blobs.where(F.col("row_id") % 5 == 0)
    model = Pipeline(stages=[ML.logreg(10.0, train.count(), featuresCol="features", labelCol="y")]).fit(train)
    pred = model.transform(test)
    assert ML.evaluate(pred, "y")["accuracy"] >= 0.70
    assert pred.count() == test.count()
    sums = pred.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert sums.where(F.abs(F.col("s") - 1.0) > 1e-6).count() == 0
    labels = {r[0] for r in train.select("y").distinct().collect()}
    assert {r[0] for r in pred.select("prediction").distinct().collect()} <= labels
    path = str(tmp_path / "model")
    ML.save(model, path)
    again = PipelineModel.load(path).transform(test).select("row_id", "prediction").orderBy("row_id").collect()
    assert again == pred.select("row_id", "prediction").orderBy("row_id").collect()


def test_char_ngrams(spark):
    df = spark.createDataFrame([("abc",)], "w string")
    out = df.select(ML.char_ngrams(F.col("w"))).first()[0]
    assert out[:3] == ["<ab", "abc", "bc>"] and "<abc>" in out


def test_batches_are_cut_by_tokens():
    """Rows of any length, null ones too, come once and in turn; a slice holds few tokens unless one row has more."""
    import pyarrow as pa
    from cribble.operators import vectorize as V
    lists = [["a"] * 3, None, [], ["b"] * 9, ["c"] * 2, ["d"] * 2]
    b = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(lists, pa.list_(pa.string()))], names=["k", "t"])
    got = [s.to_pydict() for s in V._row_slices(iter([b]), 1, 4)]
    assert [s["k"] for s in got] == [[0, 1, 2], [3], [4, 5]]
    assert [t for s in got for t in s["t"]] == lists
