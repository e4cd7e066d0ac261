"""Stream drift against its batch twin and late rows; the two-headed scorer as one saved pipeline; row-level vectors."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cribble.operators import models as ML
from cribble.operators import scoring as SC
from cribble.operators import vectorize as V
from cribble.sources import io
from cribble.streaming import drift as SD
from cribble.streaming import jobs

DAY = datetime(2024, 5, 1)


def events(spark, rows):
    return spark.createDataFrame([(DAY + timedelta(hours=h), float(v)) for h, v in rows], "ts timestamp_ntz, value double")


def test_bins_and_reference(spark):
    df = events(spark, [(0, v) for v in range(100)] + [(0, float("nan"))])
    ref = SD.fit_reference(df, ["value"], 4)
    assert ref.cuts["value"] == [24.75, 49.5, 74.25] and ref.counts["value"] == [25, 25, 25, 25]
    got = [r[0] for r in spark.createDataFrame([(24.75,), (24.8,), (99.0,), (None,), (float("nan"),)], "v double").select(
        SD.bin_of(F.col("v"), ref.cuts["value"])).collect()]
    assert got == [0, 1, 3, None, None]
    flat = SD.fit_reference(events(spark, [(0, 7.0)] * 20), ["value"])
    assert flat.cuts["value"] == [7.0] and flat.counts["value"] == [20, 0]


def test_closed_windows_equal_the_batch_and_late_rows_change_nothing(spark, tmp_path):
    rng = np.random.default_rng(1)
    first = [(h / 4, rng.normal(0 if h < 96 else 3, 1)) for h in range(0, 96 * 2)]
    second = [(48 + h / 4, rng.normal(0, 1)) for h in range(0, 200)]
    late = [(1.0, 99.0)] * 50  # belongs to the first day, comes after its window closed
    ref = SD.fit_reference(events(spark, [(0, v) for v in rng.normal(0, 1, 500)]), ["value"])
    schema = events(spark, [(0, 0)]).schema
    out = io.scratch_path(spark, "t-drift")
    folder = str(tmp_path / "in")
    for i, rows in enumerate((first, second, late + [(120.0, 0.0)])):
        events(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/part{i}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{folder}/*")
    jobs.run_batches(SD.window_counts(stream, "ts", ["value"], ref), jobs.batch_writer(out, lambda b: SD.window_drift(b, ref)), "t-drift")
    got = {r.w.start: r for r in spark.read.parquet(out).collect()}
    batch = SD.window_drift(SD.window_counts(events(spark, first + second), "ts", ["value"], ref), ref)
    want = {r.w.start: r for r in batch.collect()}
    assert set(got) <= set(want) and len(got) >= 3
    for start, r in got.items():
        assert (r.n_cur, r.ks_statistic, r.p_value) == (want[start].n_cur, want[start].ks_statistic, want[start].p_value)
    days = sorted(got)
    assert got[days[0]].n_cur == 96 and not got[days[0]].drift_detected and got[days[1]].drift_detected


def test_statistic_is_the_gap_at_the_cut_points(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(0, 1, 400), rng.normal(0.4, 1.3, 150)
    ref = SD.fit_reference(events(spark, [(0, v) for v in a]), ["value"])
    r = SD.window_drift(SD.window_counts(events(spark, [(1, v) for v in b]), "ts", ["value"], ref), ref).first()
    want = max(abs((a <= c).mean() - (b <= c).mean()) for c in ref.cuts["value"])
    assert abs(r.ks_statistic - want) < 1e-4 and (r.n_ref, r.n_cur) == (400, 150)
    few = SD.window_counts(events(spark, [(1, v) for v in b[:9]]), "ts", ["value"], ref)
    assert SD.window_drift(few, ref).count() == 0


COLS = ["poids", "volume"]


def requests(spark, n=400):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        k = i % 3
        p, v = float(rng.normal(3 * k, 0.5)), float(abs(rng.normal(2, 0.1)) + 1)
        rows.append((i, p, v, ["it's", "b\\s", None][i % 3], ["x", "y", "z"][k], 10.0 * k + p))
    return spark.createDataFrame(rows, "item_id long, poids double, volume double, source string, label string, price double")


def test_heads_learn_and_survive_saving(spark, tmp_path):
    df = requests(spark)
    heads = SC.fit_heads(df, COLS, "label", "price")
    assert heads.sources == ["b\\s", "it's"] and heads.labels == ["x", "y", "z"]
    path = str(tmp_path / "scorer")
    ML.save(SC.pipeline(heads), path)
    loaded = PipelineModel.load(path)
    out = loaded.transform(df.select("item_id", *COLS, "source"))
    assert out.columns == ["item_id", *COLS, "source", *[c for c in out.columns if c in SC.RESPONSE]] and set(SC.RESPONSE) <= set(out.columns)
    rows = out.join(df.select("item_id", "label", "price"), "item_id").collect()
    assert np.mean([r.categorie == r.label for r in rows]) > 0.95
    assert np.mean([abs(r.prix_estime - r.price) for r in rows]) < 1
    for r in rows:
        assert abs(sum(r.probabilites) - 1) < 1e-9 and list(r.probabilites) == sorted(r.probabilites)
        assert r.confiance == r.probabilites[-1] and heads.labels[r.categorie_id] == r.categorie
    # plain arithmetic gives the same
    r = rows[7]
    x = np.array([r.poids, r.volume, {"b\\s": 0, "it's": 1}.get(r.source, 0), r.poids / (r.volume + 1e-6)])
    z = np.array(heads.class_weights) @ x + heads.class_bias
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    assert np.allclose(sorted(p), r.probabilites) and p.argmax() == r.categorie_id
    assert np.isclose(r.prix_estime, np.append(x, r.categorie_id) @ heads.price_weights + heads.price_bias)


def test_unknown_source_scores_as_code_zero_and_one_label(spark):
    df = requests(spark, 60)
    heads = SC.fit_heads(df.where("label = 'x'"), COLS, "label", "price")
    assert {r.categorie for r in SC.pipeline(heads).transform(df).collect()} == {"x"}
    known = SC.fit_heads(df, COLS, "label", "price")
    row = df.limit(1).withColumn("source", F.lit("never seen"))
    zero = df.limit(1).withColumn("source", F.lit(known.sources[0]))
    assert SC.pipeline(known).transform(row).first().confiance == SC.pipeline(known).transform(zero).first().confiance
    with pytest.raises(ValueError):
        SC.fit_heads(df.where("false"), COLS, "label", "price")


def test_requests_are_read_once_to_fit_and_once_to_respond(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(v):
        reads.add(1)
        return v

    df = requests(spark, 90).withColumn("volume", F.expr("if(item_id % 10 = 4, null, volume)"))
    once = df.withColumn("poids", F.udf(counted, "double").asNondeterministic()("poids"))
    heads = SC.fit_heads(once, COLS, "label", "price")
    assert reads.value == 90
    out = SC.respond(once, SC.pipeline(heads), COLS).collect()
    assert reads.value == 180
    want = {r.item_id: tuple(r[c] for c in SC.RESPONSE)
            for r in SC.pipeline(heads).transform(df.where("volume is not null")).collect()}
    assert len(out) == 90 and {r.item_id: tuple(r[c] for c in SC.RESPONSE) for r in out if r.valid} == want
    assert all(r.item_id % 10 == 4 and all(r[c] is None for c in SC.RESPONSE) for r in out if not r.valid)


def test_stream_equals_batch(spark, sf):
    from cribble.plans import q_stream as Q
    from cribble.sources import catalog
    lines = catalog.line_aggregates(spark, sf)
    rows = Q.requests(catalog.table(spark, sf, "orders"), lines)
    heads = SC.fit_heads(Q._complete(rows), Q.REQUEST_COLS, "label", "price")
    want = {r.item_id: (r.categorie, round(r.confiance, 9), round(r.prix_estime, 6))
            for r in SC.pipeline(heads).transform(Q._complete(rows)).collect()}
    got = Q.q_stream_two_heads(spark, sf).collect()
    assert len(got) == rows.count()
    assert {r.item_id: (r.categorie, round(r.confiance, 9), round(r.prix_estime, 6)) for r in got if r.valid} == want
    assert all(r.categorie is None for r in got if not r.valid)


def test_counts_inside_rows_equal_the_grouped_ones(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["c", None, "a"]), (5, ["b"])],
                               "doc_id long, t array<string>")
    counted = V.count_in_rows(df, ["doc_id"], "t")
    got = sorted((r.doc_id, r.term, r.n) for r in V.as_counts(counted, ["doc_id"]).collect())
    assert got == sorted((r.doc_id, r.term, r.n) for r in V.term_counts(df, "doc_id", F.col("t")).collect())
    vocab = V.fit_vocab(V.as_counts(counted, ["doc_id"]), 5, min_df=2)
    counts = V.term_counts(df, "doc_id", F.col("t"))
    assert sorted(map(tuple, V.bow_rows(counted, "doc_id", vocab).collect())) == sorted(
        (r.doc_id, r.term, r.idx, r.n) for r in V.bow(counts, vocab).collect())
    a, b = ({(r.doc_id, r.term): r.weight for r in d.collect()} for d in (
        V.tfidf_rows(counted, "doc_id", vocab), V.tfidf(counts, "doc_id", vocab)))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)
    assert V.count_in_rows(df.where("false"), ["doc_id"], "t").count() == 0
