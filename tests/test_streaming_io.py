"""Streams equal their batch twins (availableNow); sources and sinks round-trip."""

from pyspark.sql import functions as F

from cribble.plans.registry import load_all


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_stream_window_counts_equal_batch(spark, sf):
    reg = load_all()
    cols = ["window_start", "event_type", "n", "total_value"]
    assert _rows(reg["stream_window_counts"].fn(spark, sf), cols) == \
        _rows(reg["windowed_event_counts"].fn(spark, sf), cols)


def test_stream_validate_equal_batch(spark, sf):
    reg = load_all()
    cols = ["item_id", "source", "reasons", "valid"]
    assert _rows(reg["stream_validate"].fn(spark, sf), cols) == _rows(reg["validate_requests"].fn(spark, sf), cols)


def test_stream_score_equal_batch(spark, sf):
    reg = load_all()
    s = reg["stream_score"].fn(spark, sf)
    b = reg["kmeans_assign"].fn(spark, sf)
    assert s.where(~F.col("valid")).count() == 0
    assert _rows(s, ["vec_id", "cluster"]) == _rows(b, ["vec_id", "cluster"])


def test_stream_of_a_folder_table_reads_its_files(spark, tmp_path):
    """A table that Spark wrote is a folder of files; a stream of it takes them all, one of a file that file."""
    from cribble.sources import catalog
    rows = [(i, [float(i % 3), 1.0], i % 3) for i in range(30)]
    e = spark.createDataFrame(rows, catalog.SCHEMAS["embeddings"])
    e.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = load_all()["stream_score"].fn(spark, str(tmp_path))
    assert _rows(out, ["vec_id", "cluster", "valid"]) == [(i, i % 3, True) for i in range(30)]


def test_stream_score_with_rows_without_a_label(spark, tmp_path):
    """A row without a label makes no centre and is scored, one without a vector is quarantined."""
    from cribble.sources import catalog
    rows = [(i, [float(i % 3), 1.0], i % 3) for i in range(6)] + [(6, [2.0, 1.0], None), (7, None, 1)]
    spark.createDataFrame(rows, catalog.SCHEMAS["embeddings"]).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = load_all()["stream_score"].fn(spark, str(tmp_path))
    assert _rows(out, ["vec_id", "cluster", "valid"]) == [(i, i % 3, True) for i in range(6)] + [(6, 2, True), (7, None, False)]


def test_dedupe_log_keeps_every_event_once(spark, sf):
    reg = load_all()
    out = reg["stream_dedupe_log"].fn(spark, sf)
    assert out.count() == out.select("event_id").distinct().count() == \
        spark.read.parquet(f"{sf}/events.parquet").count()


def test_csv_roundtrip_and_optional_scan(spark, sf):
    from cribble.sources import io
    reg = load_all()
    back = reg["csv_roundtrip"].fn(spark, sf)
    from cribble.sources import catalog
    orig = catalog.items(spark, sf).select("item_id", "w", "v", "price", "cat", "src")
    cols = ["item_id", "w", "v", "price", "cat", "src"]
    assert _rows(back, cols) == _rows(orig, cols)
    assert io.read_optional(spark, io.scratch_path(spark, "missing")) is None
