"""Registered streaming and source/sink queries.

Streams read the driver's parquet files with ``availableNow`` triggers; each
result is read back from the sink, so the returned frame is what a
downstream reader would see.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cribble.functions.numeric import rnd, sql_rnd
from cribble.operators import cluster as C
from cribble.operators import models as ML
from cribble.operators import scoring as SC
from cribble.operators import validate as VAL
from cribble.plans.prepare import prepare
from cribble.plans.registry import register
from cribble.plans.sqlgen import prepared_ctes, with_items
from cribble.sources import catalog, io
from cribble.streaming import drift as SD
from cribble.streaming import jobs


@register("stream_window_counts", ops=("R2",))
def q_stream_window_counts(spark, sf):
    """Streaming twin of ``windowed_event_counts``: watermark + tumbling windows, update mode;
    the latest emitted value per window is the result."""
    ev = jobs.file_stream(spark, sf, "events.parquet", catalog.SCHEMAS["events"])
    agg = jobs.windowed_counts(ev, "ts")
    out = io.scratch_path(spark, "stream-window")
    ckpt = io.scratch_path(spark, "stream-window-ckpt")
    q = (agg.writeStream.outputMode("update").option("checkpointLocation", ckpt)
         .foreachBatch(jobs.batch_writer(out, lambda b: b)).trigger(availableNow=True).start())
    q.awaitTermination()
    res = spark.read.parquet(out)
    latest = Window.partitionBy("w", "event_type").orderBy(F.desc("batch"))  # rows of one window only
    res = res.withColumn("_rk", F.row_number().over(latest)).where(F.col("_rk") == 1)
    return res.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n",
                      rnd("total_value", 4).alias("total_value"))


@register("stream_score", ops=("R1", "M13"))
def q_stream_score(spark, sf):
    """Vectors arrive as a stream; malformed ones are quarantined, the rest get the
    nearest class centre fitted on the static table."""
    static = catalog.table(spark, sf, "embeddings")
    centres = C.class_means(static, "embedding", "label")
    stream = jobs.file_stream(spark, sf, "embeddings.parquet", catalog.SCHEMAS["embeddings"])
    dim = len(next(iter(centres.values())))
    out = io.scratch_path(spark, "stream-score")

    def score(batch):
        ok = (F.size("embedding") == dim) & ~F.exists("embedding", lambda x: x.isNull())
        tagged = batch.withColumn("valid", F.coalesce(ok, F.lit(False)))
        scored = C.assign(tagged.where("valid"), "embedding", centres, "cluster", None)
        bad = tagged.where(~F.col("valid")).withColumn("cluster", F.lit(None).cast("int"))
        return scored.unionByName(bad).select("vec_id", "label", "cluster", "valid")

    jobs.run_batches(stream, jobs.batch_writer(out, score), "stream-score")
    return spark.read.parquet(out).drop("batch")


@register("stream_validate", ops=("R1", "P10"))
def q_stream_validate(spark, sf):
    """Order requests stream in, are joined to static line aggregates (stream-static join),
    validated and split into valid / quarantine sinks."""
    orders = jobs.file_stream(spark, sf, "orders.parquet", catalog.SCHEMAS["orders"])
    req = catalog.item_rows(orders, catalog.line_aggregates(spark, sf)).select(
        "item_id", F.col("w").alias("poids"), F.col("v").alias("volume"), F.col("c").alias("conductivite"),
        F.col("o").alias("opacite"), F.col("r").alias("rigidite"), F.col("src").alias("source"),
        F.col("cat").alias("rapport_collecte"))
    out = io.scratch_path(spark, "stream-validate")
    jobs.run_batches(req, jobs.batch_writer(out, lambda b: VAL.validate(b).select(
        "item_id", "source", "reasons", "valid")), "stream-validate")
    return spark.read.parquet(out).drop("batch")


# ---------------------------------------------------------------- drift per window

STREAM_FEATS = ["value", "user_id"]
_EVEN = "event_id % 2 = 0"  # the reference half of the events


def _stream_drift_sql(closed_only: bool) -> str:
    probs = [i / 10 for i in range(1, 10)]
    en = "(n_ref::DOUBLE * n_cur::DOUBLE / (n_ref + n_cur)::DOUBLE)"
    lam = f"((sqrt({en}) + 0.12 + 0.11 / sqrt({en})) * d)"
    series = (f"list_reduce(list_transform(range(1, 101), lambda k: 2.0 * (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) "
              f"* exp(-2.0 * (k * k)::DOUBLE * {lam} * {lam})), lambda a, b: a + b)")
    p = f"(CASE WHEN {lam} < 0.05 THEN 1.0 ELSE least(greatest({series}, 0.0), 1.0) END)"
    long = " UNION ALL ".join(f"SELECT event_id, ts, '{f}' AS feature, CAST({f} AS DOUBLE) AS v FROM events" for f in STREAM_FEATS)
    cuts = " UNION ALL ".join(f"SELECT feature, quantile_cont(v, {q}) AS c FROM r GROUP BY feature" for q in probs)
    closed = "AND w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)" if closed_only else ""
    return f"""
WITH l AS (SELECT * FROM ({long}) WHERE v IS NOT NULL AND NOT isnan(v)),
r AS (SELECT * FROM l WHERE {_EVEN}), s AS (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS w FROM l WHERE NOT ({_EVEN})),
c AS (SELECT DISTINCT * FROM ({cuts})),
rc AS (SELECT c.feature, c.c, count(*) FILTER (WHERE r.v <= c.c) / count(*) AS share FROM c JOIN r USING (feature) GROUP BY 1, 2),
sc AS (SELECT s.w, c.feature, c.c, count(*) FILTER (WHERE s.v <= c.c) / count(*) AS share, count(*) AS n_cur
       FROM c JOIN s USING (feature) GROUP BY 1, 2, 3),
d AS (SELECT w, feature, max(abs(rc.share - sc.share)) AS d, max(n_cur) AS n_cur FROM sc JOIN rc USING (feature, c) GROUP BY 1, 2),
n AS (SELECT d.*, (SELECT count(*) FROM r WHERE r.feature = d.feature) AS n_ref FROM d)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, feature, n_ref, n_cur, {sql_rnd('d', 4)} AS ks_statistic,
       {sql_rnd(p, 4)} AS p_value, {p} < 0.05 AS drift_detected
FROM n WHERE n_ref >= 10 AND n_cur >= 10 {closed}"""


def _drift_rows(df):
    return df.withColumn("window_start", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss")).drop("w", "batch")


@register("windowed_drift", ops=("D1", "R2"), sql=_stream_drift_sql(False))
def q_windowed_drift(spark, sf):
    """Batch twin of ``stream_drift``: every window, open or closed."""
    ev = catalog.table(spark, sf, "events")
    ref = SD.fit_reference(ev.where(_EVEN), STREAM_FEATS)
    return _drift_rows(SD.window_drift(SD.window_counts(ev.where(f"NOT ({_EVEN})"), "ts", STREAM_FEATS, ref), ref))


@register("stream_drift", ops=("R2", "D1"), sql=_stream_drift_sql(True))
def q_stream_drift(spark, sf):
    """Events stream in; counts per window, feature and bin are state, each window that the watermark closes
    is compared with the reference once."""
    ref = SD.fit_reference(catalog.table(spark, sf, "events").where(_EVEN), STREAM_FEATS)
    stream = jobs.file_stream(spark, sf, "events.parquet", catalog.SCHEMAS["events"]).where(f"NOT ({_EVEN})")
    out = io.scratch_path(spark, "stream-drift")
    jobs.run_batches(SD.window_counts(stream, "ts", STREAM_FEATS, ref),
                     jobs.batch_writer(out, lambda b: SD.window_drift(b, ref)), "stream-drift")
    return _drift_rows(spark.read.parquet(out))


# ---------------------------------------------------------------- two-headed scoring

REQUEST_COLS = ["poids", "volume", "conductivite", "opacite", "rigidite"]
# -- fixed values: weights of the scorer that SQL repeats (classes x features, then the price).
FIXED_HEADS = SC.Heads(
    REQUEST_COLS, ["F", "O", "P"], ["1-URGENT", "2-HIGH", "3-MEDIUM"],
    [[0.01, -0.00001, 2.0, 1.0, 0.3, 0.2, 50.0], [-0.01, 0.00001, -3.0, 2.0, 0.1, -0.4, 10.0],
     [0.005, 0.000002, 1.0, -4.0, -0.2, 0.1, -20.0]],
    [0.1, 0.4, -0.2], [12.0, 0.9, -300.0, 250.0, 40.0, 5.0, 1000.0, -77.0], 150.0)


def requests(orders, lines):
    """Scoring requests from orders (batch or stream): the five measurements and the source."""
    it = catalog.item_rows(orders, lines)
    return it.select("item_id", F.col("w").alias("poids"), F.col("v").alias("volume"), F.col("c").alias("conductivite"),
                     F.col("o").alias("opacite"), F.col("r").alias("rigidite"), F.col("src").alias("source"),
                     F.col("cat").alias("label"), F.col("price").alias("price"))


def _complete(df):
    return df.where(" AND ".join(f"{c} IS NOT NULL" for c in REQUEST_COLS))


def _heads_sql() -> str:
    h = FIXED_HEADS
    scores = ", ".join(SC.linear_sql(w, b, h.features) for w, b in zip(h.class_weights, h.class_bias))
    codes = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(h.sources))
    return with_items(f"""
q AS (SELECT item_id, w AS poids, v AS volume, c AS conductivite, o AS opacite, r AS rigidite,
             CASE src {codes} ELSE 0 END AS src_code, w / (v + 1e-6) AS density
      FROM items WHERE w IS NOT NULL AND v IS NOT NULL AND c IS NOT NULL AND o IS NOT NULL AND r IS NOT NULL),
z AS (SELECT *, [{scores}] AS z FROM q),
e AS (SELECT *, list_transform(z, lambda x: exp(x - list_max(z))) AS e, list_position(z, list_max(z)) - 1 AS k FROM z),
p AS (SELECT *, list_sort(list_transform(e, lambda x: x / list_sum(e))) AS p FROM e)
SELECT item_id, {[*h.labels]}[k + 1] AS categorie, CAST(k AS INTEGER) AS categorie_id, {sql_rnd('list_max(p)', 6)} AS confiance,
       {sql_rnd('p[1]', 6)} AS least_p, {sql_rnd(SC.linear_sql(h.price_weights, h.price_bias, [*h.features, 'k']), 4)} AS prix_estime,
       'numeric' AS pipeline
FROM p""")


@register("score_numeric", ops=("M13", "A24", "L5", "P8"), sql=_heads_sql())
def q_score_numeric(spark, sf):
    """Requests scored by a saved and reloaded pipeline with fixed weights: class, confidence, ascending
    probabilities and price."""
    path = io.scratch_path(spark, "scorer")
    ML.save(SC.pipeline(FIXED_HEADS), path)
    rows = _complete(requests(catalog.table(spark, sf, "orders"), catalog.line_aggregates(spark, sf)))
    out = ML.load(path).transform(rows)
    return out.select("item_id", "categorie", "categorie_id", rnd("confiance", 6).alias("confiance"),
                      rnd(F.col("probabilites")[0], 6).alias("least_p"), rnd("prix_estime", 4).alias("prix_estime"), "pipeline")


@register("stream_two_heads", ops=("R1", "M13", "S9"))
def q_stream_two_heads(spark, sf):
    """Both heads are fitted on the labelled items and saved once; requests stream in and are scored by the
    pipeline that ``foreachBatch`` loaded, incomplete ones are quarantined."""
    lines = catalog.line_aggregates(spark, sf)
    heads = SC.fit_heads(_complete(requests(catalog.table(spark, sf, "orders"), lines)), REQUEST_COLS, "label", "price")
    path, out = io.scratch_path(spark, "scorer"), io.scratch_path(spark, "stream-two-heads")
    ML.save(SC.pipeline(heads), path)
    loaded: list = []

    def score(batch):
        if not loaded:
            loaded.append(ML.load(path))
        return SC.respond(batch, loaded[0], REQUEST_COLS)

    orders = jobs.file_stream(spark, sf, "orders.parquet", catalog.SCHEMAS["orders"])
    jobs.run_batches(requests(orders, lines), jobs.batch_writer(out, score), "stream-two-heads")
    return spark.read.parquet(out).drop("batch")


@register("stream_dedupe_log", ops=("R3", "W5"))
def q_stream_dedupe_log(spark, sf):
    ev = jobs.file_stream(spark, sf, "events.parquet", catalog.SCHEMAS["events"])
    log = jobs.dedupe_log(ev, "event_id", "ts")
    out = io.scratch_path(spark, "stream-log")
    jobs.run_batches(log, jobs.batch_writer(out, lambda b: b.select("event_id", "ts", "event_type", "value")),
                     "stream-log")
    return spark.read.parquet(out).drop("batch")


# ---------------------------------------------------------------- sources and sinks

@register("csv_roundtrip", ops=("S1", "S13", "T1", "T2"), sql=with_items(
    "s AS (SELECT 1)\nSELECT item_id, w, v, price, cat, src FROM items"))
def q_csv_roundtrip(spark, sf):
    """Items written as CSV (header, quoted cells) and read back with the lenient typed scan."""
    from pyspark.sql import types as T
    items = catalog.items(spark, sf).select("item_id", "w", "v", "price", "cat", "src")
    path = io.scratch_path(spark, "items-csv")
    io.write_table(items, path, "csv")
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("w", T.DoubleType()),
                           T.StructField("v", T.DoubleType()), T.StructField("price", T.DoubleType()),
                           T.StructField("cat", T.StringType()), T.StructField("src", T.StringType())])
    return io.read_csv_table(spark, path, schema)


@register("splits_roundtrip", ops=("S4", "S2"), sql=with_items(prepared_ctes() + """
SELECT split, count(*) AS n_rows, count(cat_enc) AS n_labelled FROM prepared GROUP BY split"""))
def q_splits_roundtrip(spark, sf):
    """Prepared items written partitioned by split; each split is read back by partition pruning."""
    prepared, _ = prepare(catalog.items(spark, sf))
    path = io.scratch_path(spark, "splits")
    io.write_splits(prepared, path)
    parts = []
    for s in ("train", "val", "test"):
        d = spark.read.parquet(path).where(F.col("split") == s)
        parts.append(d.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                           F.count("cat_enc").alias("n_labelled")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("experiment_log", ops=("S3", "S5", "S6"))
def q_experiment_log(spark, sf):
    """Leaderboard rows logged as runs, the best registered (version = max + 1),
    metrics written as JSON, and the registry read back (a missing registry reads as None)."""
    from cribble.plans.q_metrics import _leaderboard
    lb = _leaderboard(spark, sf).collect()
    base = io.scratch_path(spark, "mlruns")
    assert io.read_optional(spark, f"{base}/registry") is None
    for r in lb:
        io.log_run(spark, f"{base}/runs", "classification", r["model"], {"model": r["model"]},
                   {"accuracy": r["accuracy"], "f1_weighted": r["f1_weighted"]})
    best = max(lb, key=lambda r: (r["f1_weighted"], [-ord(ch) for ch in r["model"]]))
    for _ in range(2):
        io.register_model(spark, f"{base}/registry", "best_classifier", f"{base}/models/{best['model']}",
                          {"f1_weighted": best["f1_weighted"]})
    io.write_metrics(spark.read.parquet(f"{base}/runs").select("run_name", "metrics"), f"{base}/metrics")
    io.write_table(_leaderboard(spark, sf), f"{base}/results")          # results table (S6)
    io.write_table(_leaderboard(spark, sf), f"{base}/results_csv", "csv")
    reg = spark.read.parquet(f"{base}/registry")
    return reg.select("name", "version", F.element_at(F.split("path", "/"), -1).alias("model"),
                      F.col("metrics")["f1_weighted"].alias("f1_weighted"))
