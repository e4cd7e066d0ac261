"""Registered metric, leaderboard and dashboard queries (SURVEY 2.4 A11, A15-A22, A25, A28, L1,
M16 given centres, M19, 2.11 H3-H6, W5).

Scored table: ``embeddings`` with a nearest-class-mean classifier (centres =
per-label mean vectors), a deterministic model whose predictions the SQL
twin recomputes independently.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cribble.functions.numeric import rnd, sql_rnd
from cribble.operators import cluster as C
from cribble.operators import metrics as M
from cribble.operators import prep
from cribble.plans.registry import register
from cribble.sources import catalog, publish
from cribble.sources.io import scratch_path


def scored(spark, sf, metric="l2"):
    e = catalog.table(spark, sf, "embeddings")
    centres = C.class_means(e, "embedding", "label")
    return C.assign(e, "embedding", centres, "cluster", "dist2" if metric == "l2" else "dist", metric)


def _sql_scored(metric: str = "l2", p: str = "") -> str:
    """CTE chain ending in ``{p}scored(vec_id, label, cluster, dist)``."""
    op = "(e.v[i] - c.cv[i]) * (e.v[i] - c.cv[i])" if metric == "l2" else "abs(e.v[i] - c.cv[i])"
    return f"""
{p}e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
{p}cm AS (SELECT label AS k, pos, avg(x) AS m
       FROM (SELECT label, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS pos FROM {p}e) GROUP BY label, pos),
{p}c AS (SELECT k, list(m ORDER BY pos) AS cv FROM {p}cm GROUP BY k),
{p}dd AS (SELECT e.vec_id, e.label, c.k,
              list_reduce(list_transform(range(1, len(e.v) + 1), lambda i: {op}), lambda a, b: a + b) AS d
       FROM {p}e e, {p}c c),
{p}scored AS (SELECT vec_id, label, k AS cluster, d AS dist
           FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, k) AS rk FROM {p}dd) WHERE rk = 1)"""


SCORED = _sql_scored("l2")


@register("kmeans_assign", ops=("M16", "A24"), sql=f"""
WITH {SCORED}
SELECT vec_id, label, cluster, {sql_rnd('dist', 6)} AS dist2 FROM scored""")
def q_kmeans_assign(spark, sf):
    return scored(spark, sf).select("vec_id", "label", "cluster", rnd("dist2", 6).alias("dist2"))


@register("inertia", ops=("A22",), sql=f"WITH {SCORED}\nSELECT {sql_rnd('sum(dist)', 4)} AS inertia FROM scored")
def q_inertia(spark, sf):
    return C.inertia(scored(spark, sf)).select(rnd("inertia", 4).alias("inertia"))


@register("accuracy", ops=("A15",), sql=f"""
WITH {SCORED}
SELECT {sql_rnd('avg(CASE WHEN label = cluster THEN 1.0 ELSE 0.0 END)::DOUBLE', 6)} AS accuracy FROM scored""")
def q_accuracy(spark, sf):
    return M.accuracy(scored(spark, sf), "label", "cluster")


def _per_class_sql(src: str, label: str, pred: str, p: str = "") -> str:
    """CTE chain ending in ``{p}pc(cls, tp, n_pred, support, precision, recall, f1)``."""
    return f"""
{p}ct AS (SELECT CAST({label} AS VARCHAR) AS lab, CAST({pred} AS VARCHAR) AS prd, count(*) AS n FROM {src} GROUP BY 1, 2),
{p}bl AS (SELECT lab AS cls, sum(n) AS support, sum(CASE WHEN lab = prd THEN n ELSE 0 END) AS tp FROM {p}ct GROUP BY lab),
{p}bp AS (SELECT prd AS cls, sum(n) AS n_pred FROM {p}ct GROUP BY prd),
{p}pc0 AS (SELECT coalesce(bl.cls, bp.cls) AS cls, coalesce(tp, 0)::DOUBLE AS tp, coalesce(n_pred, 0)::DOUBLE AS n_pred,
               coalesce(support, 0)::DOUBLE AS support FROM {p}bl bl FULL JOIN {p}bp bp ON bl.cls = bp.cls),
{p}pc1 AS (SELECT *, coalesce(tp / nullif(n_pred, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall
        FROM {p}pc0),
{p}pc AS (SELECT *, coalesce(2.0 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1 FROM {p}pc1)"""


@register("weighted_f1", ops=("A16",), sql=f"""
WITH {SCORED}, {_per_class_sql('scored', 'label', 'cluster')}
SELECT {sql_rnd('sum(f1 * support) / sum(support)', 6)} AS f1_weighted FROM pc""")
def q_weighted_f1(spark, sf):
    return M.weighted_f1(scored(spark, sf), "label", "cluster")


@register("class_report", ops=("A17",), sql=f"""
WITH {SCORED}, {_per_class_sql('scored', 'label', 'cluster')}
SELECT cls AS row, {sql_rnd('precision', 6)} AS precision, {sql_rnd('recall', 6)} AS recall, {sql_rnd('f1', 6)} AS f1,
       support::BIGINT AS support FROM pc WHERE support > 0
UNION ALL
SELECT 'macro avg', {sql_rnd('avg(precision)', 6)}, {sql_rnd('avg(recall)', 6)}, {sql_rnd('avg(f1)', 6)},
       sum(support)::BIGINT FROM pc WHERE support > 0
UNION ALL
SELECT 'weighted avg', {sql_rnd('sum(precision * support) / sum(support)', 6)},
       {sql_rnd('sum(recall * support) / sum(support)', 6)}, {sql_rnd('sum(f1 * support) / sum(support)', 6)},
       sum(support)::BIGINT FROM pc WHERE support > 0""")
def q_class_report(spark, sf):
    return M.class_report(scored(spark, sf), "label", "cluster")


def _margins_sql(src: str, a: str, b: str) -> str:
    return f"""
ct AS (SELECT CAST({a} AS VARCHAR) AS lab, CAST({b} AS VARCHAR) AS prd, count(*)::DOUBLE AS n FROM {src} GROUP BY 1, 2),
mg AS (SELECT 'c' AS tag, n AS v FROM ct
       UNION ALL SELECT 'a', sum(n) FROM ct GROUP BY lab
       UNION ALL SELECT 'b', sum(n) FROM ct GROUP BY prd)"""


@register("ari", ops=("A19",), sql=f"""
WITH {SCORED}, {_margins_sql('scored', 'label', 'cluster')},
t AS (SELECT sum(CASE WHEN tag = 'c' THEN v * (v - 1.0) / 2.0 END) AS idx,
             sum(CASE WHEN tag = 'a' THEN v * (v - 1.0) / 2.0 END) AS sa,
             sum(CASE WHEN tag = 'b' THEN v * (v - 1.0) / 2.0 END) AS sb,
             sum(CASE WHEN tag = 'c' THEN v END) AS n FROM mg)
SELECT {sql_rnd('coalesce((idx - sa * sb / (n * (n - 1.0) / 2.0)) / nullif((sa + sb) / 2.0 - sa * sb / (n * (n - 1.0) / 2.0), 0), 1.0)', 6)} AS ari
FROM t""")
def q_ari(spark, sf):
    return M.ari(scored(spark, sf), "label", "cluster")


@register("nmi", ops=("A20",), sql=f"""
WITH {SCORED}, {_margins_sql('scored', 'label', 'cluster')},
t AS (SELECT sum(CASE WHEN tag = 'c' THEN v * ln(v) END) AS sc, sum(CASE WHEN tag = 'a' THEN v * ln(v) END) AS sa,
             sum(CASE WHEN tag = 'b' THEN v * ln(v) END) AS sb, sum(CASE WHEN tag = 'c' THEN v END) AS n FROM mg),
u AS (SELECT ln(n) + (sc - sa - sb) / n AS mi, ln(n) - sa / n AS ha, ln(n) - sb / n AS hb FROM t)
SELECT {sql_rnd('greatest(coalesce(mi / nullif((ha + hb) / 2.0, 0), 1.0), 0.0)', 6)} AS nmi FROM u""")
def q_nmi(spark, sf):
    return M.nmi(scored(spark, sf), "label", "cluster")


@register("confusion", ops=("A16", "A17"), sql=f"""
WITH {SCORED}
SELECT CAST(label AS VARCHAR) AS label, CAST(cluster AS VARCHAR) AS pred, count(*) AS n FROM scored GROUP BY 1, 2""")
def q_confusion(spark, sf):
    return M.contingency(scored(spark, sf), "label", "cluster")


@register("regression_metrics", ops=("A18",), sql="""
WITH j AS (SELECT l.l_extendedprice AS y, l.l_quantity * p.p_retailprice AS yhat
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
a AS (SELECT sum((y - yhat) * (y - yhat)) AS sse, avg(abs(y - yhat)) AS mae, avg((y - yhat) * (y - yhat)) AS mse,
             var_pop(y) AS var, count(*) AS n FROM j)
SELECT """ + sql_rnd("1.0 - sse / nullif(var * n, 0)", 6) + " AS r2, " + sql_rnd("mae", 6) + " AS mae, "
    + sql_rnd("sqrt(mse)", 6) + " AS rmse FROM a")
def q_regression_metrics(spark, sf):
    li = catalog.table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    part = catalog.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * F.col("p_retailprice")).alias("yhat"))
    return M.regression_metrics(j, "y", "yhat")


# ---------------------------------------------------------------- leaderboard

def _leaderboard(spark, sf):
    """Three deterministic models scored on the same rows: nearest mean (L2),
    nearest mean (L1) and the majority-class baseline."""
    l2 = scored(spark, sf, "l2").select("label", F.col("cluster").alias("pred"))
    l1 = scored(spark, sf, "l1").select("label", F.col("cluster").alias("pred"))
    e = catalog.table(spark, sf, "embeddings")
    major = prep.fit_mode(e, "label")
    base = e.select("label", F.lit(major).alias("pred"))
    out = None
    for name, df in (("nearest_mean_l2", l2), ("nearest_mean_l1", l1), ("majority", base)):
        row = M.summary(df, "label", "pred").select(F.lit(name).alias("model"), "accuracy", "f1_weighted")
        out = row if out is None else out.unionByName(row)
    return out


def _leaderboard_sql() -> str:
    ctes = [_sql_scored("l2", "a_"), _sql_scored("l1", "b_"), """
mj AS (SELECT label AS m FROM embeddings GROUP BY label ORDER BY count(*) DESC, label LIMIT 1),
base AS (SELECT label, (SELECT m FROM mj) AS cluster FROM embeddings)"""]
    parts = []
    for name, src, p in (("nearest_mean_l2", "a_scored", "m1_"), ("nearest_mean_l1", "b_scored", "m2_"),
                         ("majority", "base", "m3_")):
        ctes.append(_per_class_sql(src, "label", "cluster", p))
        parts.append(
            f"SELECT '{name}' AS model, {sql_rnd('sum(tp) / sum(support)', 6)} AS accuracy, "
            f"{sql_rnd('sum(f1 * support) / sum(support)', 6)} AS f1_weighted FROM {p}pc")
    return "WITH " + ",".join(ctes) + ",\nlb AS (" + "\nUNION ALL ".join(parts) + ")\n"


@register("leaderboard", ops=("L1", "M19"), sql=_leaderboard_sql() + "SELECT * FROM lb")
def q_leaderboard(spark, sf):
    return _leaderboard(spark, sf).orderBy(F.desc("f1_weighted"), F.asc("model"))


@register("best_model", ops=("A25", "A28"), sql=_leaderboard_sql() + f"""
SELECT model, accuracy, f1_weighted,
       {sql_rnd("f1_weighted - (SELECT f1_weighted FROM lb WHERE model = 'majority')", 4)} AS gain_vs_baseline
FROM lb ORDER BY f1_weighted DESC, model LIMIT 1""")
def q_best_model(spark, sf):
    lb = _leaderboard(spark, sf)
    # the leaderboard has one row per model: an unpartitioned window over it is bounded
    base = F.max(F.when(F.col("model") == "majority", F.col("f1_weighted"))).over(Window.partitionBy())
    lb = lb.withColumn("gain_vs_baseline", rnd(F.col("f1_weighted") - base, 4))
    return M.best_by(lb, "f1_weighted", "model")


@register("metrics_long", ops=("H3",), sql=_leaderboard_sql() + """
SELECT model, 'accuracy' AS metric, accuracy AS value FROM lb
UNION ALL SELECT model, 'f1_weighted', f1_weighted FROM lb""")
def q_metrics_long(spark, sf):
    return _leaderboard(spark, sf).unpivot("model", ["accuracy", "f1_weighted"], "metric", "value")


@register("perf_alert", ops=("D3", "M18"), sql=f"""
WITH {SCORED}, a AS (SELECT {sql_rnd('avg(CASE WHEN label = cluster THEN 1.0 ELSE 0.0 END)::DOUBLE', 6)} AS acc FROM scored)
SELECT acc AS current_accuracy, acc < 0.70 AS alert, 0.70::DOUBLE AS threshold FROM a""")
def q_perf_alert(spark, sf):
    from cribble.operators.drift import perf_alert
    return perf_alert(M.accuracy(scored(spark, sf), "label", "cluster"))


@register("gated_accuracy", ops=("M18", "S5", "A15"), sql=f"""
WITH {SCORED}
SELECT count(*) AS n_rows, {sql_rnd('avg(CASE WHEN label = cluster THEN 1.0 ELSE 0.0 END)::DOUBLE', 6)} AS accuracy FROM scored""")
def q_gated_accuracy(spark, sf):
    """Predictions published behind an accuracy gate (0.10, the chance of ten classes): the accuracy is measured
    while they are written, and a gate that is not met publishes nothing."""
    rows = scored(spark, sf)
    hit = F.avg(F.when(F.col("label") == F.col("cluster"), 1.0).otherwise(0.0))
    path = scratch_path(spark, "published")
    got = publish.write_gated(rows, path, {"n_rows": F.count(F.lit(1)), "accuracy": hit}, lambda m: (m["accuracy"] or 0) >= 0.10)
    n = spark.read.parquet(path).count()
    return spark.createDataFrame([(n, got["accuracy"])], "n_rows long, accuracy double").select(
        "n_rows", rnd("accuracy", 6).alias("accuracy"))


# ---------------------------------------------------------------- pivot, dashboard rows

@register("pivot_mean", ops=("A11",), sql="""
SELECT o_orderpriority,
       """ + ", ".join(sql_rnd(f"avg(CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END)", 4) + f" AS \"{s}\""
                       for s in ("F", "O", "P")) + """
FROM orders GROUP BY o_orderpriority""")
def q_pivot_mean(spark, sf):
    o = catalog.table(spark, sf, "orders")
    values = sorted(r[0] for r in o.select("o_orderstatus").distinct().collect())
    p = o.groupBy("o_orderpriority").pivot("o_orderstatus", values).agg(F.avg("o_totalprice"))
    return p.select("o_orderpriority", *[rnd(F.col(v), 4).alias(v) for v in values])


@register("scatter_rows", ops=("H4", "S8"), sql=f"""
WITH {SCORED}
SELECT vec_id, CAST(label AS VARCHAR) || ' · Cluster ' || CAST(cluster AS VARCHAR) AS legend FROM scored""")
def q_scatter_rows(spark, sf):
    s = scored(spark, sf)
    return s.select("vec_id", F.concat(F.col("label").cast("string"), F.lit(" · Cluster "),
                                       F.col("cluster").cast("string")).alias("legend"))


@register("history_stats", ops=("H5", "A10", "A3"), sql="""
SELECT count(*) AS n_total,
       (SELECT event_type FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1) AS top_category,
       count(DISTINCT event_type) AS n_categories FROM events""")
def q_history_stats(spark, sf):
    ev = catalog.table(spark, sf, "events")
    top = prep.fit_mode(ev, "event_type")
    return ev.agg(F.count(F.lit(1)).alias("n_total"), F.lit(top).alias("top_category"),
                  F.count_distinct("event_type").cast("long").alias("n_categories"))


@register("recent_history", ops=("W5", "L2"), sql="""
SELECT event_id, event_type, value, CAST((SELECT count(*) FROM events) - rk + 1 AS BIGINT) AS number
FROM (SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) AS rk FROM events) WHERE rk <= 50""")
def q_recent_history(spark, sf):
    ev = catalog.table(spark, sf, "events")
    n = ev.count()
    top = ev.orderBy(F.desc("ts"), F.desc("event_id")).limit(50)
    w = Window.orderBy(F.desc("ts"), F.desc("event_id"))  # over the 50 kept rows only
    return top.select("event_id", "event_type", "value",
                      (F.lit(n) - F.row_number().over(w) + 1).cast("long").alias("number"))


@register("history_delete", ops=("H6",), sql="""
SELECT event_id, event_type, value FROM events
WHERE event_id <> (SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1)""")
def q_history_delete(spark, sf):
    """Drop the newest entry of the history."""
    ev = catalog.table(spark, sf, "events")
    newest = ev.orderBy(F.desc("ts"), F.desc("event_id")).limit(1).collect()[0]["event_id"]
    return ev.where(F.col("event_id") != F.lit(newest)).select("event_id", "event_type", "value")
