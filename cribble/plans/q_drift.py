"""Registered drift queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cribble.functions import text as T
from cribble.functions.numeric import rnd, sql_rnd
from cribble.operators import drift as D
from cribble.plans.registry import register
from cribble.sources import catalog
from cribble.sources import publish as P
from cribble.sources.io import scratch_path

LI_FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CUTOFF = "1998-01-01"


def _lineitem_sides(spark, sf):
    li = catalog.table(spark, sf, "lineitem")
    side = F.when(F.col("l_shipdate") < F.lit(CUTOFF).cast("timestamp_ntz"), "ref").otherwise("cur")
    return li.select(side.alias("side"), *LI_FEATS)


def _events_sides(spark, sf):
    ev = catalog.table(spark, sf, "events")
    return ev.select(F.when(F.col("event_type") == "click", "cur").otherwise("ref").alias("side"), "value")


def _ks_sql(source: str, feats: list[str], min_n: int = 10) -> str:
    long = "\nUNION ALL ".join(
        f"SELECT is_ref, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM src" for f in feats)
    en = "(n_ref::DOUBLE * n_cur::DOUBLE / (n_ref + n_cur)::DOUBLE)"
    lam = f"((sqrt({en}) + 0.12 + 0.11 / sqrt({en})) * d)"
    series = (f"list_reduce(list_transform(range(1, 101), lambda k: 2.0 * (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) "
              f"* exp(-2.0 * (k * k)::DOUBLE * {lam} * {lam})), lambda a, b: a + b)")
    p = f"(CASE WHEN {lam} < 0.05 THEN 1.0 ELSE least(greatest({series}, 0.0), 1.0) END)"
    return f"""
WITH src AS ({source}),
long AS (SELECT * FROM ({long}) WHERE value IS NOT NULL AND NOT isnan(value)),
dv AS (SELECT feature, value, sum(CASE WHEN is_ref THEN 1 ELSE 0 END)::BIGINT AS n_ref,
              sum(CASE WHEN is_ref THEN 0 ELSE 1 END)::BIGINT AS n_cur FROM long GROUP BY feature, value),
tot AS (SELECT feature, sum(n_ref)::BIGINT AS tr, sum(n_cur)::BIGINT AS tc FROM dv GROUP BY feature
        HAVING sum(n_ref) >= {min_n} AND sum(n_cur) >= {min_n}),
cdf AS (SELECT dv.feature,
               abs((sum(n_ref) OVER w)::DOUBLE / tot.tr::DOUBLE - (sum(n_cur) OVER w)::DOUBLE / tot.tc::DOUBLE) AS diff
        FROM dv JOIN tot ON dv.feature = tot.feature
        WINDOW w AS (PARTITION BY dv.feature ORDER BY dv.value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
st AS (SELECT c.feature, max(c.diff) AS d, any_value(t.tr) AS n_ref, any_value(t.tc) AS n_cur
       FROM cdf c JOIN tot t ON c.feature = t.feature GROUP BY c.feature)
SELECT feature, n_ref, n_cur, {sql_rnd('d', 4)} AS ks_statistic, {sql_rnd(p, 4)} AS p_value,
       {p} < 0.05 AS drift_detected
FROM st"""


_LI_SRC = (f"SELECT l_shipdate < TIMESTAMP '{CUTOFF}' AS is_ref, {', '.join(LI_FEATS)} FROM lineitem")
_EV_SRC = "SELECT event_type <> 'click' AS is_ref, value FROM events"


@register("ks_drift", ops=("D1", "W3", "J7"), sql=_ks_sql(_LI_SRC, LI_FEATS))
def q_ks_drift(spark, sf):
    return D.ks_two_sample(_lineitem_sides(spark, sf), "side", "ref", LI_FEATS)


@register("ks_drift_events", ops=("D1", "W3"), sql=_ks_sql(_EV_SRC, ["value"]))
def q_ks_drift_events(spark, sf):
    return D.ks_two_sample(_events_sides(spark, sf), "side", "ref", ["value"])


@register("drift_summary", ops=("A26",), sql=f"""
WITH k AS ({_ks_sql(_LI_SRC, LI_FEATS)})
SELECT sum(CASE WHEN drift_detected THEN 1 ELSE 0 END)::BIGINT AS n_features_drifted,
       coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE drift_detected)), ','), '') AS drifted_features
FROM k""")
def q_drift_summary(spark, sf):
    return D.drift_summary(D.ks_two_sample(_lineitem_sides(spark, sf), "side", "ref", LI_FEATS))


def _js_sql(ref_where: str, cur_where: str) -> str:
    toks = T.sql_whitespace_words("lower(text)")
    return f"""
WITH r AS (SELECT term, count(*) AS n_ref FROM (SELECT unnest({toks}) AS term FROM documents WHERE {ref_where})
           GROUP BY term),
c AS (SELECT term, count(*) AS n_cur FROM (SELECT unnest({toks}) AS term FROM documents WHERE {cur_where})
      GROUP BY term),
b AS (SELECT coalesce(r.term, c.term) AS term, coalesce(n_ref, 0)::DOUBLE AS n_ref, coalesce(n_cur, 0)::DOUBLE AS n_cur
      FROM r FULL JOIN c ON r.term = c.term),
v AS (SELECT * FROM b ORDER BY n_ref + n_cur DESC, term LIMIT 1000),
d0 AS (SELECT CASE WHEN sum(n_ref) OVER () > 0 THEN n_ref / sum(n_ref) OVER () ELSE n_ref END + 1e-10 AS p0,
              CASE WHEN sum(n_cur) OVER () > 0 THEN n_cur / sum(n_cur) OVER () ELSE n_cur END + 1e-10 AS q0 FROM v),
d AS (SELECT p0 / sum(p0) OVER () AS p, q0 / sum(q0) OVER () AS q FROM d0),
a AS (SELECT sum(p * ln(p / ((p + q) / 2.0)) + q * ln(q / ((p + q) / 2.0))) AS js2, count(*) AS vocab_size FROM d),
s AS (SELECT sqrt(greatest(js2 / 2.0, 0.0)) AS dist, vocab_size FROM a)
SELECT {sql_rnd('dist', 4)} AS js_distance, {sql_rnd('dist * dist', 6)} AS js_divergence, dist > 0.1 AS drift_detected,
       vocab_size::BIGINT AS vocab_size FROM s"""


@register("js_text_drift", ops=("D2", "U4", "A13", "L4"), sql=_js_sql("lang = 'en'", "lang <> 'en'"))
def q_js_text_drift(spark, sf):
    d = catalog.spread(catalog.table(spark, sf, "documents"))
    return D.js_text_drift(d.where(F.col("lang") == "en"), d.where(F.col("lang") != "en"), "text")


_HALF = "substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8'"


@register("js_text_drift_halves", ops=("D2",), sql=_js_sql(_HALF, f"NOT ({_HALF})"))
def q_js_text_drift_halves(spark, sf):
    d = catalog.spread(catalog.table(spark, sf, "documents"))
    half = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < F.lit("8")
    return D.js_text_drift(d.where(half), d.where(~half), "text")


@register("drift_report", ops=("D4", "S12"), sql=f"""
WITH k AS ({_ks_sql(_LI_SRC, LI_FEATS)}),
j AS ({_js_sql("lang = 'en'", "lang <> 'en'")})
SELECT 'numeric' AS section, feature, ks_statistic AS statistic, p_value, drift_detected FROM k
UNION ALL SELECT 'text', 'text', js_distance, CAST(NULL AS DOUBLE), drift_detected FROM j""")
def q_drift_report(spark, sf):
    ks = D.ks_two_sample(_lineitem_sides(spark, sf), "side", "ref", LI_FEATS)
    d = catalog.spread(catalog.table(spark, sf, "documents"))
    js = D.js_text_drift(d.where(F.col("lang") == "en"), d.where(F.col("lang") != "en"), "text")
    return ks.select(F.lit("numeric").alias("section"), "feature", F.col("ks_statistic").alias("statistic"),
                     "p_value", "drift_detected").unionByName(
        js.select(F.lit("text").alias("section"), F.lit("text").alias("feature"),
                  F.col("js_distance").alias("statistic"), F.lit(None).cast("double").alias("p_value"),
                  "drift_detected"))


_ACC = "0.65"  # accuracy handed to the report, below the alert threshold


@register("drift_document", ops=("D4", "D3", "A26", "S12"), sql=f"""
WITH k AS ({_ks_sql(_LI_SRC, LI_FEATS)}),
j AS ({_js_sql("lang = 'en'", "lang <> 'en'")})
SELECT (SELECT string_agg(feature || ':' || CAST(ks_statistic AS DECIMAL(10, 4)) || ':' || drift_detected, ',' ORDER BY feature) FROM k) AS numeric_drift,
       (SELECT count(*) FILTER (WHERE drift_detected) FROM k) AS n_features_drifted,
       (SELECT coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drift_detected), '') FROM k) AS drifted_features,
       js_distance, drift_detected AS text_drift_detected, vocab_size, {_ACC}::DOUBLE AS current_accuracy, 0.70::DOUBLE AS threshold,
       {_ACC} < 0.70 AS alert_triggered FROM j""")
def q_drift_document(spark, sf):
    """The whole drift report as one nested row, written once under a name of its inputs and read back: numeric
    sections, their summary, text section and performance alert."""
    d = catalog.spread(catalog.table(spark, sf, "documents"))
    doc = D.report_document(
        D.ks_two_sample(_lineitem_sides(spark, sf), "side", "ref", LI_FEATS),
        D.js_text_drift(d.where(F.col("lang") == "en"), d.where(F.col("lang") != "en"), "text"),
        spark.createDataFrame([(float(_ACC),)], "accuracy double"))
    path = f"{scratch_path(spark, 'reports')}/{P.content_name(sf, CUTOFF, _ACC)}"
    for _ in range(2):  # a repeated report finds its document and leaves it
        P.write_gated(doc, path, {"n_documents": F.count(F.lit(1))}, lambda m: m["n_documents"] == 1, mode="keep")
    r = spark.read.parquet(path)
    line = F.transform("numeric_drift", lambda x: F.concat_ws(":", x["feature"], x["ks_statistic"].cast("decimal(10,4)"), x["drift_detected"]))
    return r.select(F.array_join(line, ",").alias("numeric_drift"), "numeric_drift_summary.n_features_drifted",
                    F.array_join("numeric_drift_summary.drifted_features", ",").alias("drifted_features"), "text_drift.js_distance",
                    F.col("text_drift.drift_detected").alias("text_drift_detected"), "text_drift.vocab_size",
                    "performance_alert.current_accuracy", "performance_alert.threshold",
                    F.col("performance_alert.alert").alias("alert_triggered"))


@register("windowed_event_counts", ops=("R2",), sql="""
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
       count(*) AS n, """ + sql_rnd("sum(value)", 4) + """ AS total_value
FROM events GROUP BY 1, 2""")
def q_windowed_event_counts(spark, sf):
    # day buckets on the wall-clock (timestamp_ntz) value: no session time zone involved
    ev = catalog.table(spark, sf, "events")
    g = ev.groupBy(F.date_trunc("day", "ts").alias("start"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.sum("value"), 4).alias("total_value"))
    return g.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n",
                    "total_value")
