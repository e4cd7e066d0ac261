"""Registered queries for profiling and preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cribble.functions.numeric import rnd, sql_rnd
from cribble.operators import prep, profile
from cribble.plans.prepare import PrepSpec, prepare, preparation_metrics, split_summary
from cribble.plans.registry import register
from cribble.plans.sqlgen import EPS, FEATS, NUM, prepared_ctes, with_items
from cribble.sources import catalog

ITEM_COLS = ["item_id", "w", "v", "c", "o", "r", "price", "cat", "src"]


def _items(spark, sf):
    return catalog.items(spark, sf)


# ---------------------------------------------------------------- flagship

_FLAG_AVGS = ", ".join(sql_rnd(f"avg({c})", 6) + f" AS avg_{c}" for c in FEATS + ["density"])


@register("prepare_split_summary", ops=("E11", "W1", "E4", "E6", "E7", "A4", "A5", "E1", "E2", "P7", "U1", "S4"),
          sql=with_items(prepared_ctes() + f"""
SELECT split, count(*) AS n_rows, count(cat_enc) AS n_labelled, {_FLAG_AVGS},
       {sql_rnd('avg(price)', 4)} AS avg_price, {sql_rnd('avg(src_enc)', 6)} AS avg_src_enc
FROM prepared GROUP BY split"""))
def q_prepare_split_summary(spark, sf):
    prepared, _ = prepare(_items(spark, sf))
    return split_summary(prepared)


@register("prepare_metrics", ops=("E11", "S5"), sql=with_items(prepared_ctes() + """
SELECT sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END)::BIGINT AS n_train,
       sum(CASE WHEN split = 'val' THEN 1 ELSE 0 END)::BIGINT AS n_val,
       sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END)::BIGINT AS n_test,
       (count(*) * 13 - (count(item_id) + count(w) + count(v) + count(c) + count(o) + count(r)
        + count(density) + count(price) + count(cat) + count(src) + count(src_enc) + count(cat_enc)
        + count(split)))::BIGINT AS nan_remaining,
       (SELECT count(DISTINCT cat) FROM items)::BIGINT AS n_classes,
       'median' AS imputation_method
FROM prepared"""))
def q_prepare_metrics(spark, sf):
    prepared, fitted = prepare(_items(spark, sf))
    return preparation_metrics(prepared, fitted)


@register("prepared_rows", ops=("E11", "S4"), sql=with_items(prepared_ctes() + f"""
SELECT item_id, {", ".join(sql_rnd(c, 6) + " AS " + c for c in FEATS + ["density"])},
       {sql_rnd('price', 4)} AS price, cat, src, src_enc, cat_enc, split FROM prepared"""))
def q_prepared_rows(spark, sf):
    prepared, _ = prepare(_items(spark, sf))
    return prepared.select("item_id", *[rnd(c, 6).alias(c) for c in FEATS + ["density"]],
                           rnd("price", 4).alias("price"), "cat", "src", "src_enc", "cat_enc", "split")


# ---------------------------------------------------------------- profiling

_NULLS = " + ".join(f"count(*) - count({c})" for c in ITEM_COLS)


@register("scan_profile", ops=("S1", "A1"), sql=with_items(f"""
s AS (SELECT 1)
SELECT count(*) AS n_rows, CAST({len(ITEM_COLS)} AS BIGINT) AS n_cols,
       CAST({_NULLS} AS BIGINT) AS n_null_cells FROM items"""))
def q_scan_profile(spark, sf):
    return profile.scan_profile(_items(spark, sf))


_NULLPCT = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, "
    + sql_rnd(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE * CAST(100 AS DOUBLE)", 1)
    + f" AS null_pct FROM items" for c in ITEM_COLS)


@register("null_pct", ops=("A2",), sql=with_items(f"s AS (SELECT 1)\n{_NULLPCT}"))
def q_null_pct(spark, sf):
    return profile.null_pct(_items(spark, sf))


@register("null_pct_missing_only", ops=("P13",), sql=with_items(
    f"s AS (SELECT 1)\nSELECT * FROM ({_NULLPCT}) WHERE null_pct > 0"))
def q_null_pct_missing(spark, sf):
    return profile.null_pct(_items(spark, sf), only_missing=True)


@register("distinct_sources", ops=("A3",), sql=with_items(
    "s AS (SELECT 1)\nSELECT count(DISTINCT src) AS n_distinct FROM items"))
def q_distinct_sources(spark, sf):
    return profile.distinct_count(_items(spark, sf), "src")


@register("value_counts", ops=("A10",), sql=with_items(
    "s AS (SELECT 1)\nSELECT cat AS value, count(*) AS n FROM items WHERE cat IS NOT NULL GROUP BY cat"))
def q_value_counts(spark, sf):
    return profile.value_counts(_items(spark, sf), "cat")


def _corr_sql(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    xa, ya = f"CASE WHEN {both} THEN {a} END", f"CASE WHEN {both} THEN {b} END"
    return f"covar_pop({xa}, {ya}) / nullif(stddev_pop({xa}) * stddev_pop({ya}), 0)"


_CORR_COLS = FEATS + ["price"]
_CORR = "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {sql_rnd(_corr_sql(a, b), 6)} AS corr FROM items"
    for a in _CORR_COLS for b in _CORR_COLS if a != b) + "\nUNION ALL " + "\nUNION ALL ".join(
    f"SELECT '{c}', '{c}', CASE WHEN stddev_pop({c}) > 0 THEN 1.0 END FROM items" for c in _CORR_COLS)


@register("corr_matrix", ops=("A8",), sql=with_items(f"s AS (SELECT 1)\n{_CORR}"))
def q_corr_matrix(spark, sf):
    return profile.corr_matrix(_items(spark, sf), _CORR_COLS)


def _mech_sql() -> str:
    parts = []
    for c in _CORR_COLS:
        ind = f"(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE"
        others = [f"coalesce(abs({_corr_sql(o, ind)}), 0.0)" for o in _CORR_COLS if o != c]
        mx = f"greatest(0.0, {', '.join(others)})"
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing, {sql_rnd(mx, 6)} AS max_abs_corr, "
            f"CASE WHEN {mx} > 0.3 THEN 'MAR' ELSE 'MCAR' END AS mechanism FROM items")
    parts.append("SELECT 'cat' AS column_name, count(*) - count(cat) AS n_missing, "
                 "CAST(NULL AS DOUBLE) AS max_abs_corr, 'MNAR' AS mechanism FROM items")
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ") WHERE n_missing > 0"


@register("missing_mechanism", ops=("A9",), sql=with_items(f"s AS (SELECT 1)\n{_mech_sql()}"))
def q_missing_mechanism(spark, sf):
    return profile.missing_mechanism(_items(spark, sf), _CORR_COLS, "cat")


@register("overview", ops=("H1",), sql=with_items("""
s AS (SELECT 1)
SELECT count(*) AS n_rows, sum(CASE WHEN cat IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_unlabelled,
       count(DISTINCT src) AS n_sources FROM items"""))
def q_overview(spark, sf):
    return profile.overview(_items(spark, sf), "cat", "src")


# ---------------------------------------------------------------- projections / filters

@register("project_present", ops=("P1",), sql=with_items(
    "s AS (SELECT 1)\nSELECT item_id, w, price, cat FROM items"))
def q_project_present(spark, sf):
    return profile.project_present(_items(spark, sf), ["item_id", "w", "missing_col", "price", "cat"])


@register("filter_labelled", ops=("P2", "P6"), sql=with_items(
    "s AS (SELECT 1)\nSELECT item_id, w, src FROM items WHERE cat IS NOT NULL"))
def q_filter_labelled(spark, sf):
    return prep.filter_labelled(_items(spark, sf), "cat").select("item_id", "w", "src")


@register("filter_unlabelled", ops=("P3",), sql=with_items(
    "s AS (SELECT 1)\nSELECT item_id, w, src FROM items WHERE cat IS NULL"))
def q_filter_unlabelled(spark, sf):
    return prep.filter_unlabelled(_items(spark, sf), "cat").select("item_id", "w", "src")


@register("drop_null_subset", ops=("P4",), sql=with_items(
    "s AS (SELECT 1)\nSELECT * FROM items WHERE w IS NOT NULL AND src IS NOT NULL"))
def q_drop_null_subset(spark, sf):
    return prep.drop_null_subset(_items(spark, sf), ["w", "src"])


@register("fill_constant", ops=("P9",), sql=with_items("""
s AS (SELECT 1)
SELECT item_id, coalesce(src, 'Unknown') AS src, coalesce(cat, 'Non labellisé') AS cat FROM items"""))
def q_fill_constant(spark, sf):
    df = prep.fill_constant(_items(spark, sf), {"src": "Unknown", "cat": "Non labellisé"})
    return df.select("item_id", "src", "cat")


# ---------------------------------------------------------------- medians, mode

_MED = ", ".join(f"median({c}) AS {c}" for c in NUM)


@register("median_fill", ops=("A4", "E7"), sql=with_items(f"""
m AS (SELECT {_MED} FROM items)
SELECT i.item_id, {", ".join(f"coalesce(i.{c}, m.{c}) AS {c}" for c in NUM)} FROM items i, m"""))
def q_median_fill(spark, sf):
    df = _items(spark, sf)
    med = prep.fit_medians(df, NUM)
    return prep.apply_fill(df, med).select("item_id", *NUM)


@register("medians", ops=("A4",), sql=with_items(f"s AS (SELECT 1)\nSELECT {_MED} FROM items"))
def q_medians(spark, sf):
    df = _items(spark, sf)
    med = prep.fit_medians(df, NUM)
    return spark.createDataFrame([tuple(med[c] for c in NUM)], ", ".join(f"{c} double" for c in NUM))


@register("mode_fill", ops=("A5",), sql=with_items("""
m AS (SELECT src AS m FROM items WHERE src IS NOT NULL GROUP BY src ORDER BY count(*) DESC, src LIMIT 1)
SELECT item_id, coalesce(src, (SELECT m FROM m)) AS src FROM items"""))
def q_mode_fill(spark, sf):
    df = _items(spark, sf)
    mode = prep.fit_mode(df, "src")
    return prep.apply_fill(df, {"src": mode}).select("item_id", "src")


# ---------------------------------------------------------------- IQR

_Q = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in NUM)


@register("iqr_bounds", ops=("A6",), sql=with_items(f"""
q AS (SELECT {_Q} FROM items)
{" UNION ALL ".join(f"SELECT '{c}' AS column_name, q1_{c} AS q1, q3_{c} AS q3, q1_{c} - 1.5 * (q3_{c} - q1_{c}) AS lo, q3_{c} + 1.5 * (q3_{c} - q1_{c}) AS hi FROM q" for c in NUM)}"""))
def q_iqr_bounds(spark, sf):
    b = prep.fit_iqr(_items(spark, sf), NUM)
    rows = [(c, x.q1, x.q3, x.lo, x.hi) for c, x in b.items()]
    return spark.createDataFrame(rows, "column_name string, q1 double, q3 double, lo double, hi double")


@register("outlier_counts", ops=("A7", "P11"), sql=with_items(f"""
q AS (SELECT {_Q} FROM items)
{" UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(coalesce(sum(CASE WHEN {c} < q1_{c} - 1.5 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5 * (q3_{c} - q1_{c}) THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_outliers FROM items, q" for c in NUM)}"""))
def q_outlier_counts(spark, sf):
    df = _items(spark, sf)
    return prep.outlier_counts(df, prep.fit_iqr(df, NUM))


@register("iqr_clip", ops=("E6",), sql=with_items(f"""
q AS (SELECT {_Q} FROM items)
SELECT item_id, {", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, q1_{c} - 1.5 * (q3_{c} - q1_{c})), q3_{c} + 1.5 * (q3_{c} - q1_{c})) END AS {c}" for c in NUM)}
FROM items, q"""))
def q_iqr_clip(spark, sf):
    df = _items(spark, sf)
    return prep.apply_clip(df, prep.fit_iqr(df, NUM)).select("item_id", *NUM)


# ---------------------------------------------------------------- encoding

@register("label_encode", ops=("E1",), sql=with_items("""
codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT coalesce(src, 'Unknown') AS v FROM items))
SELECT i.item_id, coalesce(i.src, 'Unknown') AS src, c.code AS src_enc
FROM items i JOIN codes c ON coalesce(i.src, 'Unknown') = c.v"""))
def q_label_encode(spark, sf):
    df = _items(spark, sf)
    codes = prep.fit_codes(df, "src", null_as="Unknown")
    out = prep.apply_codes(df, "src", codes, "src_enc", null_as="Unknown")
    return out.select("item_id", F.coalesce("src", F.lit("Unknown")).alias("src"), "src_enc")


@register("label_encode_nullable", ops=("E2", "P5"), sql=with_items("""
codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT cat AS v FROM items WHERE cat IS NOT NULL))
SELECT i.item_id, i.cat, c.code AS cat_enc FROM items i LEFT JOIN codes c ON i.cat = c.v"""))
def q_label_encode_nullable(spark, sf):
    df = _items(spark, sf)
    codes = prep.fit_codes(df, "cat")
    return prep.apply_codes(df, "cat", codes, "cat_enc").select("item_id", "cat", "cat_enc")


@register("encode_unseen", ops=("E3",), sql="""
WITH codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
               FROM (SELECT DISTINCT o_orderstatus AS v FROM orders WHERE o_orderdate < TIMESTAMP '1995-01-01'))
SELECT o.o_orderkey, o.o_orderstatus, coalesce(c.code, 0) AS status_enc
FROM orders o LEFT JOIN codes c ON o.o_orderstatus = c.v""")
def q_encode_unseen(spark, sf):
    """Codes fitted on the oldest orders, applied to all; unseen -> 0."""
    orders = catalog.table(spark, sf, "orders")
    codes = prep.fit_codes(orders.where(F.col("o_orderdate") < F.lit("1995-01-01").cast("timestamp_ntz")),
                           "o_orderstatus")
    out = prep.apply_codes(orders, "o_orderstatus", codes, "status_enc", unseen=0)
    return out.select("o_orderkey", "o_orderstatus", "status_enc")


@register("label_decode", ops=("J2",), sql=with_items("""
codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT cat AS v FROM items WHERE cat IS NOT NULL)),
enc AS (SELECT i.item_id, c.code AS cat_enc FROM items i LEFT JOIN codes c ON i.cat = c.v)
SELECT e.item_id, e.cat_enc, c.v AS cat_decoded FROM enc e LEFT JOIN codes c ON e.cat_enc = c.code"""))
def q_label_decode(spark, sf):
    df = _items(spark, sf)
    codes = prep.fit_codes(df, "cat")
    enc = prep.apply_codes(df, "cat", codes, "cat_enc")
    return prep.decode(enc, "cat_enc", codes, "cat_decoded").select("item_id", "cat_enc", "cat_decoded")


# ---------------------------------------------------------------- scaling, ratios

_ST = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATS)


@register("standardize", ops=("E4", "E5"), sql=with_items(f"""
st AS (SELECT {_ST} FROM items)
SELECT item_id, {", ".join(sql_rnd(f"({c} - m_{c}) / coalesce(nullif(s_{c}, 0), 1.0)", 6) + f" AS {c}" for c in FEATS)}
FROM items, st"""))
def q_standardize(spark, sf):
    df = _items(spark, sf)
    sc = prep.fit_scale(df, FEATS)
    return prep.apply_scale(df, sc).select("item_id", *[rnd(c, 6).alias(c) for c in FEATS])


@register("density_ratio", ops=("P7",), sql=with_items(f"""
d AS (SELECT item_id, w / (nullif(v, 0) + {EPS}) AS density FROM items),
m AS (SELECT median(density) AS md FROM d)
SELECT item_id, {sql_rnd('coalesce(density, md)', 6)} AS density FROM d, m"""))
def q_density_ratio(spark, sf):
    df = _items(spark, sf).withColumn("density", prep.ratio("w", "v"))
    med = prep.fit_medians(df, ["density"])
    return prep.apply_fill(df, med).select("item_id", rnd("density", 6).alias("density"))


@register("density_online", ops=("P8",), sql=with_items(f"""
s AS (SELECT 1)
SELECT item_id, {sql_rnd(f'w / (v + {EPS})', 6)} AS density FROM items"""))
def q_density_online(spark, sf):
    df = _items(spark, sf)
    return df.select("item_id", rnd(prep.ratio("w", "v", zero_to_null=False), 6).alias("density"))


# ---------------------------------------------------------------- split / folds / unions

@register("stratified_split", ops=("W1", "U1"), sql=with_items("""
pos AS (SELECT item_id, cat,
               row_number() OVER (PARTITION BY cat ORDER BY md5(CAST(item_id AS VARCHAR))) AS pos,
               count(*) OVER (PARTITION BY cat) AS n_c
        FROM items WHERE cat IS NOT NULL),
s AS (SELECT item_id, cat, CASE WHEN pos * 10000 <= n_c * 7000 THEN 'train'
                                WHEN pos * 10000 <= n_c * 8500 THEN 'val' ELSE 'test' END AS split FROM pos
      UNION ALL SELECT item_id, cat, 'train' AS split FROM items WHERE cat IS NULL)
SELECT item_id, cat, split FROM s"""))
def q_stratified_split(spark, sf):
    df = _items(spark, sf).select("item_id", "cat")
    return prep.stratified_split(df, "cat", "item_id").select("item_id", "cat", "split")


@register("split_sizes", ops=("W1",), sql=with_items("""
pos AS (SELECT item_id, cat,
               row_number() OVER (PARTITION BY cat ORDER BY md5(CAST(item_id AS VARCHAR))) AS pos,
               count(*) OVER (PARTITION BY cat) AS n_c
        FROM items WHERE cat IS NOT NULL),
s AS (SELECT cat, CASE WHEN pos * 10000 <= n_c * 7000 THEN 'train'
                       WHEN pos * 10000 <= n_c * 8500 THEN 'val' ELSE 'test' END AS split FROM pos
      UNION ALL SELECT cat, 'train' AS split FROM items WHERE cat IS NULL)
SELECT split, cat, count(*) AS n FROM s GROUP BY split, cat"""))
def q_split_sizes(spark, sf):
    df = _items(spark, sf).select("item_id", "cat")
    return prep.stratified_split(df, "cat", "item_id").groupBy("split", "cat").agg(F.count(F.lit(1)).alias("n"))


@register("fold_assign", ops=("W2",), sql=with_items("""
s AS (SELECT item_id, cat, CAST((row_number() OVER (PARTITION BY cat ORDER BY md5(CAST(item_id AS VARCHAR))) - 1) % 5 AS INTEGER) AS fold
      FROM items WHERE cat IS NOT NULL)
SELECT item_id, cat, fold FROM s"""))
def q_fold_assign(spark, sf):
    df = _items(spark, sf).select("item_id", "cat")
    return prep.fold_assign(df, "cat", "item_id", 5).select("item_id", "cat", "fold")


@register("union_unlabelled", ops=("U1",), sql=with_items("""
s AS (SELECT 1)
SELECT item_id, w, cat, CAST(NULL AS DOUBLE) AS extra FROM items WHERE cat IS NULL
UNION ALL SELECT item_id, w, cat, price AS extra FROM items WHERE cat IS NOT NULL"""))
def q_union_unlabelled(spark, sf):
    df = _items(spark, sf)
    labelled = df.where(F.col("cat").isNotNull()).select("item_id", "w", "cat", F.col("price").alias("extra"))
    unlabelled = df.where(F.col("cat").isNull()).select("item_id", "w", "cat")
    return prep.union_all([unlabelled, labelled])


@register("union_splits", ops=("U2", "U3"), sql=with_items("""
pos AS (SELECT item_id, cat,
               row_number() OVER (PARTITION BY cat ORDER BY md5(CAST(item_id AS VARCHAR))) AS pos,
               count(*) OVER (PARTITION BY cat) AS n_c
        FROM items WHERE cat IS NOT NULL),
s AS (SELECT item_id, CASE WHEN pos * 10000 <= n_c * 7000 THEN 'train'
                           WHEN pos * 10000 <= n_c * 8500 THEN 'val' ELSE 'test' END AS split FROM pos
      UNION ALL SELECT item_id, 'train' AS split FROM items WHERE cat IS NULL)
SELECT item_id, split FROM s WHERE split IN ('train', 'test')"""))
def q_union_splits(spark, sf):
    s = prep.stratified_split(_items(spark, sf).select("item_id", "cat"), "cat", "item_id")
    return prep.union_all([s.where(F.col("split") == "train"), s.where(F.col("split") == "test")]).select(
        "item_id", "split")


@register("split_median_fill", ops=("E12",), sql=with_items("""
pos AS (SELECT i.*,
               row_number() OVER (PARTITION BY cat ORDER BY md5(CAST(item_id AS VARCHAR))) AS pos,
               count(*) OVER (PARTITION BY cat) AS n_c
        FROM items i WHERE cat IS NOT NULL),
s AS (SELECT item_id, w, v, CASE WHEN pos * 10000 <= n_c * 7000 THEN 'train'
                                 WHEN pos * 10000 <= n_c * 8500 THEN 'val' ELSE 'test' END AS split FROM pos
      UNION ALL SELECT item_id, w, v, 'train' AS split FROM items WHERE cat IS NULL),
m AS (SELECT split, median(w) AS mw, median(v) AS mv FROM s GROUP BY split)
SELECT s.item_id, s.split, coalesce(s.w, m.mw) AS w, coalesce(s.v, m.mv) AS v FROM s JOIN m USING (split)"""))
def q_split_median_fill(spark, sf):
    s = prep.stratified_split(_items(spark, sf).select("item_id", "cat", "w", "v"), "cat", "item_id")
    med = prep.fit_group_medians(s, ["w", "v"], "split")
    return prep.apply_group_fill(s, med, "split").select("item_id", "split", "w", "v")


# ---------------------------------------------------------------- validation, masks, imputation error

from cribble.operators import validate as VAL  # noqa: E402

_REQ = ("SELECT item_id, w AS poids, v AS volume, c AS conductivite, o AS opacite, r AS rigidite, src AS source, "
        "cat AS rapport_collecte FROM items")


def _requests(spark, sf):
    return _items(spark, sf).select(
        "item_id", F.col("w").alias("poids"), F.col("v").alias("volume"), F.col("c").alias("conductivite"),
        F.col("o").alias("opacite"), F.col("r").alias("rigidite"), F.col("src").alias("source"),
        F.col("cat").alias("rapport_collecte"))


def _reasons_sql() -> str:
    from cribble.functions import fixed
    checks = []
    for col, lo, hi in fixed.REQUEST_RANGES:
        w = f"WHEN {col} IS NULL OR isnan({col}) THEN '{col}:required'"
        if lo is not None:
            w += f" WHEN {col} < {lo} THEN '{col}:min'"
        if hi is not None:
            w += f" WHEN {col} > {hi} THEN '{col}:max'"
        checks.append(f"CASE {w} END")
    checks.append("CASE WHEN rapport_collecte IS NULL THEN 'rapport_collecte:required' "
                  f"WHEN length(rapport_collecte) < {fixed.MIN_TEXT_LENGTH} THEN 'rapport_collecte:min_length' END")
    return f"array_to_string(list_sort(list_filter([{', '.join(checks)}], lambda x: x IS NOT NULL)), ',')"


@register("validate_requests", ops=("P10", "R1"), sql=with_items(f"""
req AS ({_REQ})
SELECT item_id, coalesce(source, 'Unknown') AS source, {_reasons_sql()} AS reasons,
       {_reasons_sql()} = '' AS valid FROM req"""))
def q_validate_requests(spark, sf):
    return VAL.validate(_requests(spark, sf)).select("item_id", "source", "reasons", "valid")


@register("quarantine_counts", ops=("P10",), sql=with_items(f"""
req AS ({_REQ})
SELECT {_reasons_sql()} = '' AS valid, count(*) AS n FROM req GROUP BY 1"""))
def q_quarantine_counts(spark, sf):
    return VAL.validate(_requests(spark, sf)).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


_TH = prep.mask_threshold_hex(0.10)


def _mask_sql(c: str) -> str:
    return f"(substr(md5(CAST(item_id AS VARCHAR) || '|{c}'), 1, 8) < '{_TH}' AND {c} IS NOT NULL)"


@register("mask_cells", ops=("P12",), sql=with_items(f"""
m AS (SELECT {_MED} FROM items),
ref AS (SELECT i.item_id, {", ".join(f"coalesce(i.{c}, m.{c}) AS {c}" for c in NUM)} FROM items i, m)
SELECT item_id, {", ".join(f"CASE WHEN {_mask_sql(c)} THEN NULL ELSE {c} END AS {c}, {_mask_sql(c)} AS m_{c}" for c in FEATS)}
FROM ref"""))
def q_mask_cells(spark, sf):
    df = _items(spark, sf)
    ref = prep.apply_fill(df, prep.fit_medians(df, NUM)).select("item_id", *FEATS)
    return prep.mask_cells(ref, "item_id", FEATS).select("item_id", *FEATS, *[f"m_{c}" for c in FEATS])


@register("imputer_rmse", ops=("A12", "E10"), sql=with_items(f"""
m AS (SELECT {_MED} FROM items),
ref AS (SELECT i.item_id, {", ".join(f"coalesce(i.{c}, m.{c}) AS {c}" for c in NUM)} FROM items i, m),
masked AS (SELECT item_id, {", ".join(f"CASE WHEN {_mask_sql(c)} THEN NULL ELSE {c} END AS {c}, {_mask_sql(c)} AS m_{c}" for c in FEATS)} FROM ref),
m2 AS (SELECT {", ".join(f"median({c}) AS {c}" for c in FEATS)} FROM masked),
err AS ({" UNION ALL ".join(f"SELECT (m2.{c} - r.{c}) * (m2.{c} - r.{c}) AS e FROM masked k JOIN ref r USING (item_id), m2 WHERE k.m_{c}" for c in FEATS)})
SELECT 'median' AS method, {sql_rnd('sqrt(avg(e))', 4)} AS rmse, count(*) AS n_masked FROM err"""))
def q_imputer_rmse(spark, sf):
    df = _items(spark, sf).persist()
    ref = prep.apply_fill(df, prep.fit_medians(df, NUM)).select("item_id", *FEATS, *[F.col(c).alias(f"t_{c}") for c in FEATS])
    masked = prep.mask_cells(ref, "item_id", FEATS).persist()
    imputed = prep.apply_fill(masked, prep.fit_medians(masked, FEATS))
    r = prep.masked_rmse(imputed, FEATS)
    return r.select(F.lit("median").alias("method"), rnd("rmse", 4).alias("rmse"), F.col("n_masked").cast("long").alias("n_masked"))


@register("standardize_apply", ops=("E5", "B8"), sql=with_items(f"""
pos AS (SELECT i.*, row_number() OVER (PARTITION BY cat ORDER BY md5(CAST(item_id AS VARCHAR))) AS pos,
               count(*) OVER (PARTITION BY cat) AS n_c FROM items i WHERE cat IS NOT NULL),
s AS (SELECT *, CASE WHEN pos * 10000 <= n_c * 7000 THEN 'train'
                     WHEN pos * 10000 <= n_c * 8500 THEN 'val' ELSE 'test' END AS split FROM pos),
st AS (SELECT {_ST} FROM s WHERE split = 'train')
SELECT item_id, split, {", ".join(sql_rnd(f"({c} - m_{c}) / coalesce(nullif(s_{c}, 0), 1.0)", 6) + f" AS {c}" for c in FEATS)}
FROM s, st WHERE split <> 'train'"""))
def q_standardize_apply(spark, sf):
    """Scaler fitted on the training split only, applied to validation and test rows."""
    s = prep.stratified_split(_items(spark, sf).where(F.col("cat").isNotNull()), "cat", "item_id")
    sc = prep.fit_scale(s.where(F.col("split") == "train"), FEATS)
    out = prep.apply_scale(s.where(F.col("split") != "train"), sc)
    return out.select("item_id", "split", *[rnd(c, 6).alias(c) for c in FEATS])


# ---------------------------------------------------------------- iterative imputation

from cribble.operators import impute as IMP  # noqa: E402


@register("mice_impute", ops=("E9",))
def q_mice_impute(spark, sf):
    """Chained-equation imputation of the item features (Bayesian ridge, <= 10 rounds)."""
    df = _items(spark, sf).select("item_id", *FEATS)
    out, _ = IMP.mice_impute(df, FEATS)
    return out.select("item_id", *[rnd(c, 6).alias(c) for c in FEATS])


@register("compare_imputers", ops=("E10", "A12", "A25", "P12"))
def q_compare_imputers(spark, sf):
    """Median vs iterative imputation on a 10 % cell mask of the median-filled features;
    pooled RMSE per method and the chosen (lowest-RMSE) method."""
    best, _, scores = IMP.compare_imputers(_items(spark, sf).persist(), "item_id", FEATS)
    return spark.createDataFrame([(n, v, k, n == best) for n, v, k in scores],
                                 "method string, rmse double, n_masked long, chosen boolean")


@register("imputed_items", ops=("E10", "E9"))
def q_imputed_items(spark, sf):
    """The items imputed by the method that won the comparison."""
    best, out, _ = IMP.compare_imputers(_items(spark, sf).select("item_id", *FEATS).persist(), "item_id", FEATS)
    return out.select("item_id", F.lit(best).alias("method"), *[rnd(c, 6).alias(c) for c in FEATS])


# One round over two columns, each predicted from the other: the evidence iteration of the ridge as a recursion.
def _ridge_ctes(name: str, src: str, x: str, y: str, mx: str, my: str) -> str:
    return f"""
{name}_s AS (SELECT n, syy - sy * sy / n AS yty, sxx - sx * sx / n AS xtx, sxy - sx * sy / n AS xty, sx / n AS xm, sy / n AS ym
  FROM (SELECT CAST(count(*) AS DOUBLE) AS n, sum({x} - {mx}) AS sx, sum({y} - {my}) AS sy, sum(({x} - {mx}) * ({x} - {mx})) AS sxx,
               sum(({x} - {mx}) * ({y} - {my})) AS sxy, sum(({y} - {my}) * ({y} - {my})) AS syy FROM {src}, mm WHERE NOT {y}_miss)),
{name}_i(it, c, prev, alpha, lam, done) AS (
  SELECT 0, NULL::DOUBLE, NULL::DOUBLE, 1.0 / (yty / n + 2.220446049250313e-16), 1.0::DOUBLE, false FROM {name}_s
  UNION ALL
  SELECT it + 1, c2, c, (n - g + 2e-6) / (greatest(yty - 2 * c2 * xty + c2 * c2 * xtx, 0) + 2e-6), (g + 2e-6) / (c2 * c2 + 2e-6),
         it > 0 AND abs(c - c2) < 1e-3
  FROM (SELECT r.*, s.*, xty / (xtx + lam / alpha) AS c2, alpha * xtx / (lam + alpha * xtx) AS g FROM {name}_i r, {name}_s s
        WHERE NOT done AND it < 300)),
{name} AS (SELECT xty / (xtx + lam / alpha) AS coef, ym - xm * xty / (xtx + lam / alpha) AS icpt
  FROM {name}_i, {name}_s ORDER BY it DESC LIMIT 1)"""


@register("mice_round", ops=("E9",), sql=with_items(f"""
q AS (SELECT item_id, w, CASE WHEN item_id % 20 = 9 THEN NULL ELSE v END AS v FROM items),
mm AS (SELECT avg(w) AS mw, avg(v) AS mv FROM q),
f0 AS (SELECT item_id, coalesce(v, mv) AS v, coalesce(w, mw) AS w, v IS NULL AS v_miss, w IS NULL AS w_miss FROM q, mm),
{_ridge_ctes("rv", "f0", "w", "v", "mw", "mv")},
f1 AS (SELECT item_id, w, w_miss, v_miss, CASE WHEN v_miss THEN mv + icpt + coef * (w - mw) ELSE v END AS v FROM f0, mm, rv),
{_ridge_ctes("rw", "f1", "v", "w", "mv", "mw")}
SELECT item_id, {sql_rnd('v', 4)} AS v, {sql_rnd('CASE WHEN w_miss THEN mw + icpt + coef * (v - mv) ELSE w END', 4)} AS w
FROM f1, mm, rw""").replace("WITH ", "WITH RECURSIVE ", 1))
def q_mice_round(spark, sf):
    """One round of chained equations on two columns (v has fewer missing cells and comes first), applied to the
    rows as a fitted transform."""
    df = catalog.items(spark, sf).select("item_id", "w", F.when(F.col("item_id") % 20 != 9, F.col("v")).alias("v"))
    model, _ = IMP.fit_chained(df.persist(), ["w", "v"], max_iter=1)
    return IMP.apply_chained(df, model).select("item_id", rnd("v", 4).alias("v"), rnd("w", 4).alias("w"))
