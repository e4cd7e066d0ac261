"""DuckDB twins of the Spark plans, generated from the same column lists.

These strings are the independent oracle: they use DuckDB's own ``median``,
``quantile_cont``, windows and joins, never the Spark statistics.
"""

from __future__ import annotations

from cribble.sources.catalog import ITEM_FEATURES, ITEMS_SQL

FEATS = list(ITEM_FEATURES)
NUM = FEATS + ["price"]
EPS = "CAST(1e-6 AS DOUBLE)"


def with_items(body: str) -> str:
    return f"WITH {ITEMS_SQL},\n{body}"


def prepared_ctes() -> str:
    """CTE chain ending in ``prepared`` (E11 median path)."""
    med = ", ".join(f"median({c}) AS m_{c}" for c in NUM)
    fill = ", ".join(f"coalesce(i.{c}, m.m_{c}) AS {c}" for c in NUM)
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in NUM)
    clip = ", ".join(
        f"CASE WHEN f.{c} IS NULL THEN NULL ELSE least(greatest(f.{c}, q.q1_{c} - 1.5 * (q.q3_{c} - q.q1_{c})), "
        f"q.q3_{c} + 1.5 * (q.q3_{c} - q.q1_{c})) END AS {c}" for c in NUM)
    scale_cols = FEATS + ["density"]
    st = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in scale_cols)
    scaled = ", ".join(f"({c} - m_{c}) / coalesce(nullif(s_{c}, 0), 1.0) AS {c}" for c in scale_cols)
    return f"""
med AS (SELECT {med} FROM items),
f1 AS (SELECT i.item_id, {fill}, i.cat, i.src FROM items i, med m),
mode_src AS (SELECT src AS m FROM f1 WHERE src IS NOT NULL GROUP BY src ORDER BY count(*) DESC, src LIMIT 1),
f AS (SELECT f1.* REPLACE (coalesce(f1.src, (SELECT m FROM mode_src)) AS src) FROM f1),
q AS (SELECT {qs} FROM f),
clip AS (SELECT f.item_id, {clip}, f.cat, f.src FROM f, q),
src_codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
              FROM (SELECT DISTINCT coalesce(src, 'Unknown') AS v FROM clip)),
cat_codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code
              FROM (SELECT DISTINCT cat AS v FROM clip WHERE cat IS NOT NULL)),
enc AS (SELECT c.*, sc.code AS src_enc, cc.code AS cat_enc,
               c.w / (nullif(c.v, 0) + {EPS}) AS density0
        FROM clip c LEFT JOIN src_codes sc ON coalesce(c.src, 'Unknown') = sc.v
                    LEFT JOIN cat_codes cc ON c.cat = cc.v),
dmed AS (SELECT median(density0) AS md FROM enc),
enc2 AS (SELECT enc.* EXCLUDE (density0), coalesce(density0, md) AS density FROM enc, dmed),
st AS (SELECT {st} FROM enc2),
scaled AS (SELECT item_id, {scaled}, price, cat, src, src_enc, cat_enc FROM enc2, st),
pos AS (SELECT *, row_number() OVER (PARTITION BY cat_enc ORDER BY md5(CAST(item_id AS VARCHAR))) AS pos,
               count(*) OVER (PARTITION BY cat_enc) AS n_c
        FROM scaled WHERE cat_enc IS NOT NULL),
prepared AS (
  SELECT * EXCLUDE (pos, n_c),
         CASE WHEN pos * 10000 <= n_c * 7000 THEN 'train'
              WHEN pos * 10000 <= n_c * 8500 THEN 'val' ELSE 'test' END AS split
  FROM pos
  UNION ALL BY NAME
  SELECT *, 'train' AS split FROM scaled WHERE cat_enc IS NULL)"""
