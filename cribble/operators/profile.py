"""Table profiling: counts, null shares, distinct counts, value counts,
pairwise correlation and the missing-value mechanism (SURVEY A1-A3, A8-A10,
P13, H1).  Every profile is a single aggregation pass (plus an ``unpivot``
of its one-row result), so the cost is one scan regardless of column count.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cribble.functions.numeric import rnd


def scan_profile(df: DataFrame) -> DataFrame:
    """Rows, columns and total null cells (NaN counts as missing)."""
    nulls = [F.sum(_is_missing(df, c).cast("long")) for c in df.columns]
    total = nulls[0]
    for n in nulls[1:]:
        total = total + n
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("long").alias("n_cols"),
        F.coalesce(total, F.lit(0)).cast("long").alias("n_null_cells"),
    )


def _is_missing(df: DataFrame, c: str) -> F.Column:
    dtype = dict(df.dtypes)[c]
    if dtype in ("double", "float"):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def null_pct(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = False) -> DataFrame:
    """Percentage of missing cells per column, rounded to one digit."""
    cols = list(cols or df.columns)
    wide = df.agg(*[
        rnd(F.avg(_is_missing(df, c).cast("double")) * 100.0, 1).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column_name", "null_pct")
    if only_missing:
        long = long.where(F.col("null_pct") > 0)
    return long


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Exact count of distinct non-null values (A3)."""
    return df.agg(F.count_distinct(F.col(col)).cast("long").alias("n_distinct"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Group counts, most frequent first, nulls dropped (A10)."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc("value")))


def _pair_corr(x: F.Column, y: F.Column) -> F.Column:
    both = x.isNotNull() & y.isNotNull()
    xa, ya = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xa, ya), F.stddev_pop(xa) * F.stddev_pop(ya))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every column pair.

    Constant columns give NULL (pandas gives NaN; Spark's ``corr`` would raise
    under ANSI mode).  Only the upper triangle is aggregated (one pass); the
    lower triangle is its mirror and the diagonal is 1 where the column varies.
    """
    cols = list(cols)
    upper = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    aggs = [rnd(_pair_corr(F.col(a).cast("double"), F.col(b).cast("double")), 6).alias(f"p{i}")
            for i, (a, b) in enumerate(upper)]
    aggs += [F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    cells = []
    for i, (a, b) in enumerate(upper):
        cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"p{i}").alias("corr")))
        cells.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"p{i}").alias("corr")))
    for i, c in enumerate(cols):
        diag = F.when(F.col(f"s{i}") > 0, F.lit(1.0))
        cells.append(F.struct(F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), diag.alias("corr")))
    return wide.select(F.explode(F.array(*cells)).alias("s")).select("s.*")


def missing_mechanism(df: DataFrame, cols: Sequence[str], label_col: str | None = None,
                      threshold: float = 0.3) -> DataFrame:
    """Classify each column with missing values as MCAR / MAR (A9); the label is MNAR.

    A column is MAR when its null indicator correlates (|r| > threshold) with
    any other numeric column, pairwise complete.  One aggregation pass.
    """
    cols = list(cols)
    aggs = []
    for c in cols:
        aggs.append(F.sum(F.col(c).isNull().cast("long")).alias(f"n__{c}"))
        ind = F.col(c).isNull().cast("double")
        for o in cols:
            if o != c:
                aggs.append(F.abs(_pair_corr(F.col(o).cast("double"), ind)).alias(f"r__{c}__{o}"))
    if label_col:
        aggs.append(F.sum(F.col(label_col).isNull().cast("long")).alias(f"n__{label_col}"))
    wide = df.agg(*aggs)
    rows = []
    for c in cols:
        others = [F.coalesce(F.col(f"r__{c}__{o}"), F.lit(0.0)) for o in cols if o != c]
        mx = F.greatest(F.lit(0.0), *others) if others else F.lit(0.0)
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.col(f"n__{c}").alias("n_missing"),
            rnd(mx, 6).alias("max_abs_corr"),
            F.when(mx > threshold, "MAR").otherwise("MCAR").alias("mechanism")))
    if label_col:
        rows.append(F.struct(
            F.lit(label_col).alias("column_name"), F.col(f"n__{label_col}").alias("n_missing"),
            F.lit(None).cast("double").alias("max_abs_corr"), F.lit("MNAR").alias("mechanism")))
    out = wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    return out.where(F.col("n_missing") > 0)


def overview(df: DataFrame, label_col: str, source_col: str) -> DataFrame:
    """Dashboard tiles: rows, unlabelled rows, distinct sources (H1)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(label_col).isNull().cast("long")).alias("n_unlabelled"),
        F.count_distinct(F.col(source_col)).cast("long").alias("n_sources"),
    )


def project_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def corr_pairs(cols: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(cols, 2))
