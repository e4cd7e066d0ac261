"""Preparation operators: impute, clip, encode, scale, ratio, split
(SURVEY A4-A7, E1-E7, E12, P2-P9, W1, W2, U1).

Every operator is a fit/apply pair.  ``fit_*`` runs one aggregation and
returns a small, bounded set of statistics (medians, bounds, codes, means);
``apply_*`` inlines them as literals into column expressions, so applying is
a narrow projection fused into whole-stage codegen with no join and no
shuffle.  The same statistics serve batch tables and streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cribble.functions.positions import hash_positions
from cribble.functions.quantiles import exact_quantiles

MAX_LABELS = 1_000_000      # distinct labels a code table may hold on the driver
MAP_LITERAL_LABELS = 2_000  # above this, codes are applied by a broadcast join


# ---------------------------------------------------------------- filters

def filter_labelled(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull())


def filter_unlabelled(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNull())


def drop_null_subset(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(subset))


def fill_constant(df: DataFrame, mapping: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in mapping.items()})


# ---------------------------------------------------------------- medians / mode

def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    q = exact_quantiles(df, cols, [0.5])
    return {c: q[((), c, 0.5)] for c in cols}


def apply_fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None})


def fit_group_medians(df: DataFrame, cols: Sequence[str], by: str) -> dict[str, dict[str, float]]:
    """Median per (group, column) for a low-cardinality group column."""
    q = exact_quantiles(df, cols, [0.5], by=[by])
    out: dict[str, dict[str, float]] = {}
    for (g, c, _p), v in q.items():
        out.setdefault(g[0], {})[c] = v
    return out


def apply_group_fill(df: DataFrame, medians: dict[str, dict[str, float]], by: str) -> DataFrame:
    exprs = {}
    for c in {c for m in medians.values() for c in m}:
        fill = None
        for g, m in medians.items():
            if m.get(c) is None:
                continue
            cond = F.col(by).cast("string") == g
            fill = F.when(cond, F.lit(m[c])) if fill is None else fill.when(cond, F.lit(m[c]))
        exprs[c] = F.coalesce(F.col(c), fill) if fill is not None else F.col(c)
    return df.withColumns(exprs)


def fit_mode(df: DataFrame, col: str):
    """Most frequent non-null value; ties go to the smallest value (pandas ``mode()[0]``)."""
    row = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), F.asc(col)).limit(1).collect())
    return row[0][col] if row else None


def value_counts(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """Rows per non-null value of every category column, from one pass over the rows.

    One grouping over (column, value); at most ``MAX_LABELS`` values a column reach the driver, more raise.
    """
    kinds = {c: df.schema[c].dataType for c in cols}
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])
    counted = (df.select(F.inline(pairs)).where(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    rows = counted.limit(MAX_LABELS * len(cols) + 1).collect()
    out: dict[str, dict] = {c: {} for c in cols}
    for r in rows:
        kind = kinds[r["c"]].typeName()
        v = r["v"] if kind == "string" else int(r["v"]) if kind in ("integer", "long", "short", "byte") else float(r["v"])
        out[r["c"]][v] = r["n"]
    if any(len(v) > MAX_LABELS for v in out.values()) or len(rows) > MAX_LABELS * len(cols):
        raise ValueError(f"a category column has more than {MAX_LABELS} distinct values")
    return out


def mode_of(counts: dict):
    """Most frequent value; ties go to the smallest (pandas ``mode()[0]``); None without values."""
    return min(counts, key=lambda v: (-counts[v], v)) if counts else None


# ---------------------------------------------------------------- IQR clip

@dataclass
class Bounds:
    q1: float
    q3: float
    lo: float
    hi: float


def fit_iqr(df: DataFrame, cols: Sequence[str], factor: float = 1.5) -> dict[str, Bounds | None]:
    q = exact_quantiles(df, cols, [0.25, 0.75])
    out: dict[str, Bounds | None] = {}
    for c in cols:
        q1, q3 = q[((), c, 0.25)], q[((), c, 0.75)]
        if q1 is None:
            out[c] = None
            continue
        iqr = q3 - q1
        out[c] = Bounds(q1, q3, q1 - factor * iqr, q3 + factor * iqr)
    return out


def outlier_counts(df: DataFrame, bounds: dict[str, Bounds | None]) -> DataFrame:
    cols = [c for c, b in bounds.items() if b is not None]
    wide = df.agg(*[
        F.sum(((F.col(c) < bounds[c].lo) | (F.col(c) > bounds[c].hi)).cast("long")).alias(c)
        for c in cols])
    return wide.unpivot([], cols, "column_name", "n_outliers").select(
        "column_name", F.coalesce(F.col("n_outliers"), F.lit(0)).cast("long").alias("n_outliers"))


def apply_clip(df: DataFrame, bounds: dict[str, Bounds | None]) -> DataFrame:
    """Clip into [lo, hi]; NULL stays NULL (``least``/``greatest`` would skip it)."""
    return df.withColumns({
        c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(b.lo)), F.lit(b.hi)))
        for c, b in bounds.items() if b is not None})


# ---------------------------------------------------------------- encoding

def fit_codes(df: DataFrame, col: str, null_as: str | None = None) -> list:
    """Sorted distinct values -> code = list index (alphabetical, as a label encoder).

    With ``null_as`` nulls are encoded as that value; otherwise they are not coded.
    The table size is checked before anything reaches the driver.
    """
    c = F.coalesce(F.col(col), F.lit(null_as)) if null_as is not None else F.col(col)
    distinct = df.select(c.alias("v")).where(F.col("v").isNotNull()).distinct()
    rows = distinct.limit(MAX_LABELS + 1).collect()  # bounded fetch; one job
    if len(rows) > MAX_LABELS:
        raise ValueError(f"{col} has more than {MAX_LABELS} distinct values; too many for a code table")
    return sorted(r["v"] for r in rows)


def apply_codes(df: DataFrame, col: str, codes: list, out: str, null_as: str | None = None,
                unseen: int | None = None) -> DataFrame:
    """Map values to codes; null stays null unless ``null_as``; unseen -> ``unseen``."""
    src = F.coalesce(F.col(col), F.lit(null_as)) if null_as is not None else F.col(col)
    if len(codes) <= MAP_LITERAL_LABELS:
        parts = []
        for i, v in enumerate(codes):
            parts += [F.lit(v), F.lit(i)]
        m = F.create_map(*parts) if parts else F.create_map().cast("map<string,int>")
        code = F.when(src.isNotNull(), F.try_element_at(m, src))
        if unseen is not None:
            code = F.when(src.isNotNull(), F.coalesce(code, F.lit(unseen)))
        return df.withColumn(out, code.cast("int"))
    spark = df.sparkSession
    table = spark.createDataFrame([(v, i) for i, v in enumerate(codes)], f"_v string, {out} int")
    joined = df.withColumn("_v", src.cast("string")).join(F.broadcast(table), "_v", "left").drop("_v")
    if unseen is not None:
        joined = joined.withColumn(out, F.when(src.isNotNull(), F.coalesce(F.col(out), F.lit(unseen))))
    return joined


def decode(df: DataFrame, code_col: str, codes: list, out: str) -> DataFrame:
    """Inverse of ``apply_codes``."""
    arr = F.array(*[F.lit(v) for v in codes])
    return df.withColumn(out, F.when(F.col(code_col).between(0, len(codes) - 1),
                                     F.element_at(arr, F.col(code_col).cast("int") + 1)))


# ---------------------------------------------------------------- scaling

@dataclass
class Scale:
    mean: float
    std: float


def fit_scale(df: DataFrame, cols: Sequence[str]) -> dict[str, Scale]:
    """Mean and population std (ddof=0) per column, one pass; std 0 -> 1."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                 *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).collect()[0]
    out = {}
    for c in cols:
        s = row[f"s_{c}"]
        out[c] = Scale(row[f"m_{c}"], 1.0 if not s else s)
    return out


def apply_scale(df: DataFrame, scales: dict[str, Scale], suffix: str = "") -> DataFrame:
    return df.withColumns({
        f"{c}{suffix}": (F.col(c) - F.lit(s.mean)) / F.lit(s.std) for c, s in scales.items()})


# ---------------------------------------------------------------- ratio features

def ratio(num: str, den: str, eps: float = 1e-6, zero_to_null: bool = True) -> F.Column:
    d = F.nullif(F.col(den), F.lit(0.0)) if zero_to_null else F.col(den)
    return F.col(num) / (d + F.lit(eps))


# ---------------------------------------------------------------- split / folds

def _class_counts(df: DataFrame, label: str) -> dict:
    rows = (df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
            .limit(MAX_LABELS + 1).collect())  # bounded fetch
    if len(rows) > MAX_LABELS:
        raise ValueError("too many classes to stratify")
    return {r[label]: r["n"] for r in rows}


def _count_lookup(counts: dict, label: str) -> F.Column:
    parts = []
    for k, n in counts.items():
        parts += [F.lit(k), F.lit(int(n)).cast("long")]  # multiplied by basis points: no int holds it
    return F.try_element_at(F.create_map(*parts), F.col(label)) if parts else F.lit(None).cast("long")


def stratified_split(df: DataFrame, label: str, key: str,
                     fractions: Sequence[float] = (0.70, 0.15, 0.15),
                     names: Sequence[str] = ("train", "val", "test"),
                     unlabelled_to: str = "train", out: str = "split", counts: dict | None = None) -> DataFrame:
    """Repeatable stratified split with exact per-class sizes.

    Rows of a class are ordered by ``md5(key)``; the first ``floor(f1*n)`` go to
    the first split, and so on (integer arithmetic, the same in any engine).
    Unlabelled rows go to ``unlabelled_to``.  Positions come from
    ``hash_positions``, so a dominant class is spread over many tasks.  ``counts`` (rows per
    class) saves a job where they are known.
    """
    counts = _class_counts(df, label) if counts is None else counts
    n_rows = sum(counts.values())
    bp = [round(f * 10000) for f in fractions]
    cum = [sum(bp[: i + 1]) for i in range(len(bp))]
    lab = df.where(F.col(label).isNotNull()).withColumn("_h", F.md5(F.col(key).cast("string")))
    pos = hash_positions(lab, [label], "_h", n_rows)
    n_c = _count_lookup(counts, label)
    choice = None
    for name, c in zip(names[:-1], cum[:-1]):
        cond = F.col("_pos") * 10000 <= n_c * c
        choice = F.when(cond, F.lit(name)) if choice is None else choice.when(cond, F.lit(name))
    choice = choice.otherwise(F.lit(names[-1])) if choice is not None else F.lit(names[-1])
    labelled = pos.withColumn(out, choice).drop("_h", "_pos")
    unlabelled = df.where(F.col(label).isNull()).withColumn(out, F.lit(unlabelled_to))
    return labelled.unionByName(unlabelled)


def fold_assign(df: DataFrame, label: str | None, key: str, k: int, out: str = "fold") -> DataFrame:
    """Stratified k-fold ids: position within the class (md5 order) modulo k.

    With ``label=None`` this is a plain k-fold over all rows.
    """
    if label is None:
        base = df.withColumn("_all", F.lit(1))
        grp = "_all"
    else:
        base = df.where(F.col(label).isNotNull())
        grp = label
    n_rows = base.count()
    h = base.withColumn("_h", F.md5(F.col(key).cast("string")))
    pos = hash_positions(h, [grp], "_h", n_rows)
    res = pos.withColumn(out, ((F.col("_pos") - 1) % k).cast("int")).drop("_h", "_pos")
    return res.drop("_all") if label is None else res


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Append tables whose columns differ; missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


@dataclass
class Fitted:
    """Statistics of a fitted preparation, all driver-sized."""
    imputer: str = "median"
    chained: object = None
    medians: dict = field(default_factory=dict)
    source_mode: object = None
    bounds: dict = field(default_factory=dict)
    source_codes: list = field(default_factory=list)
    label_codes: list = field(default_factory=list)
    density_median: float | None = None
    scales: dict = field(default_factory=dict)


# ---------------------------------------------------------------- cell mask, imputation error

def mask_threshold_hex(fraction: float) -> str:
    """Hash prefix below which a cell is masked: 8 hex digits compare like numbers."""
    return format(int(fraction * 16 ** 8), "08x")


def mask_flag(key: str, col: str, fraction: float = 0.10) -> F.Column:
    """Repeatable Bernoulli(fraction) cell mask from md5(key|column), independent of partitioning."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{col}")))
    return F.substring(h, 1, 8) < F.lit(mask_threshold_hex(fraction))


def mask_cells(df: DataFrame, key: str, cols: Sequence[str], fraction: float = 0.10) -> DataFrame:
    """Set ~fraction of the cells of ``cols`` to NULL; ``m_<col>`` flags the masked cells."""
    flags = {f"m_{c}": mask_flag(key, c, fraction) & F.col(c).isNotNull() for c in cols}
    out = df.withColumns(flags)
    return out.withColumns({c: F.when(F.col(f"m_{c}"), F.lit(None).cast("double")).otherwise(F.col(c))
                            for c in cols})


def masked_rmse(imputed: DataFrame, cols: Sequence[str]) -> DataFrame:
    """RMSE over the masked cells of all columns together (unscaled, as published).

    ``imputed`` holds the truth as ``t_<col>`` and the flags ``m_<col>`` beside the imputed cells: one pass, no join.
    """
    err = {c: F.when(F.col(f"m_{c}"), F.col(c) - F.col(f"t_{c}")) for c in cols}
    total = sum((F.coalesce(F.sum(e * e), F.lit(0.0)) for e in err.values()), F.lit(0.0))
    n = sum((F.count(e) for e in err.values()), F.lit(0))
    return imputed.agg(total.alias("sse"), n.alias("n_masked")).select(
        F.sqrt(F.col("sse") / F.nullif(F.col("n_masked"), F.lit(0))).alias("rmse"), "n_masked")
