"""Request validation and quarantine, usable on tables and streams.

Every rule is a column predicate; a row's failures are collected into a
sorted, comma-joined reason string, so valid and quarantined rows come
from one narrow projection and split with two filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cribble.functions import fixed


def reasons(ranges=fixed.REQUEST_RANGES, text_col: str | None = "rapport_collecte",
            min_len: int = fixed.MIN_TEXT_LENGTH) -> Column:
    checks = []
    for col, lo, hi in ranges:
        c = F.col(col)
        rule = F.when(c.isNull() | F.isnan(c), F.lit(f"{col}:required"))
        if lo is not None:
            rule = rule.when(c < F.lit(lo), F.lit(f"{col}:min"))
        if hi is not None:
            rule = rule.when(c > F.lit(hi), F.lit(f"{col}:max"))
        checks.append(rule)
    if text_col:
        t = F.col(text_col)
        checks.append(F.when(t.isNull(), F.lit(f"{text_col}:required"))
                      .when(F.length(t) < F.lit(min_len), F.lit(f"{text_col}:min_length")))
    arr = F.filter(F.array(*checks), lambda x: x.isNotNull())
    return F.array_join(F.array_sort(arr), ",")


def validate(df: DataFrame, source_col: str = "source", **kw) -> DataFrame:
    """Adds ``reasons`` ('' when valid), ``valid`` and the defaulted source."""
    out = df.withColumn("reasons", reasons(**kw)).withColumn("valid", F.col("reasons") == F.lit(""))
    if source_col in df.columns:
        out = out.withColumn(source_col, F.coalesce(F.col(source_col), F.lit("Unknown")))
    return out


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("valid")), df.where(~F.col("valid"))
