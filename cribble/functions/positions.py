"""Row positions inside groups without a single-task window.

``row_number() over (partition by label order by h)`` sends a whole label to
one task; with one label holding a third of the rows that task is the job.
Here the order key is a uniform hex hash, so its leading hex digits split
every group into buckets of near-equal size: positions are numbered inside
(group, bucket) and shifted by the counts of the earlier buckets.  Both the
window and the offset join are keyed on (group, bucket), so Spark shuffles
the big side once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def bucket_digits(n_rows: int, rows_per_bucket: int = 200_000) -> int:
    if n_rows <= rows_per_bucket:
        return 1
    return max(1, min(8, math.ceil(math.log(n_rows / rows_per_bucket, 16))))


def hash_positions(df: DataFrame, group_cols: Sequence[str], hash_col: str, n_rows: int,
                   out_col: str = "_pos") -> DataFrame:
    """Add the 1-based position of each row within ``group_cols`` ordered by ``hash_col``.

    ``hash_col`` must be a lower-case hex string (md5/sha) that is unique per row.
    """
    group_cols = list(group_cols)
    d = bucket_digits(n_rows)
    b = F.conv(F.substring(F.col(hash_col), 1, d), 16, 10).cast("long")
    tagged = df.withColumn("_bkt", b)
    keys = group_cols + ["_bkt"]
    local = tagged.withColumn(
        "_lpos", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(hash_col))))
    counts = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*group_cols).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    offsets = offsets.select(*[F.col(k).alias(f"_o_{k}") for k in keys], "_off")
    cond = [local[k].eqNullSafe(offsets[f"_o_{k}"]) for k in keys]
    joined = local.join(offsets, cond, "inner")
    return joined.withColumn(out_col, (F.col("_off") + F.col("_lpos")).cast("long")).drop(
        "_bkt", "_lpos", "_off", *[f"_o_{k}" for k in keys])
