"""Writing with measures taken on the way, published only behind a gate.

The measures are aggregated while the rows are written, so a profile of the load needs no second scan.  Rows go to a
folder of their own first; the gate sees the measures and either raises, leaving nothing published, or the folder is
renamed to its place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cribble.sources.io import path_exists, scratch_path


class GateError(RuntimeError):
    """A published result would break its gate."""


def load_profile(df: DataFrame) -> dict[str, Column]:
    """Rows, and the nulls of every column, as measures of a write."""
    return {"n_rows": F.count(F.lit(1)), **{f"null_{c}": F.sum(F.col(f"`{c}`").isNull().cast("long")) for c in df.columns}}


def write_gated(df: DataFrame, path: str, measures: dict[str, Column], gate: Callable[[dict], bool] | None = None,
                mode: str = "error") -> dict:
    """Write ``df`` to ``path`` and return the measures; a gate that is not met raises and publishes nothing.

    ``mode``: error, where ``path`` must be new, or keep, where an earlier result stays (its measures are not taken).
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        if mode == "keep":
            return {}
        raise FileExistsError(path)
    staged, seen = scratch_path(spark, "staged"), Observation("measures")
    df.observe(seen, *[c.alias(n) for n, c in measures.items()]).write.parquet(staged)
    got = seen.get
    if gate is not None and not gate(got):
        raise GateError(f"gate not met: {got}")
    _rename(spark, staged, path)
    return got


def _rename(spark: SparkSession, source: str, target: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = b.getFileSystem(conf)
    if b.getParent() is not None:
        fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot publish {target}")


def assert_at_least(df: DataFrame, column: str, minimum: float) -> DataFrame:
    """``df`` whose job aborts as soon as a row has ``column`` below ``minimum``, or null."""
    low = F.concat(F.lit(f"{column} below {minimum}: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    checked = F.when(F.col(column) >= F.lit(minimum), F.col(column)).otherwise(F.raise_error(low).cast("double"))
    return df.withColumn(column, checked)


def content_name(*parts: str) -> str:
    """The same name for the same inputs, so that a repeated job finds its document written."""
    return hashlib.sha256("\x00".join(parts).encode()).hexdigest()[:16]
