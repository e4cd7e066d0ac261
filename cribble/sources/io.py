"""Sources and sinks.

Files go to paths the caller names; helpers that need scratch space take it
under the session's shared checkpoint folder, never a machine-local one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cribble.session import ensure_checkpoint_dir

# -- fixed values: cell texts that pandas' CSV reader treats as missing.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------- scans

def read_csv_table(spark: SparkSession, path: str, schema: T.StructType,
                   null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """CSV with header, quoted multi-line cells and doubled quotes (T1); every cell is
    read as text, the pandas null tokens become NULL and values are cast with
    ``try_cast`` so a bad cell is NULL, not a failed job (T2, T29)."""
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (spark.read.schema(text_schema).option("header", True).option("multiLine", True)
           .option("escape", '"').option("quote", '"').option("mode", "PERMISSIVE").csv(path))
    tokens = F.array(*[F.lit(t) for t in null_tokens])
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        c = F.when(c.isNull() | F.array_contains(tokens, F.trim(c)), F.lit(None)).otherwise(c)
        if not isinstance(f.dataType, T.StringType):
            c = F.try_cast(c, f.dataType) if hasattr(F, "try_cast") else c.try_cast(f.dataType)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                c = F.nanvl(c, F.lit(None).cast(f.dataType))
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def _on_fs(spark: SparkSession, path: str) -> tuple:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _on_fs(spark, path)
    return fs.exists(p)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _on_fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
                  **options) -> DataFrame | None:
    """Lenient scan: a missing path gives None instead of an error (S3)."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


# ---------------------------------------------------------------- sinks

def write_splits(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> None:
    """Split sink partitioned by split, so readers prune to one split."""
    df.write.mode("overwrite").partitionBy(split_col).format(fmt).save(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Results / features / projection sinks (S6-S8, S13 with fmt='csv')."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    w.save(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """One-row metrics record as JSON (S5, S12); the frame is an aggregate, so one file."""
    df.coalesce(1).write.mode("overwrite").json(path)


EXPERIMENT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("experiment", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("ts", T.TimestampType())])


def log_run(spark: SparkSession, path: str, experiment: str, run_name: str, params: dict,
            metrics: dict) -> str:
    """Append one run to the experiment log table."""
    run_id = uuid.uuid4().hex
    row = [(run_id, experiment, run_name, {k: json.dumps(v) if not isinstance(v, str) else v
                                           for k, v in params.items()},
            {k: float(v) for k, v in metrics.items()}, datetime.now(timezone.utc).replace(tzinfo=None))]
    spark.createDataFrame(row, EXPERIMENT_SCHEMA).write.mode("append").parquet(path)
    return run_id


REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.IntegerType()),
    T.StructField("path", T.StringType()), T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("ts", T.TimestampType())])


def register_model(spark: SparkSession, registry_path: str, name: str, model_path: str, metrics: dict) -> int:
    """Registry entry with version = max(version) + 1 for the name."""
    current = read_optional(spark, registry_path, schema=REGISTRY_SCHEMA)
    version = 1
    if current is not None:
        row = current.where(F.col("name") == name).agg(F.max("version").alias("v")).collect()[0]
        version = (row["v"] or 0) + 1
    row = [(name, version, model_path, {k: float(v) for k, v in metrics.items()},
            datetime.now(timezone.utc).replace(tzinfo=None))]
    spark.createDataFrame(row, REGISTRY_SCHEMA).write.mode("append").parquet(registry_path)
    return version
