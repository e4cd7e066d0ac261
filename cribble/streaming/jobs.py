"""Structured Streaming re-aims of the request-at-a-time features.

The reference scores one HTTP request at a time; the Spark form is a stream
of requests: validation + scoring per micro-batch, windowed counts with a
watermark (late rows are dropped by the watermark, state is bounded by it),
and a de-duplicated prediction log.  Every job writes idempotently: each
micro-batch overwrites its own ``batch=<id>`` folder, so a retried batch
after an executor loss does not duplicate rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cribble.sources.io import is_folder, scratch_path


def file_stream(spark: SparkSession, folder: str, file_glob: str, schema: T.StructType,
                max_files: int | None = None) -> DataFrame:
    """Parquet file stream with an explicit schema (no inference on streams).  ``max_files`` bounds a micro-batch;
    without it a batch takes all files that are there.  Where ``file_glob`` names a folder (a table that Spark wrote),
    the files in it are streamed."""
    reader = spark.readStream.schema(schema)
    reader = reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)
    inner = f"{folder.rstrip('/')}/{file_glob}"
    if is_folder(spark, inner):
        return reader.parquet(inner)
    return reader.option("pathGlobFilter", file_glob).parquet(folder)


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], name: str) -> str:
    """Drive a stream to completion with ``availableNow`` through ``foreachBatch``."""
    spark = stream.sparkSession
    ckpt = scratch_path(spark, f"{name}-ckpt")
    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return ckpt


def batch_writer(out: str, transform: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    def handle(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return handle


def windowed_counts(stream: DataFrame, ts: str, window: str = "1 day", delay: str = "1 hour",
                    keys: tuple[str, ...] = ("event_type",), value: str = "value") -> DataFrame:
    """Tumbling-window counts and sums per key with a watermark (R2).

    ``timestamp_ntz`` is cast to ``timestamp`` first (watermarks reject ntz, T22).
    """
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return s.groupBy(F.window(ts, window).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total_value"))


def dedupe_log(stream: DataFrame, key: str, ts: str, delay: str = "1 day") -> DataFrame:
    """Prediction log without duplicate ids inside the watermark."""
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return s.dropDuplicatesWithinWatermark([key])
