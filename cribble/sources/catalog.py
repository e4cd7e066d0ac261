"""Typed access to the driver tables and the derived views of SURVEY 5.1.

Every table is read with an explicit schema so that no job is spent on
inference and Catalyst prunes columns down to the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS: dict[str, T.StructType] = {
    "region": T.StructType([
        T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType())]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType())]),
    "supplier": T.StructType([
        T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())]),
    "part": T.StructType([
        T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType())]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType())]),
    "lineitem": T.StructType([
        T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType())]),
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]),
    "documents": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType())]),
    "embeddings": T.StructType([
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType())]),
    "pages": T.StructType([
        T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType())]),
    "benchmark": T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]),
    "labels": T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
        T.StructField("toxic", T.IntegerType())]),
    "conversations": T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]),
}

# Numeric feature columns of the ``items`` view (stand-ins for weight, volume,
# conductivity, opacity, rigidity) and its regression target.
ITEM_FEATURES = ["w", "v", "c", "o", "r"]
ITEM_TARGET = "price"
ITEM_LABEL = "cat"
ITEM_SOURCE = "src"
ITEM_KEY = "item_id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy row work (regex cleaning of whole texts) at least one partition per core.

    A file with few row groups scans into few tasks; when that is fewer than
    the cluster's default parallelism the rows are round-robin repartitioned
    (one cheap shuffle).  On a large input the scan already has more splits
    than cores and this is a no-op.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def right_size(df: DataFrame, n_rows: int, rows_per_partition: int = 500_000) -> DataFrame:
    """Partition count for iterative work (every optimiser step touches every partition):
    max(cores, rows / rows_per_partition).  Only ever reduces, and without a shuffle."""
    import math
    target = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows / rows_per_partition))
    return df.coalesce(target) if df.rdd.getNumPartitions() > target else df


def line_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line aggregates (rounded to fixed digits: summation-order independent)."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("w"),
            F.round(F.sum("l_extendedprice"), 2).alias("v"),
            F.round(F.avg("l_discount"), 6).alias("c"),
            F.round(F.avg("l_tax"), 6).alias("o"),
            F.count(F.lit(1)).cast("double").alias("r"),
        )
    )


def item_rows(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """orders (batch or stream) left-joined to line aggregates, with the null rules."""
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    key = F.col("o_orderkey")
    return joined.select(
        key.alias(ITEM_KEY),
        F.when(key % 10 == 3, F.lit(None).cast("double")).otherwise(F.col("w")).alias("w"),
        "v", "c", "o", "r",
        F.col("o_totalprice").alias(ITEM_TARGET),
        F.when(key % 20 == 7, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias(ITEM_LABEL),
        F.when(key % 4 == 1, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")).alias(ITEM_SOURCE),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed item table: one row per order with per-order line aggregates.

    The left join leaves natural nulls (orders without lines); three key
    rules add missing values to a feature, the label and the source so
    that every null-handling operator has work to do.  Sums are rounded to
    fixed digits so the result does not depend on summation order.
    """
    return item_rows(table(spark, sf_dir, "orders"), line_aggregates(spark, sf_dir))


# DuckDB twin of ``items`` for oracle SQL (same rules, same rounding).
ITEMS_SQL = """
items AS (
  SELECT o.o_orderkey AS item_id,
         CASE WHEN o.o_orderkey % 10 = 3 THEN NULL ELSE li.w END AS w,
         li.v, li.c, li.o, li.r,
         o.o_totalprice AS price,
         CASE WHEN o.o_orderkey % 20 = 7 THEN NULL ELSE o.o_orderpriority END AS cat,
         CASE WHEN o.o_orderkey % 4 = 1 THEN NULL ELSE o.o_orderstatus END AS src
  FROM orders o LEFT JOIN (
    SELECT l_orderkey,
           round(sum(l_quantity), 2) AS w,
           round(sum(l_extendedprice), 2) AS v,
           round(avg(l_discount), 6) AS c,
           round(avg(l_tax), 6) AS o,
           CAST(count(*) AS DOUBLE) AS r
    FROM lineitem GROUP BY l_orderkey) li
  ON o.o_orderkey = li.l_orderkey
)"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their optional quality label (left join, label may be null)."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left")
