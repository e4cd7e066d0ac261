"""Corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
but for the last returns the columns of ``documents``.  Null and empty texts, repeated
rows, empty tables and extra columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cribble.llm import decontaminate, jaccard, lines, packing, quality
from cribble.llm.common import given_back, kept, read_table, stage


def _apart(docs: DataFrame) -> DataFrame:
    """doc_id, text and all columns in one struct, so that an operator's results replace none of them."""
    return docs.select("doc_id", "text", kept(docs).alias("document"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (2): documents scored under 0.7 go."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = quality.fit(docs.where(~held_out), read_table(spark, sf_dir, "labels"), "doc_id", "quality")
    return quality.score(_apart(docs), model).where("predicted = 1").select(*given_back(docs, "document"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (1): later near copies of a line leave the text; every document stays.  n_chars follows the text."""
    out = lines.dedup_lines(_apart(docs))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"document.`{c}`").alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """n-gram Jaccard join (6), five words and 0.8: of each group the smallest doc_id stays, once.
    Documents without a doc_id are in no group and stay; different texts under one doc_id are
    documents of their own."""
    groups = jaccard.similarity_groups(docs, n=5, num=8, den=10).where("doc_id is not null")
    first = (groups.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "text_hash")).alias("f"))
             .select("f.doc_id", "f.text_hash"))
    keep = first.unionByName(groups.where("group is null").select("doc_id", "text_hash")).distinct()
    named = (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), kept(docs).alias("document"))
             .join(keep, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
             .select(*given_back(docs, "document")))
    return named.unionByName(docs.where("doc_id is null")).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (10): documents with five in a hundred words or more inside benchmark
    windows go."""
    return (decontaminate.judge(_apart(docs), read_table(spark, sf_dir, "benchmark"))
            .where(~F.col("contaminated")).select(*given_back(docs, "document")))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (7): the pieces of every remaining document with their token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("quality classifier", keep_quality), ("line dedup", dedup_lines),
          ("n-gram jaccard join", drop_near_copies), ("benchmark decontamination", drop_contaminated),
          ("packing", pack_documents)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each result is written once and reread by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, fn) in enumerate(STAGES):
        docs = fn(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, "pipeline")
    return docs
