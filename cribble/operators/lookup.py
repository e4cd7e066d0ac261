"""Dictionary lookup inside token arrays (N1e): a user's lemma table applied to every token.

A table of a checked size goes to all tasks as two Arrow arrays and tokens are replaced inside their array; a
larger one is joined: tokens become rows, meet the table by shuffle and are put back in order.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lookup(df: DataFrame, key: str, toks: str, table: DataFrame, word: str = "word", lemma: str = "lemma", out: str = "lemmas",
           broadcast_rows: int = 500_000) -> DataFrame:
    """(key, ``out``): the tokens of every row with each word of ``table`` replaced by its lemma.

    ``key`` tells the rows apart.  Words without an entry, or with a null lemma, stay; of several lemmas of a word the smallest
    counts; a null array stays null; null tokens stay null.
    """
    known = table.where(F.col(word).isNotNull() & F.col(lemma).isNotNull()).groupBy(F.col(word).alias("w")).agg(
        F.min(lemma).alias("l"))
    rows = known.limit(broadcast_rows + 1).collect()  # at most this many rows, a word and its lemma each
    if len(rows) > broadcast_rows:
        return _joined(df, key, toks, known, out)
    sent = df.sparkSession.sparkContext.broadcast((pa.array([r["w"] for r in rows], pa.string()),
                                                   pa.array([r["l"] for r in rows], pa.string())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, lemmas = sent.value
        for b in batches:
            col = b.column(1)
            flat = col.flatten().cast(pa.string())
            at = pc.index_in(flat, words)
            new = pc.coalesce(lemmas.take(at), flat)
            size = pc.fill_null(pc.list_value_length(col), 0).to_numpy()
            offsets = pa.array([0, *size.cumsum().tolist()], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(offsets, new, mask=pc.is_null(col))], names=[key, out])

    return df.select(key, toks).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, `{out}` array<string>")


def _joined(df: DataFrame, key: str, toks: str, known: DataFrame, out: str) -> DataFrame:
    spots = df.select(F.col(key).alias("k"), F.posexplode(toks).alias("i", "w"))
    back = (spots.join(known, "w", "left").select("k", "i", F.coalesce("l", "w").alias("t"))
            .groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "t"))), lambda s: s["t"]).alias("t")))
    held = df.select(F.col(key), F.col(toks).alias("given"))
    return held.join(back, held[key].eqNullSafe(back["k"]), "left").select(
        key, F.when(F.col("given").isNull(), F.lit(None)).otherwise(F.coalesce("t", F.array().cast("array<string>"))).alias(out))
