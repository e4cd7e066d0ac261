"""Fuzzy line dedup: MinHash over character shingles, banding, exact Jaccard, union-find.

Equal lines are one class by their hash.  Classes that agree in all rows of a signature
band are candidates; candidates are verified by the exact Jaccard similarity of their
shingle sets; connected components of the links are duplicate groups, and the earliest
line of each group stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cribble.llm.common import MIX1, MUL, U, connected_components, kept, mix, ranges, slices, sorted_set, stage, text_buffers
from cribble.llm.jaccard import link_tiles, member_columns, semi, shared_tiles


def char_shingles(raw: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all character k-grams, number per row); a row of fewer characters is one shingle."""
    begins = (raw & 0xC0) != 0x80
    chars = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.concatenate(([0], np.cumsum(begins)))[offs]
    size = np.diff(at)
    pad = k - 1  # zeros after every row keep shingles inside it
    row = np.repeat(np.arange(len(size)), size)
    spaced = np.zeros(len(chars) + pad * (len(size) + 1), np.uint32)
    spaced[np.arange(len(chars)) + row * pad] = chars
    m = len(spaced) - pad
    h = np.zeros(m, U)
    for i in range(k):
        h *= MUL
        h += spaced[i:i + m]
    count = np.where(size > 0, np.maximum(size - pad, 1), 0)
    return mix(h[ranges(at[:-1] + np.arange(len(size)) * pad, count)]), count


def band_keys(hashes: np.ndarray, count: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """MinHash signatures (bands x rows permutations) folded to one 64-bit key per band."""
    odd = np.random.default_rng(seed).integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    small = (hashes >> U(32)).astype(np.uint32)
    first = np.cumsum(count) - count
    keys = np.zeros((len(count), bands), U)
    turned = np.empty_like(small)
    for b in range(bands):
        for r in range(rows):
            low = np.minimum.reduceat(np.multiply(small, odd[b * rows + r], out=turned), first)
            keys[:, b] = keys[:, b] * MUL + low
    return mix(keys + np.arange(bands, dtype=U) * MIX1)


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, no, line, lid): the lines that hold more than white space, stripped.

    ``lid`` is the 64-bit hash of the stripped line and stands for it from here on."""
    lines = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("no", "line"))
    return (lines.withColumn("line", F.btrim("line", F.lit(" \t\r\f\x0b"))).where("line != ''")
            .withColumn("lid", F.xxhash64("line")))


def line_components(docs: DataFrame, shingle: int = 8, num: int = 8, den: int = 10, bands: int = 10, rows: int = 4,
                    seed: int = 7) -> DataFrame:
    """(lid, component) of every line that links to a different line."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "line", 1 << 18):
            first = np.unique(batch.column("lid").to_numpy(), return_index=True)[1]  # copies sign once
            batch = batch.take(pa.array(np.sort(first)))
            hashes, count = char_shingles(*text_buffers(batch.column("line")), shingle)
            keys = band_keys(hashes, count, bands, rows, seed)
            flat = pa.array(keys.reshape(-1).view(np.int64))
            offsets = pa.array(np.arange(len(count) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays([batch.column("lid"), pa.ListArray.from_arrays(offsets, flat)],
                                             names=["rep", "keys"])

    def decode(column: pa.Array) -> list[np.ndarray]:
        hashes, count = char_shingles(*text_buffers(column), shingle)
        ends = np.cumsum(count)
        return [sorted_set(hashes[e - c:e]) for e, c in zip(ends.tolist(), count.tolist())]

    def payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "line", 1 << 18):
            n, bits, _ = member_columns(decode(batch.column("line")))
            # the line itself stands for its set: a byte a character instead of eight a shingle
            yield pa.RecordBatch.from_arrays([batch.column("lid"), n, bits, batch.column("line").cast(pa.binary())],
                                             names=["rep", "n", "bits", "set"])

    lines = line_rows(docs)
    signed = lines.select("lid", "line").mapInArrow(sign, "rep long, keys array<long>")
    held = shared_tiles(signed, "line-tiles")  # copies of a line are no second member
    wanted = stage(held.select(F.col("rep").alias("lid")).distinct(), "line-members")
    sets = stage(semi(lines.select("lid", "line"), wanted, "lid").dropDuplicates(["lid"])
                 .mapInArrow(payload, "rep long, n long, bits binary, set binary"), "line-sets")
    links = link_tiles(held, sets, num, den, decode=decode, draws=16, carry=True)
    return connected_components(links, "a", "b").select(F.col("node").alias("lid"), "component")


def dedup_lines(docs: DataFrame, shingle: int = 8, similarity: tuple[int, int] = (8, 10), bands: int = 10,
                rows: int = 4) -> DataFrame:
    """``docs`` with duplicate lines taken out of ``text``, plus n_lines and removed (their numbers).

    Lines are what lies between line feeds, compared without white space at their ends,
    in sets of ``shingle``-character grams at a Jaccard similarity of 0.8 or more.  The
    first line of a component, by doc_id, hash of the text and line number, stays, in its
    place; lines of white space alone always stay.  A line shorter than a shingle is one
    shingle.  Null text stays null with no lines, empty text has none; a null doc_id comes
    first; repeated rows (same doc_id and text) are one document and get one verdict; a
    document may lose all lines and keeps an empty text; columns named n_lines or
    removed are replaced, others pass through; no rows give no rows.  A pair at exactly
    0.8 meets in a band with probability 1 - (1 - 0.8**rows)**bands (0.995 here, over
    0.9999 from 0.87 on); bands, partners and groups have no cap.
    """
    component = line_components(docs, shingle, *similarity, bands, rows)
    seen = stage(line_rows(docs).select("doc_id", "text_key", "no", "lid"), "line-places")
    here = F.struct("doc_id", "text_key", "no")
    firsts = stage(seen.groupBy("lid").agg(F.min(here).alias("first"), F.count("*").alias("times"))
                   .join(component, "lid", "left")
                   .select("lid", "first", "times", F.coalesce("component", "lid").alias("c")), "line-firsts")
    keepers = firsts.groupBy("c").agg(F.min("first").alias("keep"), F.sum("times").alias("all")).where("`all` > 1")
    doomed = firsts.join(keepers.drop("all"), "c").select("lid", "keep")
    gone = (seen.join(doomed, "lid").where(~here.eqNullSafe(F.col("keep")))
            .groupBy("doc_id", "text_key").agg(F.collect_set("no").alias("gone"))
            .select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.array_sort("gone").alias("gone")))
    results = ("n_lines", "removed")
    base = docs.select(kept(docs, "text", *results).alias("row"), F.col("doc_id").alias("id"), "text",
                       F.xxhash64("text").alias("key"))
    joined = base.join(gone, F.col("id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("t")), "left")
    parts = F.split("text", "\n")
    left = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    count = F.size(F.filter(parts, lambda x: F.btrim(x, F.lit(" \t\r\f\x0b")) != ""))
    told = joined.select("row", F.coalesce(F.when(F.col("text").isNotNull(), count), F.lit(0)).alias("n_lines"),
                         F.coalesce("gone", F.array().cast("array<int>")).alias("removed"),
                         F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"))
    names = [c for c in docs.columns if c.lower() not in results]
    return told.select(*[F.col("text").alias(c) if c.lower() == "text" else F.col(f"row.`{c}`").alias(c) for c in names], *results)
