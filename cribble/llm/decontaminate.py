"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

Every benchmark window of n words is the ordered set of its shingles.  Containment
asks for all of them, so one shingle is a necessary prefix; the rarest in the corpus
is taken.  Documents are joined on that shingle alone, the position of the shingle and
the document's length bound where the window may start, and the words themselves
verify the match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cribble.llm.common import given_back, kept, stage

# -- fixed values: the contract's word pattern and the letters that are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """Lower-cased words of a text; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower()),
                                F.lit(WORD), F.lit(0))


def _shingles(df: DataFrame, size: int, keep: list[str]) -> DataFrame:
    """One row per position: the ``size`` words from there, ``key`` their hash, ``pos`` from 0."""
    parts = F.arrays_zip(*[
        (F.col("words") if i == 0 else F.slice("words", i + 1, F.greatest(F.size("words") - i, F.lit(0))))
        .alias(f"w{i}") for i in range(size)])
    rows = df.where(F.size("words") >= size).select(*keep, F.posexplode(parts).alias("pos", "at"))
    return (rows.where(F.col(f"at.w{size - 1}").isNotNull())
            .select(*keep, "pos", F.xxhash64(F.lit(size), *[F.col(f"at.w{i}") for i in range(size)]).alias("key")))


def windows(items: DataFrame, window: int) -> DataFrame:
    """(win, item_words, n, item_ids): distinct windows of ``window`` item words, whole shorter items."""
    w = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - window, F.lit(0))
    cut = w.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, F.lit(window)))).alias("item_words"))
    return (cut.groupBy("item_words").agg(F.collect_set("item_id").alias("item_ids"))
            .select(F.xxhash64("item_words").alias("win"), "item_words",
                    F.size("item_words").alias("n"), "item_ids"))


def find_windows(docs: DataFrame, items: DataFrame, window: int = 13, shingle: int = 3,
                 broadcast_rows: int = 200_000) -> tuple[DataFrame, DataFrame]:
    """All occurrences of benchmark windows in documents.

    Returns (hits, windows): hits (doc_id, text_key, start, n, win) with ``text_key`` the
    hash of the text, so that rows sharing a doc_id stay apart; repeated rows count once.
    The shingle table of the benchmark is broadcast only while it has at most
    ``broadcast_rows`` rows of 16 bytes; beyond that the same join is shuffled.
    """
    wins = stage(windows(items, window), "windows")
    # shingles of a window: all of `shingle` words, or the whole of a shorter window
    sizes = [r[0] for r in wins.select(F.least("n", F.lit(shingle)).alias("s")).distinct().collect()]
    doc_words = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words"))
    found, parts = None, None
    for size in sorted(sizes):
        mine = wins.where(F.least("n", F.lit(shingle)) == size)
        w = mine.select("win", "n", F.col("item_words").alias("words"))
        part = _shingles(w, size, ["win", "n"]).withColumnRenamed("pos", "at_pos")
        parts = part if parts is None else parts.unionByName(part)
        s = _shingles(doc_words, size, ["doc_id", "text_key"])
        found = s if found is None else found.unionByName(s)
    if parts is None:
        empty = docs.select("doc_id", F.lit(0).cast("long").alias("text_key"), F.lit(0).alias("start"),
                            F.lit(0).alias("n"), F.lit(0).cast("long").alias("win")).where("false")
        return empty, wins
    parts = stage(parts, "window-shingles")
    keys = parts.select("key").distinct()
    small = keys.limit(broadcast_rows + 1).count() <= broadcast_rows
    hinted = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    # corpus occurrences of benchmark shingles: counts for the rarity order, positions for the join
    seen = stage(found.join(hinted(keys), "key"), "shingle-hits")
    freq = seen.groupBy("key").agg(F.count("*").alias("freq"))
    ranked = (parts.join(freq, "key")  # a window with an unseen shingle occurs nowhere
              .withColumn("r", F.row_number().over(Window.partitionBy("win").orderBy("freq", "key", "at_pos")))
              .withColumn("present", F.count("*").over(Window.partitionBy("win"))))
    full = F.col("n") - F.least("n", F.lit(shingle)) + 1
    prefix = ranked.where((F.col("r") == 1) & (F.col("present") == full)).select("win", "n", "at_pos", "key")
    cand = (seen.join(prefix, "key").where("pos >= at_pos")
            .select("doc_id", "text_key", (F.col("pos") - F.col("at_pos")).alias("start"), "n", "win").distinct())
    # every shingle of the window must stand at its place: shingles overlap, so together they are the words
    need = cand.join(parts.select("win", "at_pos", "key"), "win").select(
        "doc_id", "text_key", "start", "n", "win", (F.col("start") + F.col("at_pos")).alias("pos"), "key")
    at = seen.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("pos").alias("p"),
                     F.col("key").alias("k")).distinct()
    ok = (need.join(at, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))
                    & (F.col("pos") == F.col("p")) & (F.col("key") == F.col("k")))
          .groupBy("doc_id", "text_key", "start", "n", "win").agg(F.count("*").alias("got"))
          .where(F.col("got") == full).drop("got"))
    return stage(ok, "window-matches"), wins


def judge(docs: DataFrame, items: DataFrame, window: int = 13, parts: int = 20) -> DataFrame:
    """``docs`` rows with n_words, n_hit, items (ids of the items found) and contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated when
    ``parts * n_hit >= n_words`` and a word is hit.  Null and empty texts have no words
    and are clean; null doc_ids are kept and matched among themselves by text; repeated
    rows get the same verdict each; repeated items are reported once; an empty benchmark
    or empty ``docs`` finds nothing.  Columns of ``docs`` other than doc_id and text pass
    through unless they bear one of the four result names, which are replaced.
    """
    hits, wins = find_windows(docs, items, window)
    spans = hits.select("doc_id", "text_key", "start", (F.col("start") + F.col("n")).alias("stop")).distinct()
    order = Window.partitionBy("doc_id", "text_key").orderBy("start", "stop")
    before = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (spans.withColumn("before", before)
               .withColumn("new", F.greatest(F.col("stop") - F.greatest("start", "before"), F.lit(0)))
               .groupBy("doc_id", "text_key").agg(F.sum("new").alias("hit_words")))
    named = (hits.select("doc_id", "text_key", "win").distinct().join(wins.select("win", "item_ids"), "win")
             .select("doc_id", "text_key", F.explode("item_ids").alias("item_id")).distinct()
             .groupBy("doc_id", "text_key").agg(F.collect_set("item_id").alias("found_items")))
    per = (covered.join(named, covered.doc_id.eqNullSafe(named.doc_id) & (covered.text_key == named.text_key))
           .select(covered.doc_id.alias("d"), covered.text_key.alias("t"), "hit_words", "found_items"))
    results = ("n_words", "n_hit", "items", "contaminated")
    base = docs.select(kept(docs, *results).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"),
                       F.regexp_count(F.translate(F.coalesce("text", F.lit("")), UPPER, UPPER.lower()),
                                      F.lit(WORD)).cast("long").alias("n_words"))
    n_hit = F.coalesce("hit_words", F.lit(0)).cast("long")
    judged = (base.join(per, F.col("id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("t")), "left")
              .withColumn("n_hit", n_hit)
              .withColumn("items", F.coalesce("found_items", F.array().cast("array<long>")))
              .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * parts >= F.col("n_words"))))
    return judged.select(*given_back(docs, "row", *results), *results)
