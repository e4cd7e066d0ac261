"""Exact n-gram Jaccard join over size-banded tiles with parity maps.

Sets whose Jaccard similarity reaches t have sizes within a factor t, so sizes fall into
bands of that ratio and only equal or adjacent bands can meet.  Within a pair of bands
two linked sets differ in at most D elements; cutting the hash range into so many segments that a
set has elements in more than D of them therefore leaves one with the same elements in both.  A tile holds the
sets that agree in one such segment of one band pair.  In a tile, the differing bits of hashed
parity maps bound the overlap from above, and the pairs that pass are settled by intersecting
the sorted arrays.  No link is lost: the tiles are a necessary condition, not a sketch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cribble.llm.common import (
    MIX1, MIX2, MUL, U, common_count, connected_components, lower_ascii, mix, slices, sorted_set, span_hashes, stage, text_buffers,
    word_spans)
from cribble.llm.tiles import OUT, Tiles, bitmap, whole_tiles, words_of

TEXT = 1 << 19  # bytes of text a task hashes at once: the hash arrays hold some 80 bytes for each
ROOM = 16 << 20  # bytes of sets that a block of a tile holds
# -- fixed values: the contract's white space.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def shingle_sets(raw: np.ndarray, offs: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of every row (a shorter row: all its words as one)."""
    low = lower_ascii(raw)
    starts, ends, row = word_spans(low, offs, SPACE)
    h = span_hashes(low, starts, ends)
    count = np.bincount(row, minlength=len(offs) - 1)
    first = np.cumsum(count) - count
    grams = np.zeros(max(0, len(h) - n + 1), U)
    for i in range(n):
        grams = grams * MUL + h[i:i + len(grams)]
    grams = mix(grams)
    out = []
    for f, c in zip(first.tolist(), count.tolist()):
        if c >= n:
            out.append(sorted_set(grams[f:f + c - n + 1]))
        elif c:
            v = U(c)
            with np.errstate(over="ignore"):
                for x in h[f:f + c]:
                    v = v * MUL + x
            out.append(mix(np.array([v])))
        else:
            out.append(np.zeros(0, U))
    return out


class Bands:
    """Size bands of ratio t = num / den and the number of segments of each band pair."""

    def __init__(self, num: int, den: int):
        self.t = Fraction(num, den)
        self.edges = [1]
        self.counts: dict[int, int] = {}

    def _grow(self, n: int) -> None:
        while self.edges[-1] <= n:
            last = self.edges[-1]
            self.edges.append(max(last + 1, -int(-Fraction(last) // self.t)))

    def of(self, n: int) -> int:
        self._grow(n)
        return int(np.searchsorted(self.edges, n, side="right")) - 1

    def segments(self, band: int) -> int:
        """D + 1 for pairs whose smaller set lies in ``band``: |A ^ B| <= (|A| + |B|)(1 - t)/(1 + t)."""
        self._grow(self.edges[min(band + 1, len(self.edges) - 1)])
        while len(self.edges) < band + 2:
            self._grow(self.edges[-1])
        small = self.edges[band + 1] - 1
        return int((small + int(small / self.t)) * (1 - self.t) / (1 + self.t)) + 1

    def pieces(self, band: int) -> int:
        """Segments of a band pair, so many that sets of the lower band mostly have elements in more of them
        than linked sets can differ in."""
        if band not in self.counts:
            most = self.segments(band) - 1
            least, k = self.edges[band], most + 1
            while k * (1 - (1 - 1 / k) ** least) < most + 1 + 2 * (k * 0.05) ** 0.5 and k < 4 * least:
                k += 1 + k // 50
            self.counts[band] = k
        return self.counts[band]


def tile_keys(hashes: np.ndarray, bands: Bands) -> np.ndarray:
    """Keys of the tiles a set belongs to, for its own and the lower band pair.

    Linked sets differ in at most D elements, so of the segments in which one of them has elements all but
    D are the same in both.  A set with elements in more than D segments therefore meets every
    set it links to in one of these; a set with fewer goes on to twice as many segments as well, where
    the same holds.  No tile is made of empty segments: unrelated sets would agree in them.
    """
    band, keys = bands.of(len(hashes)), []
    for b in (band - 1, band):
        if b < 0:
            continue
        most, k, level = bands.segments(b) - 1, bands.pieces(b), 0
        while True:
            seg = ((hashes >> U(32)) * U(k)) >> U(32)  # hashes are sorted, so segments are runs
            first = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
            total = np.cumsum(mix(hashes))
            sums = total[np.append(first[1:], len(hashes)) - 1]
            sums[1:] -= total[first[1:] - 1]
            seed = U((b * int(MIX2) + level * int(MUL) + 1) & (1 << 64) - 1)
            keys.append(mix(sums + seg[first] * MIX1 + seed))
            if len(first) > most or k > 1 << 31:
                break
            k, level = 2 * k, level + 1
    return np.concatenate(keys)


def fingerprints(sets: list[np.ndarray]) -> list[pa.Array]:
    """f1 and f2, the 128-bit fingerprint of every set."""
    return [pa.array([np.uint64(int(mix(s).sum(dtype=U))).astype(np.int64).item() for s in sets], pa.int64()),
            pa.array([np.uint64(int(mix(s * MIX1 + MIX2).sum(dtype=U))).astype(np.int64).item() for s in sets], pa.int64())]


def _sets(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Per row: doc_id, hash of the text, n, the set's 128-bit fingerprint and tile keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(num, den)
        for batch in slices(batches, "text", TEXT):
            sets = shingle_sets(*text_buffers(batch.column("text")), n)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                *fingerprints(sets),
                pa.array([tile_keys(s, bands).view(np.int64) if len(s) else np.zeros(0, np.int64) for s in sets],
                         pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n", "f1", "f2", "keys"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, n long, f1 long, f2 long, keys array<long>")


def member_columns(sets: list[np.ndarray]) -> list[pa.Array]:
    """n, bits (parity map) and set (sorted hashes) of every set, the payload of ``link_tiles``."""
    return [pa.array([len(s) for s in sets], pa.int64()),
            pa.array([bitmap(s, words_of(len(s))).tobytes() for s in sets], pa.binary()),
            pa.array([s.tobytes() for s in sets], pa.binary())]


def semi(df: DataFrame, ids: DataFrame, key: str | list[str], most: int = 500_000) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids``; ids are broadcast while there are at most ``most``
    of them (16 bytes each), else both sides are shuffled."""
    small = ids.limit(most + 1).count() <= most
    return df.join(F.broadcast(ids) if small else ids, key, "left_semi")


def _meet_in_batch(batches: Iterator[pa.RecordBatch], most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """(key, rep, salt) from (rep, keys): one member of every key of a batch goes on under salt 0; where a
    key has several members in the batch, its tile is known to be shared and each of them goes to a salt."""
    for batch in batches:
        offs = batch.column("keys").offsets.to_numpy()
        flat = batch.column("keys").values.to_numpy()
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offs, offs[start] + most, side="right")) - 1)
            key = flat[offs[start]:offs[end]]
            rep = np.repeat(batch.column("rep").to_numpy()[start:end], np.diff(offs[start:end + 1]))
            order = np.lexsort((rep, key))
            key, rep = key[order], rep[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (rep[1:] != rep[:-1])))[:len(key)]
            key, rep = key[new], rep[new]
            same = np.concatenate(([False], key[1:] == key[:-1], [False]))[:len(key) + 1]
            sure = same[:-1] | same[1:]
            first = ~same[:-1]
            out = (np.concatenate((key[first], key[sure])), np.concatenate((rep[first], rep[sure])),
                   np.concatenate((np.zeros(int(first.sum()), np.int64), 1 + (rep[sure] & 1023))))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["key", "rep", "salt"])
            start = end


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rep) of keys with two or more members, from rows sorted by key; of the last key of a
    batch one row is held back, with whether another member has been seen."""
    last_key, last_rep, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for batch in batches:
        key, rep, salt = (batch.column(c).to_numpy() for c in ("key", "rep", "salt"))
        known = salt > 0
        out_key, out_rep = key[known], rep[known]
        key, rep = np.concatenate((last_key, key[~known])), np.concatenate((last_rep, rep[~known]))
        if len(key):
            order = np.lexsort((rep, key))
            key, rep = key[order], rep[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (rep[1:] != rep[:-1])))
            key, rep = key[new], rep[new]
            same = np.concatenate(([False], key[1:] == key[:-1], [False]))
            met = same[:-1] | same[1:]
            if seen:
                met |= key == last_key[0]
            # rows come sorted by key, so only the largest key can go on in the next batch
            out_key, out_rep = (np.concatenate((out_key, key[:-1][met[:-1]])),
                                np.concatenate((out_rep, rep[:-1][met[:-1]])))
            last_key, last_rep, seen = key[-1:], rep[-1:], bool(met[-1])
        yield pa.RecordBatch.from_arrays([pa.array(out_key), pa.array(out_rep)], names=["key", "rep"])
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(last_key), pa.array(last_rep)], names=["key", "rep"])


def shared_tiles(signed: DataFrame, name: str) -> DataFrame:
    """(key, rep) of the tiles with two or more members, each member once; of tiles with the same
    members one stands for all.  ``signed`` (rep, keys) lists the tiles of every set.

    Rows are shuffled once: a key has at most one row for each batch in the task where its batches
    meet, however many members it has; the others, known to be shared, are dealt out by salt."""
    met = (signed.mapInArrow(_meet_in_batch, "key long, rep long, salt long").repartition("key", "salt")
           .sortWithinPartitions("key").mapInArrow(_meet, "key long, rep long"))
    members = stage(met.distinct(), name)
    groups = members.groupBy("key").agg(F.count("*").alias("m"), F.min("rep").alias("low"),
                                        F.sum(F.xxhash64("rep") % (1 << 40)).alias("who"))
    kept = groups.groupBy("m", "low", "who").agg(F.min("key").alias("key")).select("key")
    return stage(members.join(kept, "key"), f"{name}-kept")


def sorted_hashes(col: pa.Array) -> list[np.ndarray]:
    """The sets of ``member_columns``, read from their binary column."""
    raw, offs = text_buffers(col)
    return [raw[i:j].view(U) for i, j in zip(offs[:-1].tolist(), offs[1:].tolist())]


def link_tiles(held: DataFrame, sets: DataFrame, num: int, den: int, block: int = 1024,
               decode: Callable[[pa.Array], list[np.ndarray]] = sorted_hashes, draws: int = 0,
               carry: bool = False) -> DataFrame:
    """Links (a, b) that connect the same components as all links between members of a tile.

    ``held`` (key, rep) lists the members of tiles, ``sets`` (rep, n, bits, set) their sets;
    ``decode`` turns a column of ``set`` into sorted arrays of hashes.  First every set is compared in one tile only,
    the largest that holds it: near copies share many tiles, and one of them connects most of a group.  Then the tiles
    whose members still are in several components are compared, members of different components only and none that met in the
    first round.  So a group
    gives about as many links as it has members, not as many for each of its tiles.  In the second round small sets
    (``carry``) travel with the members; of large ones only the parity maps do, and the pairs that pass are joined with their
    sets; tiles with a pair that failed are compared again.

    Tiles of more than ``block`` members are compared by blocks; in the first round the smallest member and about
    ``draws`` drawn ones go to every block, which ties blocks of near copies together, in the second the members outside
    the largest component meet all blocks.  Unless the sets are small (``carry``), a block also holds no more of them
    than ``ROOM`` bytes.
    """
    most = F.lit(block) if carry else F.greatest(F.lit(2), F.least(F.lit(block), F.floor(F.lit(ROOM) / (8 * F.col("n")))))
    size = held.groupBy("key").agg(F.count("*").alias("m"))
    first = stage(held.join(size, "key").groupBy("rep").agg(F.max(F.struct("m", "key")).alias("tile"))
                  .select("rep", F.col("tile.key").alias("key")).join(sets.select("rep", "n"), "rep"), "tile-first")
    groups = first.groupBy("key").agg(F.count("*").alias("m"), F.min("rep").alias("low"), F.max("n").alias("n")).where("m > 1")
    cut = groups.select("key", "m", "low", F.ceil(F.col("m") / most).cast("int").alias("blocks"))
    tiles = first.join(cut, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    drawn = (F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(1 << 30)) * F.col("m") < draws << 30) | (F.col("rep") == F.col("low"))
    hubs = tiles.where((F.col("blocks") > 1) & drawn).select(
        "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    rows = tiles.where("m > 1").select("key", own.alias("i"), "rep").unionByName(hubs).distinct().withColumn("j", F.col("i"))
    links = settle(rows.join(sets, "rep"), sets, num, den, decode, True)
    component = connected_components(links, "a", "b").withColumnRenamed("node", "rep")
    place = (tiles.select("rep", "n", F.xxhash64("key", own).alias("cell")).join(component, "rep", "left")
             .select("rep", "n", "cell", F.coalesce("component", "rep").alias("comp")))
    placed = stage(held.join(place, "rep"), "tile-places")
    parts = placed.groupBy("key", "comp").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    left = (parts.groupBy("key").agg(F.max_by("comp", "c").alias("main"), F.sum("c").alias("m"), F.max("n").alias("n"),
                                     (F.sum("c") - F.max("c")).alias("outside"))
            .where("outside > 0").select("key", "main", F.ceil(F.col("m") / most).cast("int").alias("blocks"),
                                         F.ceil(F.col("outside") / most).cast("int").alias("groups")))
    still = placed.drop("n").join(left, "key")
    zero, many = F.lit(0), still.where("blocks > 1")
    whole = still.where("blocks = 1").select("key", zero.alias("i"), zero.alias("j"), F.lit(2).alias("side"), "comp", "cell", "rep")
    each = many.select("key", own.alias("i"), F.explode(F.sequence(zero, F.col("groups") - 1)).alias("j"),
                       zero.alias("side"), "comp", "cell", "rep")
    outside = many.where("comp != main").select(
        "key", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("i"),
        F.pmod(F.xxhash64("rep", F.lit(2)), F.col("groups")).cast("int").alias("j"), F.lit(1).alias("side"), "comp", "cell", "rep")
    cells = whole.unionByName(each).unionByName(outside)
    return links.unionByName(settle(cells.join(sets if carry else sets.drop("set"), "rep"), sets, num, den, decode, carry))


def settle(rows: DataFrame, sets: DataFrame, num: int, den: int, decode: Callable[[pa.Array], list[np.ndarray]],
           carry: bool) -> DataFrame:
    """Links of the members of every tile (key, i, j), enough to connect what they connect."""
    def compare(df: DataFrame, turn: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for g in whole_tiles(batches):
                yield Tiles(g, num, den, turn, decode if carry else None).compare()

        return (df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "rep").mapInArrow(run, OUT))

    def verify(pairs: DataFrame) -> DataFrame:
        """(a, b, ok) by the intersection of the sorted arrays."""
        both = (pairs.join(sets.select(F.col("rep").alias("a"), F.col("set").alias("x")), "a")
                .join(sets.select(F.col("rep").alias("b"), F.col("set").alias("y")), "b"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for g in slices(slices(batches, "x", 4 << 20), "y", 4 << 20):
                keep = []
                for x, y in zip(decode(g.column("x")), decode(g.column("y"))):
                    common = common_count(x, y)
                    keep.append(common > 0 and den * common >= num * (len(x) + len(y) - common))
                yield pa.RecordBatch.from_arrays([g.column("a"), g.column("b"), pa.array(keep, pa.bool_())],
                                                 names=["a", "b", "ok"])

        return both.mapInArrow(run, "a long, b long, ok boolean")

    if carry:
        return stage(compare(rows, 0).select("a", "b").distinct(), "tile-links")
    rows = stage(rows, "tile-rows")
    links, turn, todo, verdicts, told = None, 0, rows, None, None
    while True:
        sent = stage(compare(todo, turn), "tile-candidates")
        fresh = sent.select("a", "b").distinct()
        if told is not None:
            fresh = fresh.join(told, ["a", "b"], "left_anti")
        new = stage(verify(fresh), "tile-verdicts")
        told = new if told is None else told.unionByName(new)
        good = new.where("ok").select("a", "b")
        links = good if links is None else links.unionByName(good)
        judged = sent.join(told, ["a", "b"])
        verdicts = judged if verdicts is None else verdicts.unionByName(judged)
        open_ = stage(judged.where("not ok").select("key", "i", "j").distinct(), "tile-open")
        if not open_.limit(1).count():
            return links
        # the tiles of failed pairs again, with all verdicts on their pairs as rows of their own
        turn += 1
        todo = rows.join(open_, ["key", "i", "j"], "left_semi").unionByName(
            verdicts.join(open_, ["key", "i", "j"], "left_semi").select(
                "key", "i", "j", F.col("a").alias("rep"), F.col("b").alias("other"), "ok"), allowMissingColumns=True)


def similarity_classes(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, block: int = 1024) -> DataFrame:
    """Per document: doc_id, n_shingles (set size) and component_id.

    Two documents link when ``den * |A & B| >= num * |A | B|`` for their sets of word
    n-grams (ASCII letters lower-cased).  Equal sets form one class first, so copies are
    never paired; ``link_tiles`` links the classes.
    Null and empty texts have empty sets, link with nothing and are their own component;
    repeated rows give one row each with the same component; different texts under one
    doc_id are linked each by its own set; a null doc_id
    stays alone with a null component; other columns are ignored; no rows give no rows.
    """
    return similarity_groups(docs, n, num, den, block).select("doc_id", "n_shingles", "component_id")


def similarity_groups(docs: DataFrame, n: int, num: int, den: int, block: int = 1024) -> DataFrame:
    """``similarity_classes`` with the hash of the text and ``group``, which differs between components
    that have the same smallest doc_id; it is null where ``n_shingles`` is 0 or doc_id is null."""
    node = F.xxhash64("n", "f1", "f2").alias("rep")
    sets = stage(_sets(docs, n, num, den), "shingle-sets")
    named = sets.where("n > 0 and doc_id is not null")
    classes = stage(named.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("low"))
                    .select("n", "f1", "f2", "low", node), "jaccard-classes")
    first = classes.select(F.col("low").alias("doc_id"), "rep")
    held = shared_tiles(semi(named.select("doc_id", node, "keys"), first, ["doc_id", "rep"]).select("rep", "keys"), "tiles")

    def payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT):
            sets = shingle_sets(*text_buffers(batch.column("text")), n)
            yield pa.RecordBatch.from_arrays([*fingerprints(sets), *member_columns(sets)],
                                             names=["f1", "f2", "n", "bits", "set"])

    wanted = stage(semi(first, held.select("rep").distinct(), "rep").select("doc_id").distinct(), "tile-members")
    # other texts under a wanted doc_id come along as sets that no tile names
    members = stage(semi(docs.select("doc_id", "text"), wanted, "doc_id").mapInArrow(
        payload, "f1 long, f2 long, n long, bits binary, set binary").select(node, "n", "bits", "set")
        .dropDuplicates(["rep"]), "tile-sets")
    links = link_tiles(held, members, num, den, block)
    component = connected_components(links, "a", "b")
    linked = classes.join(component.withColumnRenamed("node", "rep"), "rep").select("rep", "component", "low")
    lowest = linked.groupBy("component").agg(F.min("low").alias("c"))
    label = (classes.join(linked.drop("low").join(lowest, "component"), "rep", "left")
             .select("n", "f1", "f2", F.coalesce("c", "low").alias("c"), F.coalesce("component", "rep").alias("g")))
    known = F.col("doc_id").isNotNull()
    return (sets.select("doc_id", "text_hash", "n", "f1", "f2").join(label, ["n", "f1", "f2"], "left")
            .select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.when(known, F.col("g")).alias("group"),
                    F.when(known, F.coalesce("c", "doc_id")).alias("component_id")))
