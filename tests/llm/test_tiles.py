"""Tiles meet in one shuffle: every key with two members, with all its members, however rows are batched."""

import random
from collections import defaultdict

import pyarrow as pa
import pytest

from cribble.llm.common import U
from cribble.llm.jaccard import _meet, _meet_in_batch

ROW = pa.schema([("key", pa.int64()), ("rep", pa.int64()), ("salt", pa.int64())])


@pytest.mark.parametrize("seed", range(100))
def test_members_of_shared_keys(seed):
    r = random.Random(seed)
    want, rows = defaultdict(set), []
    for _ in range(r.randint(1, 5)):
        reps = [r.randint(-6, 6) for _ in range(r.randint(0, 12))]
        keys = [[r.randint(-9, 9) for _ in range(r.randint(0, 3))] for _ in reps]
        for rep, ks in zip(reps, keys):
            for k in ks:
                want[k].add(rep)
        batch = pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                                           names=["rep", "keys"])
        for out in _meet_in_batch(iter([batch]), r.choice([1, 4, 1 << 19])):
            rows += out.to_pylist()
    r.shuffle(rows)
    tasks = defaultdict(list)
    for row in rows:
        tasks[hash((row["key"], row["salt"])) % 3].append(row)
    got = defaultdict(set)
    for task in tasks.values():
        task.sort(key=lambda x: x["key"])
        n = r.randint(1, 7)
        for out in _meet(pa.RecordBatch.from_pylist(task[i:i + n], schema=ROW) for i in range(0, len(task), n)):
            for row in out.to_pylist():
                got[row["key"]].add(row["rep"])
    assert got == {k: v for k, v in want.items() if len(v) > 1}


def test_rounds_of_drawn_members_keep_the_components(spark):
    """A tile of many near copies in a chain: the same components with and without rounds."""
    import numpy as np
    from pyspark.sql import functions as F

    from cribble.llm.common import connected_components
    from cribble.llm.jaccard import link_tiles, member_columns

    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 400, dtype=np.uint64)
    sets = [np.sort(base[i // 2:i // 2 + 40]) for i in range(200)] + [
        np.sort(rng.integers(0, 1 << 62, 40, dtype=np.uint64)) for _ in range(20)]
    n, bits, body = member_columns(sets)
    members = spark.createDataFrame(list(zip(range(220), n.to_pylist(), bits.to_pylist(), body.to_pylist())),
                                    "rep long, n long, bits binary, set binary")
    held = spark.range(220).select(F.lit(5).cast("long").alias("key"), F.col("id").alias("rep"))
    links = {(i, j) for i in range(220) for j in range(i + 1, 220)
             if 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j]))}
    comp = list(range(220))
    for i, j in sorted(links):
        a, b = comp[i], comp[j]
        comp = [min(a, b) if c in (a, b) else c for c in comp]
    want = {i: c for i, c in enumerate(comp) if comp.count(c) > 1}
    for draws in (0, 2, 16):
        got = {r.node: r.component for r in connected_components(
            link_tiles(held, members, 8, 10, draws=draws), "a", "b").collect()}
        assert got == want


def near_sets(rng, num, den, rounds):
    """Pairs of sets whose similarity is at the threshold or just above it."""
    import numpy as np
    for _ in range(rounds):
        n = int(rng.integers(1, 400)) if rng.random() < 0.7 else int(rng.integers(1, 30))
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        lost = int(rng.integers(0, n + 1))
        while lost and den * (len(base) - lost) < num * len(base):
            lost -= 1
        a, b, extra = base, base[lost:], 0
        # elements of b that a lacks, while the pair still links
        while den * len(b) >= num * (len(a) + extra + 1) and rng.random() < 0.95:
            extra += 1
        b = np.unique(np.concatenate((b, rng.integers(0, 1 << 63, extra, dtype=np.uint64))))
        common = len(np.intersect1d(a, b))
        if common and den * common >= num * (len(a) + len(b) - common):
            yield a, b


@pytest.mark.parametrize("num,den", [(8, 10), (90, 100), (5, 10)])
def test_linked_sets_share_a_tile(num, den):
    import numpy as np

    from cribble.llm.jaccard import Bands, tile_keys
    rng, seen = np.random.default_rng(num), 0
    bands = Bands(num, den)
    for a, b in near_sets(rng, num, den, 4000):
        seen += 1
        assert len(np.intersect1d(tile_keys(a, bands), tile_keys(b, bands)))
    assert seen > 3000


def test_unrelated_sets_share_no_tile():
    import numpy as np

    from cribble.llm.jaccard import Bands, tile_keys
    rng, bands = np.random.default_rng(1), Bands(8, 10)
    keys = np.concatenate([tile_keys(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)), bands)
                           for n in rng.integers(40, 60, 400)])
    assert len(np.unique(keys)) == len(keys)


def test_hashes_in_the_same_segments():
    """Sets whose hashes crowd in few segments go on to finer ones."""
    import numpy as np

    from cribble.llm.jaccard import Bands, tile_keys
    bands = Bands(8, 10)
    rng = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 40, 60, dtype=np.uint64))
        b = np.unique(np.concatenate((a[6:], rng.integers(0, 1 << 40, 3, dtype=np.uint64))))
        assert len(np.intersect1d(tile_keys(a, bands), tile_keys(b, bands)))


@pytest.mark.parametrize("carry", [False, True])
@pytest.mark.parametrize("block", [8, 1024])
def test_links_connect_what_all_links_connect(spark, block, carry):
    """Groups of near copies, chains, and pairs that pass the bitmaps but do not link; wide and narrow bitmaps."""
    import numpy as np
    from pyspark.sql import functions as F

    from cribble.llm.common import connected_components
    from cribble.llm.jaccard import link_tiles, member_columns
    rng = np.random.default_rng(block)
    sets = []
    for g in range(6):
        base = rng.integers(0, 1 << 62, 600 if g == 0 else 45, dtype=np.uint64)
        sets += [np.unique(np.concatenate((base[rng.random(len(base)) < 0.93], rng.integers(0, 1 << 62, 2, dtype=np.uint64))))
                 for _ in range(12)]
    # the same bits in 512, other elements: only the sorted arrays tell them apart
    bits = rng.integers(0, 512, 60, dtype=np.uint64)
    sets += [np.unique(bits + U(512) * rng.integers(1, 1 << 40, 60, dtype=np.uint64)) for _ in range(10)]
    n, maps, body = member_columns(sets)
    members = spark.createDataFrame(list(zip(range(len(sets)), n.to_pylist(), maps.to_pylist(), body.to_pylist())),
                                    "rep long, n long, bits binary, set binary")
    tile = [(1, i) for i in range(len(sets))] + [(2, i) for i in range(0, len(sets), 3)] + [(3, i) for i in range(5)]
    held = spark.createDataFrame(tile, "key long, rep long")
    links = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
             if 10 * len(np.intersect1d(sets[i], sets[j])) >= 8 * len(np.union1d(sets[i], sets[j]))]
    comp = list(range(len(sets)))
    for i, j in links:
        a, b = comp[i], comp[j]
        comp = [min(a, b) if c in (a, b) else c for c in comp]
    got = link_tiles(held, members, 8, 10, block, carry=carry).collect()
    assert {(r.a, r.b) for r in got} <= set(links)
    found = connected_components(spark.createDataFrame(got, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in found} == {i: c for i, c in enumerate(comp) if comp.count(c) > 1}


def test_sorted_sets_and_common_counts():
    import numpy as np
    from cribble.llm.common import common_count, sorted_set
    rng = np.random.default_rng(1)
    for n, m in ((0, 0), (0, 3), (1, 1), (5, 40), (300, 200)):
        a, b = (rng.integers(0, 60, k).astype(np.uint64) * np.uint64(1 << 58) for k in (n, m))
        x, y = sorted_set(a), sorted_set(b)
        assert np.array_equal(x, np.unique(a)) and common_count(x, y) == common_count(y, x) == len(np.intersect1d(a, b))


def test_near_copies_are_paired_once_not_for_every_tile(spark, monkeypatch):
    """Twenty near copies in thirty tiles: one tile links them, the others send no pairs."""
    import numpy as np

    from cribble.llm import jaccard
    rng = np.random.default_rng(5)
    base = np.sort(rng.integers(0, 1 << 62, 300, dtype=np.uint64))
    n, bits, body = jaccard.member_columns([np.delete(base, i) for i in range(20)])
    members = spark.createDataFrame(list(zip(range(20), n.to_pylist(), bits.to_pylist(), body.to_pylist())),
                                    "rep long, n long, bits binary, set binary")
    held = spark.createDataFrame([(t, r) for t in range(30) for r in range(20) if r != t % 20], "key long, rep long")
    made, plain = [], jaccard.stage

    def counted(df, name):
        out = plain(df, name)
        if name in ("tile-candidates", "tile-links"):
            made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stage", counted)
    got = jaccard.link_tiles(held, members, 8, 10).collect()
    assert sum(made) < 60
    found = jaccard.connected_components(spark.createDataFrame(got, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in found} == {i: 0 for i in range(20)}


def test_parity_maps_bound_the_overlap_closely():
    """Never below the overlap, whatever the widths; sets well below the threshold are told apart without their elements."""
    import numpy as np

    from cribble.llm.tiles import bitmap, folded, overlap_bound, words_of

    rng, passed = np.random.default_rng(11), 0
    for trial in range(400):
        n = int(rng.choice([20, 300, 600, 3000]))
        body = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64))
        rng.shuffle(body)
        cut = int(rng.integers(0, n + 1)) if trial % 2 else n * 7 // 100
        x, y = body[:n], np.concatenate((body[cut:n], body[n:n + cut]))  # similarity 0.87 in the even trials
        maps = [np.frombuffer(bitmap(s, w).tobytes(), np.uint64) for s, w in ((x, words_of(n)), (y, 2 * words_of(n)))]
        bits = folded(maps, words_of(n))
        size = np.array([len(x), len(y)])
        bound = int(overlap_bound(bits[0], bits[1], size[0], size[1]))
        assert bound >= len(np.intersect1d(x, y))
        passed += trial % 2 == 0 and n > 20 and 100 * bound >= 90 * (2 * n - bound)
    assert passed < 10
