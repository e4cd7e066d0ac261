"""Trie, periodic runs and byte-level BPE: brute force, round trips and odd rows."""

import base64
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from cribble.llm import bpe, periods, trie
from cribble.llm.queries import QUERIES

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ODD = [(1, None), (2, ""), (3, " \n "), (None, "a b c " * 30), (5, "x y " * 40), (5, "x y " * 40), (6, "É ß 中文 " * 9)]


@pytest.fixture(scope="module")
def odd(spark):
    names = "doc_id long, text string, n_tokens string, ids string, start string, runs string, key string, g string"
    return spark.createDataFrame([(*r, *["z"] * 6) for r in ODD], names)


# ------------------------------------------------------------ trie

def brute_trie(convs):
    """convs: {conv_id: [(role, text)]} -> the rows of prefix_trie."""
    members, out = {}, []
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node, who in members.items():
        below = [k for k in members if k[:len(node)] == node]
        kids = [k for k in below if len(k) == len(node) + 1]
        leaves = [k for k in below if not any(j[:-1] == k and j for j in members)]
        saved = sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k)
        ends = sorted(c for c in who if len(convs[c]) == len(node))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), len(leaves),
                    saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_rows(df):
    return sorted([(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
                   for r in df.collect()], key=repr)


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_trie_against_brute_force(spark, monkeypatch, shards):
    monkeypatch.setattr(trie, "shard_count", lambda turns: shards)
    rng = random.Random(shards)
    convs = {}
    for c in range(-60, 300, 3):
        kind = rng.random()
        size = 0 if kind < 0.05 else rng.randrange(1, 5) if kind < 0.95 else rng.randrange(17, 40)
        convs[c] = [(rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "éé", ""])) for _ in range(size)]
        if kind > 0.6 and size < 9:
            convs[c] = [("user", "the hot one"), ("assistant", "yes")]  # a third of all
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    none = turns.select("conv_id").where("false").unionByName(
        spark.createDataFrame([(c,) for c, t in convs.items() if not t], "conv_id long"))
    told = trie.paths(turns)
    told = told.unionByName(none.select("conv_id", F.slice(F.array(F.struct(
        F.lit("").alias("digest"), F.lit(0).cast("long").alias("chars"))), 1, 0).alias("turns")))
    assert trie_rows(trie.prefix_trie(told)) == brute_trie(convs)


def test_trie_openings_nulls_and_long_conversations(spark):
    rows = [(0, None, "user", "first"), (0, 1, None, None), (0, 2, "user", "c"), (0, 2, "user", "c"), (None, 0, "user", "x")]
    rows += [(7, i, "user", f"t{i % 3}") for i in range(3000)] + [(107, 0, "user", "own"), (3, 0, "user", "one")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("z"))
    shared = F.crc32(F.col("conv_id").cast("string")) % 6
    got = {r.conv_id: [t.chars for t in r.turns] for r in
           trie.share_openings(trie.paths(turns.drop("key")), 100, shared, 5).collect()}
    told = {c: [len(t or "") for _, _, _, t in sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))]
            for c in (0, 3, 7, 107)}
    for c in told:
        h = zlib.crc32(str(c).encode()) % 6
        assert got[c] == told.get(c - c % 100, [])[:h] + told[c][h:]
    plain = {7: [("user", f"t{i % 3}") for i in range(3000)]}
    chain = trie_rows(trie.prefix_trie(trie.paths(turns.where("conv_id = 7"))))
    assert len(chain) == 3001 and all(r[3] == 1 and r[5] == 1 and r[6] == 0 for r in chain)
    assert sum(r[4] for r in chain) == len(plain[7])
    assert trie.prefix_trie(trie.paths(turns.where("false"))).count() == 0


def test_turn_order_of_a_shard():
    rng = np.random.default_rng(5)
    for _ in range(40):
        length = rng.choice([0, 1, 2, 15, 16, 17, 33, 50], 30)
        ids = rng.integers(1, 3, int(length.sum()))
        start = np.cumsum(length) - length
        conv = rng.permutation(30)
        rows = [(ids[s:s + n].tolist(), c) for s, n, c in zip(start, length, conv)]
        order = trie.path_order(ids, start, length, conv)
        assert [rows[i] for i in order] == sorted(rows)


# ------------------------------------------------------------ periodic runs

def brute_runs(words, least=24, times=3):
    found = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i < len(words) - p:
            j = i
            while j < len(words) - p and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, times * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def made_words(rng):
    n = rng.choice([0, 1, 23, 24, 30, 60, 150, 300])
    words = [rng.randrange(rng.choice([1, 2, 3, 1000])) for _ in range(n)]
    for _ in range(rng.choice([0, 1, 3])):
        s, p, size = rng.randrange(n + 1), rng.choice([1, 2, 7, 8, 9, 20, 40]), rng.randrange(1, n + 2)
        for i in range(s + p, min(n, s + size)):
            words[i] = words[i - p]
    if rng.random() < 0.1:  # a Fibonacci word: many runs inside each other
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        words = b[:n]
    return words


@pytest.mark.parametrize("most", [40, 1 << 20])
def test_runs_against_brute_force(most):
    rng = random.Random(most)
    for _ in range(120):
        rows = [made_words(rng) for _ in range(rng.choice([1, 4]))]
        flat = np.array([w for r in rows for w in r], np.int64)
        got = [[] for _ in rows]
        for r, *run in zip(*(c.tolist() for c in periods.find_runs(flat, np.array([len(r) for r in rows]), most=most))):
            got[r].append(tuple(run))
        assert got == [brute_runs(r) for r in rows]


def test_common_extensions():
    rng = np.random.default_rng(2)
    for trial in range(30):
        w = rng.integers(0, 2, 200) if trial % 2 else np.resize(rng.integers(0, 3, 1 + trial), 200)
        symbol = np.concatenate(([10], w, [11])).astype(np.int64)
        levels = periods.recompress(symbol, np.array([0, 1]))
        x = rng.integers(1, 200, 300)
        y = rng.integers(1, 200, 300)
        x, y = x[x != y], y[x != y]
        for lev, flip in ((levels, False), (periods.mirrored(levels), True)):
            text = symbol[::-1] if flip else symbol
            want = [next(k for k in range(300) if text[a + k] != text[b + k]) for a, b in zip(x, y)]
            assert periods.lce(lev, x, y).tolist() == want


def test_long_repetitive_texts():
    for words in ([0] * 200_000, [0, 1, 2] * 60_000):
        r = periods.find_runs(np.array(words), np.array([len(words)]))
        assert [c.tolist() for c in r] == [[0], [0], [len(words)], [len(set(words))]]


def expected_op12(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda t: (-Fraction(t[1], t[2]), t[0], t[2])) if runs else (None, None, None)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_periodic_query_against_brute_force(spark, tmp_path):
    rng = random.Random(9)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where(
        "length(text) < 6000").collect()
    rows = [(r.doc_id, r.text) for r in docs]
    rows += [(10_000 + i, " \n".join(f"w{w}" for w in made_words(rng))) for i in range(200)]
    rows += [(20_000, None), (20_001, ""), (20_002, " \t")] + [(20_010 + i, "a b  a b\n" * 8) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("z")).withColumn(
        "runs", F.lit("z")).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(expected_op12(*r) for r in rows)


def test_collapse_odd_rows(odd):
    rows = periods.collapse(odd).collect()
    assert len(rows) == len(ODD) and sum(r.doc_id == 5 and r.collapsed == b"x y" for r in rows) == 2
    null = next(r for r in rows if r.doc_id is None)
    assert null.collapsed == b"a b c" and (null.start, null.length, null.period, null.exponent_milli) == (0, 90, 3, 30_000)
    assert all(r.n_runs == 0 and r.start is None and r.collapsed == b"" and r.runs == [] for r in rows if r.doc_id in (1, 2, 3))
    assert periods.collapse(odd.where("false")).count() == 0
    assert periods.best_run([(9, 30, 10), (2, 60, 20), (2, 33, 11)]) == (2, 33, 11)


# ------------------------------------------------------------ byte-level BPE

@pytest.fixture(scope="module")
def ours_and_theirs():
    ours = bpe.codec(bpe.read_ranks(RANKS), PATTERN)
    return ours, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ours.ranks, special_tokens={})


def test_encoding_equals_the_library(ours_and_theirs):
    ours, theirs = ours_and_theirs
    rng = random.Random(4)
    alphabets = ["ab", "the", "aeinrst", "abcdefghijklmnopqrstuvwxyz", " \n\t", "é中ßΣ​\U0001f600", "0123", "-=*#", "'strevm d"]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.choice([1, 5, 60]))) for _ in range(300)]
    texts += ["".join(rng.choice(a) for _ in range(n)) for a in alphabets for n in (3, 17, 255, 256, 257, 1500)]
    texts += ["<|endoftext|>", "", "a" * 70_000, "ab" * 3000 + "a", "\x00\x1c\x85 "]
    ids, counts = ours.encode(pa.array([*texts, None]))
    want = [theirs.encode_ordinary(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want] + [0]
    assert ids.tolist() == [i for w in want for i in w]
    raw, size = ours.decode(ids)
    assert raw.tobytes() == "".join(texts).encode() and len(size) == len(ids)


def test_whitespace_and_letters_of_every_code_point(ours_and_theirs):
    ours, theirs = ours_and_theirs
    text = "".join(f"a{chr(c)}1{chr(c)} !{chr(c)}" for c in range(1, 0x3100))
    assert ours.encode(pa.array([text]))[0].tolist() == theirs.encode_ordinary(text)


def test_joint_merges_of_a_long_piece_equal_single_merges():
    """Ranks in which a merge brings up a pair of lower rank, so the joint round must fall back."""
    tokens = [b"xab", b"ab", b"abab", b"ba", b"bb", b"xa", b"aa", b"aab"]
    rng = random.Random(8)
    for trial in range(60):
        rng.shuffle(tokens)
        ranks = {t: i for i, t in enumerate([*tokens, *[bytes([b]) for b in range(256)]])}
        ours = bpe.ByteBpe(ranks, r"[\s\S]+")
        theirs = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        for n in (5, 40, 400):
            piece = "".join(rng.choice("xab") for _ in range(n))
            want = theirs.encode_ordinary(piece)
            assert ours.encode(pa.array([piece]))[0].tolist() == want
            assert ours.merge_long(ours.byte_id[np.frombuffer(piece.encode(), np.uint8)]).tolist() == want or piece.encode() in ranks


def test_bpe_query(spark, sf, ours_and_theirs):
    theirs = ours_and_theirs[1]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in docs:
        ids = theirs.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op13_byte_bpe"](spark, sf).collect())) == sorted(want)


def test_bpe_odd_rows(odd, spark):
    out = bpe.decode(bpe.encode(odd, RANKS, PATTERN), RANKS, PATTERN)
    rows = out.collect()
    assert sorted((r.doc_id or -1, r.decoded.decode()) for r in rows) == sorted((i or -1, t or "") for i, t in ODD)
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)
    assert bpe.decode(bpe.encode(odd.where("false"), RANKS, PATTERN), RANKS, PATTERN).count() == 0
    cut = spark.createDataFrame([(1, 1, bytearray(np.array([220], "<u4").tobytes())), (2, 0, None)],
                                "doc_id long, n_tokens long, ids binary")
    space = next(base64.b64decode(line.split()[0]) for line in open(RANKS) if line.split()[1] == "220")
    assert {r.doc_id: bytes(r.decoded) for r in bpe.decode(cut, RANKS, PATTERN).collect()} == {1: space, 2: b""}
