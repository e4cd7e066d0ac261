"""Operators against brute force on the small tables and on made cases."""

import zlib

import numpy as np
import pytest

from cribble.llm import embeddings, jaccard, lines, suffix
from cribble.llm.common import connected_components
from cribble.llm.queries import QUERIES, SQL


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin(spark, sf, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(SQL[name])
    cols = sorted(c[0] for c in want.description)
    got = QUERIES[name](spark, sf)
    assert sorted(got.columns) == cols
    names = [c[0] for c in want.description]
    rows = sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in want.fetchall())
    assert sorted(repr(tuple(r[c] for c in cols)) for r in got.collect()) == rows


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (120, 2))] + [(i, i + 1) for i in range(500, 540)]
    df = spark.createDataFrame([*edges, (None, 3), (4, 4)], "x long, y long")
    got = {r.node: r.component for r in connected_components(df, "x", "y").collect()}
    want = components({i for e in edges if e[0] != e[1] for i in e}, edges)
    assert got == want
    assert connected_components(df.where("false"), "x", "y").count() == 0


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(30):
        t = rng.integers(1, 3, int(rng.integers(1, 150)))
        if trial % 3 == 0:
            t = np.tile(t[:max(1, len(t) // 7)], 8)
        want = sorted(range(len(t)), key=lambda i: tuple(t[i:]))
        order, _ = suffix.suffix_array(t.astype(np.int64), len(t) + 1)
        assert order.tolist() == want
        for most in (5, len(t)):
            got = suffix.kasai(t, order, most)
            for i in range(1, len(t)):
                a, b, c = t[want[i - 1]:], t[want[i]:], 0
                while c < min(len(a), len(b), most) and a[c] == b[c]:
                    c += 1
                assert got[i] == c


def brute_repeats(docs, width):
    seen, out = set(), {}
    for key, data in docs:
        edge = np.zeros(len(data) + 1, int)
        for i in range(len(data) - width + 1):
            w = data[i:i + width]
            if w in seen:
                edge[i] += 1
                edge[i + width] -= 1
            seen.add(w)
        out[key] = np.frombuffer(data, np.uint8)[~(np.cumsum(edge)[:-1] > 0)].tobytes()
    return out


@pytest.mark.parametrize("sizes", [{}, {"shard_bytes": 3000, "piece_bytes": 800, "anchors_per_part": 40}])
def test_repeats(spark, sizes):
    rng = np.random.default_rng(3)
    passages = ["".join(chr(97 + x) for x in rng.integers(0, 4, n)) for n in (120, 150, 99, 100, 400)]
    docs = []
    for i in range(60):
        parts = ["".join(chr(97 + x) for x in rng.integers(0, 26, int(rng.integers(0, 80))))]
        parts += [passages[int(x)] for x in rng.integers(0, len(passages), 2)]
        docs.append((i, "é".join(parts)))
    docs += [(100, "ab" * 300), (101, "ab" * 60)]
    want = brute_repeats([(k, t.encode()) for k, t in docs], 100)
    df = spark.createDataFrame(docs[::-1], "doc_id long, text string").repartition(5)
    got = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(df, **sizes).collect()}
    assert got == want


def test_passage_in_many_documents(spark):
    """A passage with its own text beside it in each document: its contexts are dealt out to shares of
    bounded size, and windows that meet only across shares still lose all but the earliest start."""
    rng = np.random.default_rng(11)

    def draw(n):
        return "".join(chr(97 + x) for x in rng.integers(0, 20, n))

    passage, flanks = draw(260), [draw(90) for _ in range(6)]
    docs = []
    for i in range(400):
        beside = flanks[i % 6] if i % 3 else draw(90)
        docs.append((1000 - i, draw(60) + beside + passage + draw(80)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    sizes = {"shard_bytes": 20_000, "anchors_per_part": 2000, "contexts_per_share": 64}
    _, found, _, load = suffix.anchor_contexts(df, **sizes)
    most = max(r["count"] for r in found.groupBy("anchor").count().collect())
    assert load > 400 and most <= 128
    want = brute_repeats(sorted((k, t.encode()) for k, t in docs), 100)
    got = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(
        df, piece_bytes=2000, places_per_bucket=5000, **sizes).collect()}
    assert got == want


def test_jaccard_finds_every_link(spark):
    rng = np.random.default_rng(5)
    docs, key = [], 0
    for size in (9, 10, 19, 40, 120, 300):
        base = [f"w{x}" for x in rng.integers(0, 5000, size)]
        for _ in range(25):
            w = list(base)
            for at in rng.integers(0, size, int(rng.integers(0, 1 + size // 30))):
                w[at] = f"e{rng.integers(0, 9)}"
            docs.append((key, " ".join(w)))
            key += 1
    sets = {k: {tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} for k, w in ((k, t.split()) for k, t in docs)}
    links = [(a, b) for a in sets for b in sets if a < b
             and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    got = {r.doc_id: r.component_id for r in jaccard.similarity_classes(
        spark.createDataFrame(docs, "doc_id long, text string"), block=8).collect()}
    assert got == components(sets, links) and len(links) > 100


def test_line_groups(spark, sf):
    """Exact copies of a line always meet, and no line is removed without a similar earlier one."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    kept, grams = set(), {}
    removed = []
    for r in docs.orderBy("doc_id").collect():
        for i, x in enumerate((r.text or "").split("\n")):
            x = x.strip(" \t\r\f\x0b")
            if not x:
                continue
            g = {x[j:j + 8] for j in range(max(1, len(x) - 7))}
            if i in got[r.doc_id].removed:
                removed.append((x, g))
            else:
                assert x not in kept
                kept.add(x)
                grams[x] = g
    everything = [*grams.values(), *(g for _, g in removed)]
    for x, g in removed:
        if x not in kept:
            assert any(h != g and len(g & h) >= 0.8 * len(g | h) for h in everything)
    assert removed


def test_embedding_recall(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows], np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, bucket=16, block=8).collect()}
    found = sum(got.values())
    assert close.sum() * 0.9 <= found <= close.sum()


def held_out_accuracy(pairs):
    return np.mean([a == b for a, b in pairs])


def test_language_held_out(spark):
    d = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = QUERIES["op5_language_id"](spark, d).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows) and len(rows) == len(lang)
    assert held_out_accuracy([(r.lang_pred, lang[r.doc_id]) for r in rows if r.held_out]) >= 0.95


def test_quality_held_out(spark):
    d = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = QUERIES["op2_quality"](spark, d).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert held_out_accuracy([(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]) >= 0.95
