"""Nulls, empty texts, repeated rows, empty tables and clashing column names, for every operator."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cribble.llm import chat, decontaminate, embeddings, jaccard, langid, lines, packing, quality, suffix, urls

DOCS = "doc_id long, text string, score string, n_words string, start string, rule string, keys string"
LONG = " ".join(f"w{i}" for i in range(30_000))
ROWS = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "a null id"), (4, LONG), (5, LONG), (6, "\n \n"),
        (7, "The quick brown fox, jumps over the lazy dog.")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in ROWS], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_packing(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(docs, path, end_id=2).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 1 and sum(r.length for r in rows if r.doc_id == 3) == 4
    assert all(r.length & (r.length - 1) == 0 and r.length <= 4096 and len(r.ids) == 4 * r.length for r in rows)
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert packing.pack(none, path, end_id=2).count() == 0


def test_packing_matches_the_tokenizer(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["It's a TEST, isn't it? x,y z.", "<|endoftext|> Á b² 中文, ok.", "\tTab\r\nline   nbsp,",
             "Ends.", "a , b ,", "<|ENDOFTEXT|>", "don't, we'll. 12,5 1. ẞİ Σς"]
    tok = Tokenizer.from_file(path)
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, 2).collect()
    for i, t in enumerate(texts):
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(got, key=lambda r: r.start) if r.doc_id == i])
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids + [2]


def test_lines(docs, none):
    by_id = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert by_id[1].text is None and by_id[2].text == "" and by_id[6].text == "\n \n"
    assert by_id[4].removed == [] and by_id[5].removed == [0] and by_id[5].text == ""
    assert by_id[3].text == "one" and by_id[7].score == "x"
    assert lines.dedup_lines(docs).count() == len(ROWS) and lines.dedup_lines(none).count() == 0


def test_different_texts_under_one_id(spark):
    import corpus_pipeline
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    near = a.replace("a59", "other")
    df = spark.createDataFrame([(3, b), (5, a), (5, b + " more"), (5, "alone"), (9, near), (7, ""), (7, "")],
                               "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in jaccard.similarity_classes(df, n=5, num=8, den=10).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (5, 5), (7, 7), (7, 7), (9, 5)]
    kept = corpus_pipeline.drop_near_copies(spark, df, "").collect()
    assert sorted(map(tuple, kept)) == sorted([(3, b), (5, a), (5, "alone"), (7, "")])


def test_fuzzy_lines(spark):
    words = [f"word{i}" for i in range(60)]
    near = " ".join(words[:30] + ["changed"] + words[31:])
    far = " ".join(reversed(words))
    df = spark.createDataFrame([(1, "head\n" + " ".join(words)), (2, near + "\ntail"), (3, far)],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    assert got[1].removed == [] and got[2].text == "tail" and got[3].removed == []


def test_jaccard(docs, none):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similarity_classes(docs).collect()]
    assert len(got) == len(ROWS)
    assert got.count((3, 1, 3)) == 2 and (1, 0, 1) in got and (2, 0, 2) in got and (6, 0, 6) in got
    assert (4, 29_998, 4) in got and (5, 29_998, 4) in got and any(g[0] is None and g[2] is None for g in got)
    assert jaccard.similarity_classes(none).count() == 0


def test_decontamination(spark, docs, none):
    passage = " ".join(f"w{i}" for i in range(100, 120))
    items = spark.createDataFrame([(1, passage), (2, passage), (3, "one"), (4, None), (5, "")],
                                  "item_id long, text string")
    got = decontaminate.judge(docs, items)
    rows = got.collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS) and by_id[4].n_hit == 20 and sorted(by_id[4]["items"]) == [1, 2]
    assert not by_id[4].contaminated and by_id[3].contaminated and by_id[3].n_words == 1
    assert not by_id[1].contaminated and by_id[1].n_words == 0 and by_id[7].keys == "x"
    assert decontaminate.judge(none, items).count() == 0
    assert decontaminate.judge(docs, items.where("false")).where("contaminated").count() == 0


def test_language(docs, none, spark):
    taught = spark.createDataFrame([(f"the cat and the dog {i}", "en") for i in range(30)]
                                   + [(f"le chat et le chien {i}", "fr") for i in range(30)] + [(None, "en"), ("x", None)],
                                   "text string, lang string")
    model = langid.fit(taught, "lang")
    rows = langid.predict(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert all((r.lang_pred == "und") == (not r.text or not r.text.strip()) for r in rows)
    assert langid.predict(none, model).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(taught.where("false"), "lang")).collect()} == {"und"}


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(2, 0), (3, 1), (4, 1), (7, 1), (9, 1), (7, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels, "doc_id", "quality")
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert quality.score(none, model).count() == 0
    assert quality.fit(docs, labels.where("false"), "doc_id", "quality").rules == []


def test_urls(spark):
    link = '<html><LINK href="http://b.com/de/2" rel=canonical></html>'
    move = '<meta http-equiv="refresh" content="0; url=/x#top">'
    rows = [(1, None, None), (2, "no scheme", ""), (3, "http://a.net/1", link), (4, "HTTP://A.net/1#q", None),
            (5, "http://b.com/de/2", None), (6, "http://c.net/y/z", move), (7, "http://c.net/x", None),
            (8, "http://d.org/1", link), (9, "https://e.net", None), (9, "https://e.net", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1))
    rules = [urls.Rule("block", "com/de/"), urls.Rule("allow", "d.org/")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.reason) for r in urls.judge(pages, rules[:1]).collect()}
    assert got[1] == ("", "", None, "allow", "default") == got[2]
    assert got[3] == ("a.net", "/1", None, "block", "alias") and got[4][3] == "block" and got[5][3:] == ("block", "rule")
    assert got[6][3:] == got[7][3:] == ("allow", "default") and got[9][0] == "e.net"
    # an explicitly allowed alias keeps its component from the block, the blocked page stays blocked
    got = {r.page_id: r.verdict for r in urls.judge(pages, rules).collect()}
    assert got[3] == "allow" and got[8] == "allow" and got[5] == "block"
    moved = spark.createDataFrame([("https://e.net", "http://b.com/de/2"), (None, "http://x.y")], "source string, target string")
    got = {r.page_id: r.verdict for r in urls.judge(pages, rules[:1], moved).collect()}
    assert got[9] == "block" and urls.judge(pages.where("false"), rules).count() == 0


def test_embeddings(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, None), (5, [0.0, 0.0]), (6, [inf, 1.0]),
            (7, [nan, 1.0]), (8, [None, 1.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (10, [1.0, 0.0]), (11, []),
            (12, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (13, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n_links", F.lit("x"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect()}
    for i in (1, 2, 3, 10, 13):
        assert got[i] == (4, 1, i == 1)
    for i in (4, 5, 6, 7, 8, 9, 11, 12):
        assert got[i] == (0, i, True)
    assert embeddings.near_duplicates(df.where("false")).count() == 0


def test_chat(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "<\\s>", "a\\", "<s>\n</s>", "[[INST]", "", "<<s>>"]
    for t in nasty:
        whole = chat.format_turn("user", t)[0] + chat.format_turn("assistant", t)[0] + chat.format_turn("a\n\\n", t)[0]
        assert chat.parse(whole) == [("user", t), ("assistant", t), ("a\n\\n", t)]
        body = chat.escape(t)
        assert not any(c in body for c in (chat.OPEN, chat.CLOSE, chat.ASK, chat.END_ASK))
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"),
            (3, 0, "user", "hi"), (3, 1, "assistant", "yes"), (4, 0, "user", None), (4, None, None, "first"),
            (None, 0, "user", "hi"), (5, 0, "user", "x"), (5, 0, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "path", F.lit("x"))
    nodes, paths = chat.prefix_tree(turns)
    n = {r.node_id: r for r in (x for x in nodes.collect())}
    assert len(n) == 7  # hi, hi>yes, hi>no, "" first, then user "", x, x>x
    p = {r.conv_id: r.path for r in paths.collect()}
    assert p[1] == p[3] and p[1][0] == p[2][0] == p[None][0] and len(p[5]) == 2
    ends = sorted((r.token_start, r.token_end) for r in n.values())
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    for r in n.values():
        assert r.token_end - r.token_start == len(r.text) and len(r.ancestors) == r.depth
        if r.parent_id is not None:
            parent = n[r.parent_id]
            assert r.ancestors[-1] == (parent.token_start, parent.token_end)
            assert r.position == parent.position + len(parent.text) and r.token_start >= parent.token_end
    got = {r.conv_id: r for r in chat.digests(chat.render(nodes, paths)).collect()}
    assert got[1].loss_sha256 == hashlib.sha256(b"yes").hexdigest() and got[2].loss_chars == 2
    assert got[4].turns_sha256 == hashlib.sha256(b"\nfirst\nuser\n\n").hexdigest() and got[5].n_turns == 2
    empty = chat.prefix_tree(turns.where("false"))
    assert chat.digests(chat.render(*empty)).count() == 0


def test_suffix(docs, none):
    rows = suffix.remove_repeats(docs).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(ROWS) and by_id[1].n_bytes == 0 and by_id[4].kept.decode() == LONG
    assert by_id[5].kept == b"" and by_id[5].spans == [(0, len(LONG))] and by_id[None].kept == b"a null id"
    assert suffix.remove_repeats(none).count() == 0


def test_packing_query_over_the_whole_table(spark):
    """Every column of the query against the tokenizer on every document."""
    import zlib

    from tokenizers import Tokenizer

    from cribble.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: [*e.ids, 2] for d, e in zip(docs, tok.encode_batch([d.text or "" for d in docs], add_special_tokens=False))}
    pieces, sequences = {}, set()
    for r in QUERIES["op7_packing"](spark, sf).collect():
        ids = np.array(want[r.doc_id][r.start:r.start + r.length], "<u4")
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id])
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 and r.sequence_id not in sequences
        sequences.add(r.sequence_id)
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    assert pieces.keys() == want.keys()
    for doc, p in pieces.items():
        p.sort()
        assert [s for s, _ in p] == np.cumsum([0, *[n for _, n in p]]).tolist()[:-1] and sum(n for _, n in p) == len(want[doc])


def test_words_of_latin_letters_equal_the_tokenizer():
    import random

    import pyarrow as pa
    from tokenizers import Tokenizer

    from cribble.llm.packing import WordTokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        ours = WordTokenizer(f.read())
    theirs = Tokenizer.from_file(path)
    rng = random.Random(2)
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100))]
    words = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 5, 9, 40]))) for _ in range(3000)]
    words += ["e" * 300, "Straße", "ÀÉÎ", "ÿŸ", "µª", "don't", "ab" * 400, "×", "a×b"]
    ids, counts = ours.encode(pa.array([*words, " ".join(words), None]))
    want = [theirs.encode(w, add_special_tokens=False).ids for w in (*words, " ".join(words))]
    assert counts.tolist() == [len(w) for w in want] + [0] and ids.tolist() == [i for w in want for i in w]


def test_id_cache_starts_anew_and_keeps_words_apart():
    import pyarrow as pa

    from cribble.llm.idcache import IdCache
    asked = []

    def encode(words):
        asked.extend(words)
        return [np.frombuffer(w.encode(), np.uint8).astype("<u4").tobytes() for w in words]

    cache = IdCache(encode, most=50)
    for turn in range(30):
        words = [f"w{i}" for i in range(turn, turn + 12)] + ["", "w0"]
        ids, start, size = cache.look(pa.array(words, pa.large_string()))
        for w, s, n in zip(words, start.tolist(), size.tolist()):
            assert bytes(ids[s:s + n].astype(np.uint8)) == w.encode()
    assert len(asked) < 30 * 13


def test_quality_patterns_stay_out_of_compiled_methods(spark):
    """With all patterns of the statistics in one compiled method executors passed their memory limit."""
    from cribble.llm import quality
    df = quality.with_stats(spark.createDataFrame([(1, "One two. Three")], "doc_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    patterns = [line for line in plan.splitlines() if "Generate inline" in line]
    assert patterns and not any("*(" in line for line in patterns)
    assert df.first()["stats"]["stops"] == 1 / 3
