"""Alias links of all kinds of markup, read-back through intervals, clashing column names, ties at the thresholds."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cribble.llm import chat, decontaminate, embeddings, jaccard, langid, lines, quality, urls
from cribble.llm.queries import QUERIES, SQL

BAD = "http://b.com/de/2"
PAGES = [
    (1, "http://s1.net/a", f'<link rel="canonical" href="http://ok.net/1"><link rel="canonical" href="{BAD}">', "block"),
    (2, "http://s2.net/a", f"<META HTTP-EQUIV=refresh CONTENT=\"0;url='{BAD}'\">", "block"),
    (3, "http://s3.net/a", f"<meta content='5; URL={BAD}' http-equiv='Refresh'>", "block"),
    (4, "http://s4.net/a", f"<meta http-equiv=\"refresh\" content=\"0;url='http://x.com/y?a=1&amp;b=2'\">", "block"),
    (5, "http://x.com/y?a=1&b=2", f"<link href={BAD} rel=canonical>", "block"),
    (6, "http://c.com/en/x/y", "<link rel='canonical' href='../../de/2'>", "block"),
    (7, "http://c.com/de/2", None, "block"),
    (8, "http://s8.net/p/q?x", '<link rel="alternate canonical" href="?z=1">', "block"),
    (9, "http://s8.net/p/q?z=1", f'<link rel="canonical" href="{BAD}#part">', "block"),
    (10, "http://s10.net/a", f'<link rel="stylesheet" href="{BAD}"><a href="{BAD}">', "allow"),
    (11, "http://s11.net/a", '<link rel="canonical" href="#top"><link rel="canonical" href="mailto:x@y">', "allow"),
    (12, "HTTP://S12.net/a/./b", None, "block"),
    (13, "http://s12.net/a/b", f'<meta http-equiv="refresh" content="3;url={BAD}">', "block"),
    (14, "http://s14.net/a", '<meta http-equiv="refresh" content="30">', "allow"),
    (15, "http://s15.net/", "<link rel=canonical href=//b.com/de/2>", "block"),
    (16, "http://s16.net/x", "<link rel=canonical href='y/..'>", "block"),
    (17, "http://s16.net/", f"<link rel=canonical href='{BAD}'>", "block"),
    (18, None, f"<link rel=canonical href='{BAD}'>", "allow"),
    (19, "http://s19.org/x", f"<link rel=canonical href='http://s20.net/'>", "allow"),
    (20, "http://s20.net/", f"<link rel=canonical href='{BAD}2'>", "allow"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([p[:3] for p in PAGES], "page_id long, url string, html string")


def test_every_kind_of_link(spark, pages, tmp_path):
    import duckdb
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op3_url_filter"](spark, str(tmp_path))
    rows = {r.page_id: r for r in got.collect()}
    assert {i: r.verdict for i, r in rows.items()} == {p[0]: p[3] for p in PAGES}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(SQL["op3_url_filter"])
    names = [c[0] for c in want.description]
    assert sorted(repr(tuple(r[c] for c in names)) for r in rows.values()) == sorted(repr(r) for r in want.fetchall())


def test_long_html_and_results_named_like_columns(pages):
    clash = pages.withColumn("html", F.concat(F.lit("<p>" * 200_000), "html")).select(
        "*", *[F.lit("own").alias(c) for c in ("node", "own", "allow", "row", "rule", "_node", "_own", "link")])
    got = urls.judge(clash, [urls.Rule("block", "com/de/"), urls.Rule("allow", "org/")]).collect()
    assert {r.page_id: r.verdict for r in got} == {p[0]: p[3] for p in PAGES}
    assert all(r.node == r.own == r.allow == r.row == r._node == r.link == "own" and r.rule != "own" for r in got)


def test_dot_segments(spark):
    cases = {"": "/", "/": "/", "/a/../b": "/b", "/a/./b/": "/a/b/", "/../..": "/", "/a/b/..": "/a/", "/a/.": "/a/", "/..a": "/..a"}
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    assert {r.p: r.o for r in df.select("p", urls.without_dots(F.col("p")).alias("o")).collect()} == cases


def test_read_back_uses_the_intervals(spark):
    rng = np.random.default_rng(1)
    rows = []
    for c in range(40):
        for t in range(int(rng.integers(1, 6))):
            rows.append((c, t, ["user", "assistant"][t % 2], f"text {int(rng.integers(0, 3))}"))
    rows += [(99, t, ["user", "assistant"][t % 2], f"long {t}") for t in range(1500)] + [(98, 0, "user", "x" * 300_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes, paths = chat.prefix_tree(turns)
    got = {r.conv_id: r for r in chat.digests(chat.render(nodes, paths)).collect()}
    for c in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == c]
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r[2]}\n{r[3]}\n" for r in own).encode()).hexdigest()
        assert got[c].n_turns == len(own) and got[c].loss_chars == sum(len(r[3]) for r in own if r[2] == "assistant")
    # an interval moved to another node's place is seen in what is read back
    two = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "c")], turns.schema)
    nodes, paths = chat.prefix_tree(two)
    n = {r.text: r for r in nodes.collect()}
    a, b, c = (next(r for t, r in n.items() if f"\n{x} " in t) for x in "abc")
    moved = nodes.withColumn("ancestors", F.when(F.col("node_id") == F.lit(bytes(b.node_id)), F.array(F.struct(
        F.lit(c.token_start).alias("start"), F.lit(c.token_end).alias("end")))).otherwise(F.col("ancestors")))
    text = {r.conv_id: "".join(s.text for s in r.segments) for r in chat.render(moved, paths).collect()}
    assert text[1] == c.text + b.text and text[2] == c.text


CLASH = ["_t", "_k", "_d", "_key", "_gone", "_letter", "_stats", "_raw", "_text", "row", "stats", "key", "id", "d", "t", "gone", "n",
         "chars", "words", "hit_words", "found_items", "document", "text_hash", "removed", "items", "score", "lid", "rep", "group"]


def test_columns_of_any_name_pass_through(spark):
    text = "The quick brown fox jumps over the lazy dog and runs away.\nA second line that stands alone here.\n"
    docs = spark.createDataFrame([(i, text + f"number {i}") for i in range(6)], "doc_id long, text string").select(
        "*", *[F.lit(f"own {c}").alias(c) for c in CLASH])
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    model = langid.fit(docs.select("text", F.lit("en").alias("lang")), "lang")
    cases = [(quality.score(docs, quality.fit(docs, labels, "doc_id", "quality")), {"score"}),
             (lines.dedup_lines(docs), {"removed"}), (decontaminate.judge(docs, items), {"items"}),
             (langid.predict(docs, model), {"score"})]
    for out, replaced in cases:
        for r in out.collect():
            assert all(r[c] == f"own {c}" for c in CLASH if c not in replaced)


def test_pipeline_stages_keep_the_columns_of_the_input(spark, tmp_path):
    import corpus_pipeline as P
    words = [f"word{i}" for i in range(200)]
    rows = [(i, " ".join(words[i:i + 60]) + ".\nshared line of the page footer\n", "en", "s", 400) for i in range(0, 140, 2)]
    rows += [(None, None, None, None, None), (200, "", "en", "s", 0), (200, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(
        "*", *[F.lit(f"own {c}").alias(c) for c in CLASH])
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(0, 140, 2)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(words[:30])), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, fn in P.STAGES[:-1]:
        for given in (docs, docs.where("false")):
            out = fn(spark, given, str(tmp_path))
            assert out.columns == docs.columns, name
            assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASH), name
    packed = P.pack_documents(spark, docs, str(tmp_path))
    assert packed.where("doc_id = 200").count() == 2 and P.pack_documents(spark, docs.where("false"), str(tmp_path)).count() == 0


# ------------------------------------------------------------ ties

def test_jaccard_at_exactly_ninety_in_a_hundred(spark):
    words = [f"w{i}" for i in range(60)]
    a = " ".join(words[:21])                    # 19 shingles
    b = " ".join(words[:20])                    # 18 of them: 18 / 19 links
    c = " ".join(words[30:40]) + " x"           # 9 shingles
    d = " ".join(words[30:40]) + " x y"         # 10, all of c's: 9 / 10 links
    e = " ".join(words[45:54]) + " x"           # 8
    f = " ".join(words[45:54]) + " x y"         # 9: 8 / 9 does not
    df = spark.createDataFrame(list(enumerate((a, b, c, d, e, f))), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.similarity_classes(df).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5}


def test_cosine_just_above_and_below_nine_tenths(spark):
    def at(c):
        return [c, float(np.sqrt(1 - c * c))]

    rows = [(1, [1.0, 0.0]), (2, at(0.9 + 1e-12)), (3, [0.0, 0.0, 1.0, 0.0]), (4, [0.0, 0.0, *at(0.9 - 1e-12)])]
    got = {r.vec_id: r.component_id for r in embeddings.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>"), recall=0.999999).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_one_word_in_twenty(spark):
    item = spark.createDataFrame([(1, "needle")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "needle " + "hay " * 19), (2, "needle " + "hay " * 20)], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_words, r.contaminated) for r in decontaminate.judge(docs, item).collect()}
    assert got == {1: (1, 20, True), 2: (1, 21, False)}


def test_score_at_exactly_the_threshold(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    at = quality.RuleModel(0.0)
    assert {r.predicted for r in quality.score(docs, at, threshold=0.5).collect()} == {1}
    assert {r.predicted for r in quality.score(docs, at, threshold=0.5000001).collect()} == {0}


# ------------------------------------------------------------ compiled rules and the quality plan

def test_compiled_rules_equal_the_trees(spark):
    """Scores of the compiled expression against a plain evaluation of the rules on statistics taken in Python."""
    import regex
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abc DEF 12.,!?\n#é"), int(rng.integers(0, 200)))) for _ in range(60)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int((texts[i] or "").count("a") > 6)) for i in range(60)], "doc_id long, quality int")
    model = quality.fit(docs, labels, "doc_id", "quality")
    assert model.rules

    def stats(t):
        t = t or ""
        n = lambda p: float(len(regex.findall(p, t)))
        chars, space, words = float(len(t)), n(r"[ \t\n\x0b\f\r]"), n(r"[^ \t\n\x0b\f\r]+")
        c, w = max(chars, 1), max(words, 1)
        parts = regex.split(r"[ \t\n\x0b\f\r]+", t)
        return [np.log1p(chars), n(r"\p{Lu}") / c, n(r"[^\p{L}\p{N}\s]") / c, n(r"\p{N}") / c, space / c, (chars - space) / w,
                min(len(set(parts)), words) / w, n(r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)") / w,
                n(r"(?<![\p{L}\p{N}])\p{L}{1,3}(?![\p{L}\p{N}])") / w, n(r"[.?!]") / w,
                np.log1p(chars / (n(r"\n") + 1)), n(r"[#$%&*|]") / c]

    for r in quality.score(docs, model).collect():
        s = stats(r.text)
        z = model.intercept + sum(rule.weight for rule in model.rules
                                  if all((s[i] <= t) if below else (s[i] > t) for i, below, t in rule.conditions))
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9


def test_each_pattern_stands_once_under_a_filter(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = quality.RuleModel(0.1, [quality.Rule(((1, True, 0.2), (2, False, 0.01)), 1.0), quality.Rule(((1, False, 0.1),), -1.0)])
    plan = quality.score(docs, model).where("predicted = 1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"\p{Lu}") == 1 and plan.count("Generate") == 2


# ------------------------------------------------------------ language model: every label, folded weights

def test_labels_of_copies_and_many_labels_all_teach(spark):
    rng = np.random.default_rng(5)
    alphabets = {f"l{i}": [chr(c) for c in rng.choice(np.arange(0x61, 0x17F), 14, replace=False)] for i in range(12)}

    def text(lang):
        return " ".join("".join(rng.choice(alphabets[lang], 5)) for _ in range(30))

    few = [text("l0"), text("l0")]
    rows = [(few[i % 2], "l0") for i in range(3000)] + [(text(w), w) for w in alphabets for _ in range(15) if w != "l0"]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), "lang", per_label=50)
    assert model.langs == sorted(alphabets)
    held = spark.createDataFrame([(w, text(w)) for w in alphabets for _ in range(5)], "want string, text string")
    got = langid.predict(held, model).collect()
    assert np.mean([r.lang_pred == r.want for r in got]) > 0.9
    # folded weights against the kernel itself, on texts of any length
    x = ["abc", "a" * 5000, text("l3") * 40]
    p = [langid.presence(model.kernel, np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t in x]
    direct = [(v.astype(float) / np.sqrt(max(v.sum(), 1))) @ model.weights + model.bias for v in p]
    scored = {r.text: r for r in langid.predict(spark.createDataFrame([(t,) for t in x], "text string"), model).collect()}
    assert all(scored[t].lang_pred == model.langs[int(np.argmax(o))] for t, o in zip(x, direct))
