"""The corpus pipeline, stage by stage, on the small tables."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from cribble.llm.common import stage


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = {}
    for name, fn in corpus_pipeline.STAGES[:-1]:
        docs = stage(fn(spark, docs, sf), "test")
        assert docs.columns == columns and 0 < docs.count() <= before, name
        before = docs.count()
        texts[name] = {r.doc_id: r.text for r in docs.collect()}
    kept = texts["quality classifier"]
    judged = [(d in kept, q) for d, q in label.items()]
    assert sum(k == bool(q) for k, q in judged) >= 0.95 * len(judged)
    assert texts["line dedup"].keys() == kept.keys()
    assert texts["n-gram jaccard join"].keys() <= kept.keys()
    last = texts["benchmark decontamination"]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for t in last.values())
    assert {p.doc_id for p in pieces} == last.keys() and sum(p.length for p in pieces) == total


def test_copies_and_odd_rows(spark, sf):
    """Of exact copies one document stays; null texts and null ids pass the near-copy stage."""
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, text, 1), (2, text, 2), (2, text, 2), (3, None, 3), (None, text, 4), (4, "", 5)],
                                 "doc_id long, text string, extra int")
    rows = corpus_pipeline.drop_near_copies(spark, docs, sf).collect()
    assert sorted(r.extra for r in rows) == [1, 3, 4, 5]
    assert corpus_pipeline.drop_near_copies(spark, docs.where("false"), sf).count() == 0
