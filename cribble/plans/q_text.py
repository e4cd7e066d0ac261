"""Registered text queries over the whole ``documents`` table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from cribble.functions import text as T
from cribble.functions.numeric import rnd, sql_rnd
from cribble.operators import lookup as LK
from cribble.operators import vectorize as V
from cribble.plans.registry import register
from cribble.sources import catalog


def _docs(spark, sf):
    return catalog.spread(catalog.table(spark, sf, "documents").select("doc_id", "text"))


@register("clean_text", ops=("N1", "N1c", "N1d", "S7"),
          sql=f"SELECT doc_id, {T.sql_clean_text('text')} AS text_clean FROM documents")
def q_clean_text(spark, sf):
    return T.with_clean_text(_docs(spark, sf), "text", "text_clean").select("doc_id", "text_clean")


@register("unit_glue", ops=("N1a",), sql=f"SELECT doc_id, {T.sql_glue_units('text')} AS glued FROM documents")
def q_unit_glue(spark, sf):
    return _docs(spark, sf).select("doc_id", T.glue_units("text").alias("glued"))


@register("strip_punct", ops=("N1b",),
          sql=f"SELECT doc_id, {T.sql_strip_punct(T.sql_glue_units('text'))} AS stripped FROM documents")
def q_strip_punct(spark, sf):
    return _docs(spark, sf).select("doc_id", T.strip_punct(T.glue_units("text")).alias("stripped"))


@register("tokenize", ops=("N1c",), sql=f"""
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS joined
FROM (SELECT doc_id, {T.sql_tokens(T.sql_strip_punct(T.sql_glue_units('text')))} AS toks FROM documents)""")
def q_tokenize(spark, sf):
    d = _docs(spark, sf).withColumn("toks", T.tokens(T.strip_punct(T.glue_units("text"))))
    return d.select("doc_id", F.size("toks").alias("n_tokens"), F.array_join("toks", " ").alias("joined"))


@register("stopword_filter", ops=("N1d", "N1e"), sql=f"""
SELECT doc_id, CAST(len({T.sql_clean_tokens('text')}) AS INTEGER) AS n_kept FROM documents""")
def q_stopword_filter(spark, sf):
    d = T.with_clean_tokens(_docs(spark, sf), "text", "toks")
    return d.select("doc_id", F.size("toks").alias("n_kept"))


@register("contamination_flag", ops=("N2",),
          sql=f"SELECT doc_id, {T.sql_contamination('text')} AS contamination FROM documents")
def q_contamination(spark, sf):
    return _docs(spark, sf).select("doc_id", T.contamination("text").alias("contamination"))


@register("condition_class", ops=("N3",),
          sql=f"SELECT doc_id, {T.sql_condition('text')} AS condition FROM documents")
def q_condition(spark, sf):
    return _docs(spark, sf).select("doc_id", T.condition("text").alias("condition"))


@register("extract_plant", ops=("N4",), sql=f"SELECT doc_id, {T.sql_plant('text')} AS plant FROM documents")
def q_plant(spark, sf):
    return _docs(spark, sf).select("doc_id", T.plant("text").alias("plant"))


@register("text_reduction", ops=("A27",), sql=f"""
SELECT doc_id, raw_words, clean_words, {T.sql_reduction_pct('raw_words', 'clean_words')} AS reduction_pct
FROM (SELECT doc_id, CAST(len({T.sql_whitespace_words('text')}) AS INTEGER) AS raw_words,
             CAST(len({T.sql_whitespace_words(T.sql_clean_text('text'))}) AS INTEGER) AS clean_words
      FROM documents)""")
def q_text_reduction(spark, sf):
    d = T.with_clean_text(_docs(spark, sf), "text", "clean").select(
        "doc_id", F.size(T.whitespace_words("text")).alias("raw_words"),
        F.size(T.whitespace_words("clean")).alias("clean_words"))
    return d.withColumn("reduction_pct", T.reduction_pct(F.col("raw_words"), F.col("clean_words")))


_VT = f"SELECT doc_id, {T.sql_vector_tokens(T.sql_clean_text('text'))} AS vt FROM documents"


@register("ngrams", ops=("N6",), sql=f"""
SELECT doc_id, CAST(len(vt) AS INTEGER) AS n_unigrams, CAST(len(ng) - len(vt) AS INTEGER) AS n_bigrams,
       array_to_string(ng, '|') AS terms
FROM (SELECT doc_id, vt, {T.sql_ngrams_1_2('vt')} AS ng FROM ({_VT}))""")
def q_ngrams(spark, sf):
    d = T.with_clean_text(_docs(spark, sf), "text", "clean").withColumn("vt", T.vector_tokens("clean"))
    d = T.with_ngrams_1_2(d, "vt", "ng")
    return d.select("doc_id", F.size("vt").alias("n_unigrams"),
                    (F.size("ng") - F.size("vt")).alias("n_bigrams"), F.array_join("ng", "|").alias("terms"))


def _word_frame(spark, sf, cols=("doc_id", "text")):
    """Vectorizer tokens of every document; single words and pairs are counted from them where they are needed."""
    d = catalog.spread(catalog.table(spark, sf, "documents").select(*cols))
    d = T.with_clean_text(d, "text", "clean").withColumn("vt", T.vector_tokens("clean"))
    return d.select(*[c for c in cols if c != "text"], "vt")


def _counted(d, toks):
    """Terms and counts of every document, persisted: the vocabulary fit and the transform share them."""
    return V.count_in_rows(d, ["doc_id"], toks).persist(StorageLevel.MEMORY_AND_DISK)


def _vocab_of(counted, n_docs):
    return V.fit_vocab(V.as_counts(counted, ["doc_id"]), n_docs)


_NG_SQL = f"""
d AS (SELECT doc_id, {T.sql_ngrams_1_2('vt')} AS ng FROM ({_VT})),
c AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(ng) AS term FROM d) GROUP BY doc_id, term),
s AS (SELECT term, count(*) AS df, sum(n) AS tf FROM c GROUP BY term HAVING count(*) >= 2
      ORDER BY tf DESC, term LIMIT 500),
nd AS (SELECT count(*)::DOUBLE AS n FROM documents)"""


@register("vocab", ops=("N7", "A14"), sql=f"""
WITH {_NG_SQL}
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, CAST(tf AS BIGINT) AS tf,
       {sql_rnd('ln((1 + nd.n) / (1 + df::DOUBLE)) + 1', 6)} AS idf
FROM s, nd""")
def q_vocab(spark, sf):
    counted = V.count_in_rows(_word_frame(spark, sf), ["doc_id"], "vt", pairs=True)  # read once: nothing is kept
    n_docs = catalog.table(spark, sf, "documents").count()
    return V.vocab_frame(spark, _vocab_of(counted, n_docs)).withColumn("idf", rnd("idf", 6))


@register("tfidf", ops=("N9", "J4"), sql=f"""
WITH {_NG_SQL},
w AS (SELECT c.doc_id, c.term, (1 + ln(c.n::DOUBLE)) * (ln((1 + nd.n) / (1 + s.df::DOUBLE)) + 1) AS w
      FROM c JOIN s USING (term), nd)
SELECT doc_id, term, {sql_rnd('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))', 6)} AS weight FROM w""")
def q_tfidf(spark, sf):
    words = _word_frame(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    counted = V.count_in_rows(words, ["doc_id"], "vt", pairs=True)
    vocab = _vocab_of(counted, words.count())
    return V.tfidf_rows(counted, "doc_id", vocab).select("doc_id", "term", rnd("weight", 6).alias("weight"))


@register("tfidf_unseen", ops=("N9",), sql=f"""
WITH vt AS (SELECT doc_id, lang, {T.sql_vector_tokens(T.sql_clean_text('text'))} AS vt FROM documents),
d AS (SELECT doc_id, lang, {T.sql_ngrams_1_2('vt')} AS ng FROM vt),
c AS (SELECT doc_id, lang, term, count(*) AS n FROM (SELECT doc_id, lang, unnest(ng) AS term FROM d)
      GROUP BY doc_id, lang, term),
s AS (SELECT term, count(*) AS df, sum(n) AS tf FROM c WHERE lang = 'en' GROUP BY term HAVING count(*) >= 2
      ORDER BY tf DESC, term LIMIT 500),
nd AS (SELECT count(*)::DOUBLE AS n FROM documents WHERE lang = 'en'),
w AS (SELECT c.doc_id, c.term, (1 + ln(c.n::DOUBLE)) * (ln((1 + nd.n) / (1 + s.df::DOUBLE)) + 1) AS w
      FROM c JOIN s USING (term), nd WHERE c.lang <> 'en')
SELECT doc_id, term, {sql_rnd('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))', 6)} AS weight FROM w""")
def q_tfidf_unseen(spark, sf):
    """Vocabulary fitted on English documents, applied to the others (unseen terms vanish)."""
    words = _word_frame(spark, sf, ("doc_id", "text", "lang")).persist(StorageLevel.MEMORY_AND_DISK)
    english, others = (words.where(c).select("doc_id", "vt") for c in (F.col("lang") == "en", F.col("lang") != "en"))
    vocab = _vocab_of(V.count_in_rows(english, ["doc_id"], "vt", pairs=True), english.count())
    return V.tfidf_rows(V.count_in_rows(others, ["doc_id"], "vt", pairs=True), "doc_id", vocab).select("doc_id", "term", rnd("weight", 6).alias("weight"))


@register("bow", ops=("N8",), sql=f"""
WITH u AS (SELECT doc_id, vt FROM ({_VT})),
c AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(vt) AS term FROM u) GROUP BY doc_id, term),
s AS (SELECT term FROM c GROUP BY term HAVING count(*) >= 2 ORDER BY sum(n) DESC, term LIMIT 500),
v AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx FROM s)
SELECT c.doc_id, c.term, v.idx, c.n FROM c JOIN v USING (term)""")
def q_bow(spark, sf):
    d = T.with_clean_text(_docs(spark, sf), "text", "clean").withColumn("vt", T.vector_tokens("clean"))
    counted = _counted(d, "vt")
    return V.bow_rows(counted, "doc_id", _vocab_of(counted, counted.count())).select("doc_id", "term", "idx", "n")


@register("token_counts", ops=("A13",), sql=f"""
SELECT term, count(*) AS n FROM (SELECT unnest({T.sql_whitespace_words('lower(text)')}) AS term FROM documents)
GROUP BY term""")
def q_token_counts(spark, sf):
    return V.corpus_counts(_docs(spark, sf), T.whitespace_words(F.lower("text")))


@register("top_tokens", ops=("L4",), sql=f"""
SELECT term, count(*) AS n FROM (SELECT unnest({T.sql_whitespace_words('lower(text)')}) AS term FROM documents)
GROUP BY term ORDER BY n DESC, term LIMIT 1000""")
def q_top_tokens(spark, sf):
    return V.top_terms(V.corpus_counts(_docs(spark, sf), T.whitespace_words(F.lower("text"))), 1000)


_WORDS_SQL = f"SELECT doc_id, {T.sql_clean_tokens('text')} AS toks FROM documents"


@register("lemma_lookup", ops=("N1e",), sql=f"""
WITH d AS ({_WORDS_SQL}), w AS (SELECT DISTINCT unnest(toks) AS w FROM d),
m AS (SELECT a.w AS word, b.w AS lemma FROM w a JOIN w b ON a.w = b.w || 's'),
t AS (SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM d),
j AS (SELECT doc_id, string_agg(coalesce(lemma, tok), ' ' ORDER BY i) AS lemmas, count(lemma) AS n_replaced
      FROM t LEFT JOIN m ON t.tok = m.word GROUP BY 1)
SELECT doc_id, coalesce(lemmas, '') AS lemmas, coalesce(n_replaced, 0) AS n_replaced FROM d LEFT JOIN j USING (doc_id)""")
def q_lemma_lookup(spark, sf):
    """Tokens looked up in a lemma table made from the texts: a word whose form without the last s is a word too
    becomes that one."""
    d = T.with_clean_tokens(_docs(spark, sf), "text", "toks").select("doc_id", "toks").persist(StorageLevel.MEMORY_AND_DISK)
    words = d.select(F.explode_outer("toks").alias("w")).where(F.col("w").isNotNull()).distinct()
    table = (words.select(F.col("w").alias("word"), F.regexp_extract("w", "^(.+)s$", 1).alias("lemma"))
             .join(words.select(F.col("w").alias("lemma")), "lemma").select("word", "lemma"))
    out = LK.lookup(d, "doc_id", "toks", table).join(d, "doc_id")
    changed = F.size(F.filter(F.zip_with("toks", "lemmas", lambda a, b: a != b), lambda x: x)).cast("long")
    return out.select("doc_id", F.coalesce(F.array_join("lemmas", " "), F.lit("")).alias("lemmas"),
                      F.when(F.col("toks").isNull(), F.lit(0)).otherwise(changed).alias("n_replaced"))


@register("distinct_texts", ops=("U5", "N5"), sql=f"""
SELECT text, {T.sql_clean_text('text')} AS text_clean, count(*) AS n_docs FROM documents GROUP BY text""")
def q_distinct_texts(spark, sf):
    d = _docs(spark, sf).groupBy("text").agg(F.count(F.lit(1)).alias("n_docs"))
    return T.with_clean_text(d, "text", "text_clean").select("text", "text_clean", "n_docs")


@register("text_feature_join", ops=("J1", "N5", "U5"), sql=f"""
WITH m AS (SELECT DISTINCT text, {T.sql_clean_text('text')} AS text_clean,
                  {T.sql_contamination('text')} AS contamination, {T.sql_condition('text')} AS condition
           FROM documents)
SELECT d.doc_id, d.lang, coalesce(m.text_clean, '') AS text_clean, m.contamination, m.condition
FROM documents d LEFT JOIN m ON d.text IS NOT DISTINCT FROM m.text""")
def q_text_feature_join(spark, sf):
    docs = catalog.spread(catalog.table(spark, sf, "documents").select("doc_id", "lang", "text"))
    mapping = T.with_clean_text(docs.select("text").distinct(), "text", "text_clean").select(
        F.col("text").alias("m_text"), "text_clean",
        T.contamination("text").alias("contamination"), T.condition("text").alias("condition"))
    j = docs.join(mapping, docs.text.eqNullSafe(mapping.m_text), "left")
    return j.select("doc_id", "lang", F.coalesce("text_clean", F.lit("")).alias("text_clean"),
                    "contamination", "condition")


@register("lexical_rule", ops=("N13", "J6"), sql=f"""
SELECT doc_id, {T.sql_lexical_category('toks')} AS lexical
FROM (SELECT doc_id, {T.sql_whitespace_words(T.sql_clean_text('text'))} AS toks FROM documents)""")
def q_lexical_rule(spark, sf):
    d = T.with_clean_tokens(_docs(spark, sf), "text", "toks")
    return d.select("doc_id", T.lexical_category(F.col("toks")).alias("lexical"))
