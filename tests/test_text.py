"""Golden text pairs (FIXTURES F2) for cleaning and rule extraction."""

import pytest
from pyspark.sql import functions as F

from cribble.functions import text as T


def _run(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


def _clean(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["c"] for r in T.with_clean_text(df, "t", "c").orderBy("i").collect()]


def test_clean_blank_and_null(spark):
    assert _clean(spark, ["", None, "   "]) == ["", "", ""]


def test_clean_lower_and_stopwords(spark):
    out = _clean(spark, ["LOT DE PAPIER", "le la les de du des", "lot collecte rapport matériau",
                         "métal conducteur rigide", "plastique, rigide! conducteur?",
                         "Le matériau collecté est un métal conducteur."])
    assert out[0] == out[0].lower() and "papier" in out[0]
    assert out[1] == ""
    assert out[2] == ""
    assert out[3] == "métal conducteur rigide"
    assert not any(ch in out[4] for ch in ",!?")
    assert out[5] == "métal conducteur"


def test_column_and_frame_forms_agree(spark):
    texts = ["Le matériau collecté est un métal conducteur.", "45.8 kg de PET, 12 cm", None, "  "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(texts)], "i int, t string")
    a = [r[0] for r in df.orderBy("i").select(T.clean_text("t")).collect()]
    b = [r["c"] for r in T.with_clean_text(df, "t", "c").orderBy("i").collect()]
    assert a == b


def test_unit_glue(spark):
    assert _run(spark, ["45.8 kg"], T.glue_units) == ["45.8kg"]


@pytest.mark.parametrize("text,flag", [
    ("Légère contamination observée", 1), ("Traces de rouille présentes", 1), ("Matériau souillé", 1),
    ("SOUILLÉ", 1), ("Matériau en bon état", 0), ("Plastique propre", 0), (None, 0)])
def test_contamination(spark, text, flag):
    assert _run(spark, [text], T.contamination) == [flag]


@pytest.mark.parametrize("text,cls", [
    ("Brisé en plusieurs morceaux", "Brisé"), ("matériau cassé", "Brisé"), ("Matériau neuf, intact", "Neuf"),
    ("État moyen, légèrement usé", "Moyen"), ("description quelconque", "Inconnu"), (None, "Inconnu"),
    ("cassé mais neuf", "Brisé")])
def test_condition(spark, text, cls):
    assert _run(spark, [text], T.condition) == [cls]


@pytest.mark.parametrize("text,plant", [("usine Alpha", "Alpha"), ("Usine Alpha", ""), ("usine A", ""),
                                        ("site Beta-2 nord", "Beta-"), ("provenance : Gamma", "Gamma")])
def test_plant(spark, text, plant):
    assert _run(spark, [text], T.plant) == [plant]


def test_lexical_rule(spark):
    df = spark.createDataFrame([("ferraille conducteur lourde",), ("verre transparent",), ("rien",)], "t string")
    out = [r[0] for r in df.select(T.lexical_category(T.whitespace_words("t"))).collect()]
    assert out == ["Métal", "Verre", None]


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    out = [r[0] for r in df.select(T.ngrams_1_2(F.col("t"))).collect()]
    assert out == [["a", "b", "c", "a b", "b c"], ["a"], []]


def test_ngram_forms_agree(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    a = [r[0] for r in df.select(T.ngrams_1_2(F.col("t"))).collect()]
    b = [r["ng"] for r in T.with_ngrams_1_2(df, "t", "ng").collect()]
    assert a == b


def test_lexical_category_counts_tokens_with_a_keyword_inside(spark):
    """A keyword that only appears across two tokens counts nothing; a token counts once for each keyword inside it."""
    cases = [(["fer", "ferraille", "verre"], "Métal"), (["verre", "papier"], "Verre"), (["fe", "r"], None), (["a", None], None),
             ([], None), (None, None), (["cartonné", "pet", "pet"], "Plastique"), (["cartonné", "pet"], "Papier"), (["pe t"], None)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, toks array<string>")
    got = {r.i: r.c for r in df.select("i", T.lexical_category(F.col("toks")).alias("c")).collect()}
    assert [got[i] for i in range(len(cases))] == [c for _, c in cases]
    assert "aggregate(" not in df.select(T.lexical_category(F.col("toks")))._jdf.queryExecution().toString()
