"""Text column expressions and their SQL twins.

All cleaning runs as built-in Spark expressions (regexp_replace, split,
filter, transform, array_join), i.e. inside whole-stage codegen with no
Python in the row path.  Python's regex classes are Unicode-aware while
Java's ``\\s``/``\\d``/``\\w`` are ASCII, so patterns are rewritten to explicit
Unicode classes that Java and RE2 read the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import NGram, StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cribble.functions import fixed

# Python's \s: ASCII controls, FS/GS/RS/US, NEL and every Unicode separator.
WS = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z} "
WORD = r"\p{L}\p{N}_"
DIGIT = r"\p{Nd}"


def engine_regex(pattern: str) -> str:
    """Rewrite Python's Unicode ``\\s``/``\\d`` classes for Java and RE2."""
    return pattern.replace(r"\s", f"[{WS}]").replace(r"\d", DIGIT)


UNIT_RE = engine_regex(fixed.UNIT_PATTERN)
PUNCT_RE = f"[^{WORD}{WS}]"
SPLIT_RE = f"[{WS}]+"
BLANK_RE = f"^[{WS}]*$"
ISDIGIT_RE = r"^[\p{Nd}¹²³]+$"
VECTOR_TOKEN_RE = f"[{WORD}]{{2,}}"
STOPWORDS = list(dict.fromkeys(fixed.FRENCH_STOPWORDS + fixed.DOMAIN_STOPWORDS))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def glue_units(text: Column | str) -> Column:
    return F.regexp_replace(F.lower(_c(text)), UNIT_RE, "$1$2")


def strip_punct(text: Column) -> Column:
    return F.regexp_replace(text, PUNCT_RE, " ")


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPLIT_RE), lambda t: F.length(t) > 0)


def keep_token(t: Column, stop: Column) -> Column:
    return ~F.array_contains(stop, t) & ((F.length(t) > 2) | t.rlike(ISDIGIT_RE))


def clean_tokens(text: Column | str, stopwords: list[str] | None = None,
                 lemmas: Column | None = None) -> Column:
    """Token array of the cleaned report (N1a-N1e)."""
    stop = F.array(*[F.lit(w) for w in (stopwords if stopwords is not None else STOPWORDS)])
    toks = F.filter(tokens(strip_punct(glue_units(text))), lambda t: keep_token(t, stop))
    if lemmas is not None:
        toks = F.transform(toks, lambda t: F.coalesce(F.try_element_at(lemmas, t), t))
    return toks


def clean_text(text: Column | str, stopwords: list[str] | None = None, lemmas: Column | None = None) -> Column:
    """Cleaned report: null/blank -> ''; lower; units glued; punctuation -> space;
    tokens without stop words, kept if longer than 2 or all digits; space-joined (N1)."""
    t = _c(text)
    return F.when(t.isNull() | t.rlike(BLANK_RE), F.lit("")).otherwise(
        F.array_join(clean_tokens(t, stopwords, lemmas), " "))


def with_clean_tokens(df: DataFrame, text: str, out: str, stopwords: list[str] | None = None,
                      lemmas: Column | None = None) -> DataFrame:
    """DataFrame form of ``clean_tokens``: the stop-word test runs in Spark ML's
    ``StopWordsRemover`` (a JVM hash set) instead of a per-token scan of a
    literal array; the length rule stays a built-in ``filter``."""
    raw = f"__{out}_raw"
    sw = f"__{out}_sw"
    staged = df.withColumn(raw, tokens(strip_punct(glue_units(text))))
    remover = StopWordsRemover(inputCol=raw, outputCol=sw, caseSensitive=True,
                               stopWords=stopwords if stopwords is not None else STOPWORDS)
    kept = F.filter(F.col(sw), lambda t: (F.length(t) > 2) | t.rlike(ISDIGIT_RE))
    if lemmas is not None:
        kept = F.transform(kept, lambda t: F.coalesce(F.try_element_at(lemmas, t), t))
    return remover.transform(staged).withColumn(out, kept).drop(raw, sw)


def with_clean_text(df: DataFrame, text: str, out: str, stopwords: list[str] | None = None,
                    lemmas: Column | None = None) -> DataFrame:
    """DataFrame form of ``clean_text``."""
    toks = f"__{out}_toks"
    staged = with_clean_tokens(df, text, toks, stopwords, lemmas)
    t = F.col(text)
    return staged.withColumn(out, F.when(t.isNull() | t.rlike(BLANK_RE), F.lit("")).otherwise(
        F.array_join(F.col(toks), " "))).drop(toks)


def contamination(text: Column | str) -> Column:
    """1 when a contamination stem occurs (case-insensitive, Unicode), else 0; null -> 0."""
    t = _c(text)
    return F.when(t.isNull(), F.lit(0)).otherwise(t.rlike(f"(?iu){fixed.CONTAMINATION}").cast("int"))


def condition(text: Column | str) -> Column:
    """First matching condition class on the lower-cased text."""
    t = F.lower(_c(text))
    expr = None
    for name, pat in fixed.CONDITIONS:
        cond = t.rlike(pat)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.when(_c(text).isNull(), F.lit(fixed.CONDITION_DEFAULT)).otherwise(
        expr.otherwise(F.lit(fixed.CONDITION_DEFAULT)))


def plant(text: Column | str) -> Column:
    """Plant name from the first matching pattern (group 1), else '' (N4)."""
    t = _c(text)
    parts = [F.nullif(F.regexp_extract(t, engine_regex(p), 1), F.lit("")) for p in fixed.PLANT_PATTERNS]
    return F.coalesce(*parts, F.lit(""))


def vector_tokens(text: Column | str) -> Column:
    """Vectorizer tokens: runs of >= 2 word characters of the lower-cased text."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(VECTOR_TOKEN_RE), 0)


def bigrams(toks: Column) -> Column:
    n1 = F.greatest(F.size(toks) - 1, F.lit(0))
    return F.zip_with(F.slice(toks, 1, n1), F.slice(toks, 2, n1), lambda a, b: F.concat_ws(" ", a, b))


def ngrams_1_2(toks: Column) -> Column:
    return F.concat(toks, bigrams(toks))


def with_ngrams_1_2(df: DataFrame, toks: str, out: str) -> DataFrame:
    """DataFrame form of ``ngrams_1_2``: bigrams from Spark ML's ``NGram`` (JVM), then
    unigrams followed by bigrams, as the column form produces them."""
    tmp = f"__{out}_bi"
    bi = NGram(n=2, inputCol=toks, outputCol=tmp).transform(df)
    return bi.withColumn(out, F.concat(F.col(toks), F.col(tmp))).drop(tmp)


def whitespace_words(text: Column | str) -> Column:
    """Python ``str.split()``: whitespace-separated words, no empties."""
    return tokens(F.coalesce(_c(text), F.lit("")))


def lexical_category(toks: Column) -> Column:
    """Keyword score per category (+1 per token/keyword with keyword inside token);
    highest score wins, ties in category order; no hit -> NULL (N13, J6)."""
    # a keyword is looked for in the joined tokens first; tokens are counted one by one only where it occurs
    def hits(words: Column, joined: Column, k: str) -> Column:
        return F.when(F.contains(joined, F.lit(k)), F.size(F.filter(words, lambda t: F.instr(t, F.lit(k)) > 0))).otherwise(F.lit(0))

    def named(scores: Column) -> Column:
        best, expr = F.array_max(scores), None
        for i, (cat, _) in enumerate(fixed.KEYWORDS):
            cond = (scores[i] == best) & (best > 0)
            expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
        return expr

    return _let(toks, lambda words: _let(F.array_join(words, " "), lambda joined: _let(
        F.array(*[sum((hits(words, joined, k) for k in kws[1:]), hits(words, joined, kws[0])) for _, kws in fixed.KEYWORDS]),
        named)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def reduction_pct(raw_words: Column, clean_words: Column) -> Column:
    """int((1 - clean/max(raw, 1)) * 100), truncated toward zero."""
    return ((F.lit(1.0) - clean_words.cast("double") / F.greatest(raw_words, F.lit(1)).cast("double"))
            * F.lit(100.0)).cast("int")


# ------------------------------------------------------------------ DuckDB twins

def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def sql_glue_units(x: str) -> str:
    return f"regexp_replace(lower({x}), '{UNIT_RE}', '\\1\\2', 'g')"


def sql_strip_punct(x: str) -> str:
    return f"regexp_replace({x}, '{PUNCT_RE}', ' ', 'g')"


def sql_tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{SPLIT_RE}'), lambda t: length(t) > 0)"


def sql_clean_tokens(x: str) -> str:
    stop = _sql_list(STOPWORDS)
    return (f"list_filter({sql_tokens(sql_strip_punct(sql_glue_units(x)))}, lambda t: NOT list_contains({stop}, t) "
            f"AND (length(t) > 2 OR regexp_matches(t, '{ISDIGIT_RE}')))")


def sql_clean_text(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR regexp_matches({x}, '{BLANK_RE}') THEN '' "
            f"ELSE array_to_string({sql_clean_tokens(x)}, ' ') END")


def sql_contamination(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 0 ELSE CAST(regexp_matches({x}, '{fixed.CONTAMINATION}', 'i') AS INTEGER) END"


def sql_condition(x: str) -> str:
    whens = " ".join(f"WHEN regexp_matches(lower({x}), '{p}') THEN '{n}'" for n, p in fixed.CONDITIONS)
    return f"CASE WHEN {x} IS NULL THEN '{fixed.CONDITION_DEFAULT}' {whens} ELSE '{fixed.CONDITION_DEFAULT}' END"


def sql_plant(x: str) -> str:
    parts = [f"nullif(regexp_extract({x}, '{engine_regex(p)}', 1), '')" for p in fixed.PLANT_PATTERNS]
    return f"coalesce({', '.join(parts)}, '')"


def sql_vector_tokens(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '{VECTOR_TOKEN_RE}', 0)"


def sql_ngrams_1_2(toks: str) -> str:
    return (f"list_concat({toks}, list_transform(range(1, greatest(len({toks}), 1)), "
            f"lambda i: {toks}[i] || ' ' || {toks}[i + 1]))")


def sql_whitespace_words(x: str) -> str:
    return sql_tokens(f"coalesce({x}, '')")


def sql_lexical_category(toks: str) -> str:
    scores = []
    for cat, kws in fixed.KEYWORDS:
        s = (f"coalesce(list_sum(list_transform({toks}, lambda t: len(list_filter({_sql_list(kws)}, "
             f"lambda k: contains(t, k))))), 0)")
        scores.append((cat, s))
    best = f"greatest({', '.join(s for _, s in scores)})"
    whens = " ".join(f"WHEN {s} = {best} AND {best} > 0 THEN '{cat}'" for cat, s in scores)
    return f"CASE {whens} END"


def sql_reduction_pct(raw: str, clean: str) -> str:
    return f"CAST(trunc((1.0::DOUBLE - ({clean})::DOUBLE / greatest({raw}, 1)::DOUBLE) * 100.0::DOUBLE) AS INTEGER)"
