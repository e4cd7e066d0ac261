"""The registered queries of the subpackage (thin: each applies one operator to its table)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cribble.llm import (
    bpe, chat, decontaminate, embeddings, jaccard, langid, lines, packing, periods, quality, suffix, trie, urls)
from cribble.llm.common import read_table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "bucket")


def remainder(column: str, n: int):
    return F.crc32(F.col(column).cast("string")) % n


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    model = langid.fit(docs.where(~held_out), "lang")
    return (langid.predict(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, len(s) AS n, array_to_string(s, ' ') AS win FROM (
    SELECT item_id, unnest([w[i + 1:i + 13] for i in range(0, greatest(len(w) - 12, 1))]) AS s
    FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
spots AS (
  SELECT doc_id, n, unnest(range(0, len(w) - n + 1)) AS p, w FROM t, sizes WHERE len(w) >= n),
hits AS (
  SELECT s.doc_id, s.p, s.n, v.item_id
  FROM (SELECT doc_id, p, n, array_to_string(w[p + 1:p + n], ' ') AS win FROM spots) s
  JOIN wins v ON v.win = s.win AND v.n = s.n),
cov AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
    SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY 1)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(t.w) AS contaminated
FROM t LEFT JOIN cov USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op10_decontamination", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.judge(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 read_table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), "contaminated")


@query("op2_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = quality.fit(docs.where(~held_out), read_table(spark, sf_dir, "labels"), "doc_id", "quality")
    return quality.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


# -- fixed values: the rules of the contract.
URL_RULES = [urls.Rule("allow", "org/"), urls.Rule("block", "example.org/es/"),
             urls.Rule("block", "example.org/en/1"), urls.Rule("allow", "com/fr/"), urls.Rule("block", "com/de/")]

_RULE_SQL = """
CASE WHEN (h = 'example.org' OR h LIKE '%.example.org') AND starts_with(p, '/en/1') THEN 'example.org/en/1'
     WHEN (h = 'example.org' OR h LIKE '%.example.org') AND starts_with(p, '/es/') THEN 'example.org/es/'
     WHEN (h = 'com' OR h LIKE '%.com') AND starts_with(p, '/fr/') THEN 'com/fr/'
     WHEN (h = 'com' OR h LIKE '%.com') AND starts_with(p, '/de/') THEN 'com/de/'
     WHEN (h = 'org' OR h LIKE '%.org') AND starts_with(p, '/') THEN 'org/' END
"""



def _sql_text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _links_sql() -> str:
    """The operator's edges: all canonical links and refreshes, entities decoded, resolved, dot segments carried out."""
    def value(tag: str, pattern: str) -> str:
        return "concat(" + ", ".join(f"regexp_extract({tag}, {_sql_text(pattern)}, {i})" for i in (1, 2, 3)) + ")"

    link = "l"
    for entity, char in urls.ENTITIES:
        link = f"replace({link}, {_sql_text(entity)}, {_sql_text(char)})"
    return rf"""
tags AS (
  SELECT url, {value('t', urls.HREF)} AS l FROM (
    SELECT url, unnest(regexp_extract_all(html, {_sql_text(urls.LINK_TAG)})) AS t FROM pages WHERE url IS NOT NULL)
  WHERE regexp_matches(t, {_sql_text(urls.IS_CANONICAL)})
  UNION ALL
  SELECT url, regexp_extract({value('t', urls.CONTENT)}, {_sql_text(urls.TARGET)}, 1) FROM (
    SELECT url, unnest(regexp_extract_all(html, {_sql_text(urls.META_TAG)})) AS t FROM pages WHERE url IS NOT NULL)
  WHERE regexp_matches(t, {_sql_text(urls.IS_REFRESH)})),
plain AS (SELECT url, trim({link}) AS l FROM tags),
based AS (
  SELECT url, l, regexp_extract(url, '^([\s\S]*?)://', 1) AS scheme,
         regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1) AS site, regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1) AS path
  FROM plain WHERE l <> '' AND NOT starts_with(l, '#')
    AND (NOT regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') OR regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://'))),
resolved AS (
  SELECT url, CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN l WHEN starts_with(l, '//') THEN scheme || ':' || l
    WHEN starts_with(l, '/') THEN scheme || '://' || site || l WHEN starts_with(l, '?') THEN scheme || '://' || site || path || l
    ELSE scheme || '://' || site || CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || l
    END AS target FROM based),
links AS (SELECT a.node AS a, b.node AS b FROM resolved r JOIN nodes a ON a.u = r.url JOIN nodes b ON b.u = r.target
          WHERE a.node IS NOT NULL AND b.node IS NOT NULL AND a.node <> b.node)"""


def _nodes_sql(source: str) -> str:
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    kept = ("list_reduce(list_concat([CAST([] AS VARCHAR[])], list_transform(string_split(regexp_replace(p, '^/', ''), '/'), lambda s: [s])), "
            "lambda acc, s: CASE WHEN s[1] = '..' THEN list_slice(acc, 1, greatest(len(acc) - 1, 0)) WHEN s[1] = '.' THEN acc "
            "ELSE list_concat(acc, s) END)")
    return rf"""
  SELECT u, CASE WHEN contains(u, '://') THEN lower(regexp_extract(u, '^([\s\S]*?)://', 1)) || '://' ||
    translate(regexp_extract(u, '^[\s\S]*?://([^/?#]*)', 1), {lower}) || '/' || array_to_string(segs, '/') ||
    CASE WHEN len(segs) > 0 AND regexp_matches(p, '(^|/)[.][.]?$') THEN '/' ELSE '' END ||
    regexp_extract(u, '^[\s\S]*?://[^/?#]*[^?#]*(\?[^#]*)', 1) END AS node
  FROM (SELECT *, {kept} AS segs FROM (
    SELECT u, regexp_extract(u, '^[\s\S]*?://[^/?#]*([^?#]*)', 1) AS p FROM ({source})))"""


OP3_SQL = rf"""
WITH RECURSIVE u AS (
  SELECT page_id, url, html,
    translate(regexp_extract(coalesce(url, ''), '^[\s\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS h,
    regexp_extract(coalesce(url, ''), '^[\s\S]*?://[^/?#]*([^?#]*)', 1) AS p FROM pages),
verdicts AS (SELECT *, CASE WHEN rule IS NULL THEN NULL WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
             ELSE 'block' END AS verdict_own FROM (SELECT *, RULE AS rule FROM u)),
{_links_sql().replace("links AS (", "nodes AS (NODES)," + chr(10) + "links AS (", 1).strip()},
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
judged AS (
  SELECT node, RULE AS rule FROM (SELECT DISTINCT node, regexp_extract(node, '^[\s\S]*?://([^/?#]*)', 1) AS h,
    regexp_extract(node, '^[\s\S]*?://[^/?#]*([^?#]*)', 1) AS p FROM nodes WHERE node IS NOT NULL)),
aliases AS (
  SELECT r.a, bool_or(j.rule IN ('org/', 'com/fr/')) AS allow, bool_or(j.rule NOT IN ('org/', 'com/fr/')) AS block
  FROM reach r JOIN judged j ON j.node = r.b WHERE j.rule IS NOT NULL GROUP BY 1)
SELECT page_id, h AS host, p AS path, rule,
  coalesce(verdict_own, CASE WHEN allow THEN 'allow' WHEN block THEN 'block' END, 'allow') AS verdict,
  CASE WHEN verdict_own IS NOT NULL THEN 'rule' WHEN allow OR block THEN 'alias' ELSE 'default' END AS reason
FROM verdicts v LEFT JOIN (SELECT DISTINCT u, node FROM nodes) n ON n.u = v.url LEFT JOIN aliases ON n.node = aliases.a
""".replace("RULE", _RULE_SQL).replace("NODES", _nodes_sql(
    "SELECT url AS u FROM pages WHERE url IS NOT NULL UNION SELECT target FROM resolved"))


@query("op3_url_filter", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read_table(spark, sf_dir, "pages"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "reason")


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
  least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id)) AS kept
FROM embeddings e
"""


@query("op9_embedding_dedup", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'),
            '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS esc FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(esc) + length(role) + CASE WHEN role = 'assistant' THEN 8 ELSE 23 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op4_chat_format", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.digests(chat.render(*chat.prefix_tree(turns.unionByName(extra))))


OP6_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest([array_to_string(w[i + 1:i + 3], ' ') for i in range(0, greatest(len(w) - 2, 1))]) AS sh
    FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id
    GROUP BY 1, 2) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * c >= 90 * (na.n + nb.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
  least(t.doc_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = t.doc_id), t.doc_id)) AS component_id
FROM t LEFT JOIN n USING (doc_id)
"""


@query("op6_jaccard_join", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similarity_classes(read_table(spark, sf_dir, "documents"), n=3, num=90, den=100)


@query("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the numbers of the removed ones and the characters that stay."""
    return lines.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed",
        F.coalesce(F.length("text"), F.lit(0)).alias("kept_chars"))


@query("op8_suffix_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix.remove_repeats(read_table(spark, sf_dir, "documents"), width=100)
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# -- fixed values: start and reversed polynomial of crc32 (4294967295, 3988292384).
OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS k,
         length(coalesce(text, '')) AS c
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'k': k, 'c': c} ORDER BY turn NULLS FIRST, k) AS ts FROM t GROUP BY 1),
h AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda x: CAST(ord(x) AS BIGINT))), lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
      lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 6 AS h FROM o),
r AS (
  SELECT o.conv_id, list_concat(CASE WHEN b.ts IS NULL THEN [] ELSE list_slice(b.ts, 1, h) END,
                                list_slice(o.ts, h + 1, len(o.ts))) AS ts
  FROM o JOIN h USING (conv_id) LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 100),
m AS (
  SELECT conv_id, d, array_to_string(list_transform(list_slice(ts, 1, d), lambda x: x.k), '') AS k,
         CASE WHEN d > 0 THEN ts[d].c ELSE 0 END AS c, d = len(ts) AS ends
  FROM (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM r)),
nodes AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n, max(c) AS c,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends) AS e FROM m GROUP BY d, k),
kids AS (SELECT substr(k, 1, 32 * (d - 1)) AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (k)),
sums AS (
  SELECT a AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n - 1) * c) AS saved
  FROM (SELECT *, unnest([substr(k, 1, 32 * j) for j in range(0, d + 1)]) AS a FROM full_nodes) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, s.n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.e, '')) AS ends_sha256
FROM full_nodes f JOIN sums s USING (k) LEFT JOIN nodes p ON f.d > 0 AND p.k = substr(f.k, 1, 32 * (f.d - 1))
"""


@query("op11_conversation_trie", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = trie.paths(read_table(spark, sf_dir, "conversations"))
    shared = F.crc32(F.col("conv_id").cast("string")) % 6
    return trie.prefix_trie(trie.share_openings(convs, 100, shared, 5))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document in ten gets a repeated tail first, as the contract says; runs are found in all."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(F.coalesce(h % 10 == 0, F.lit(False)), F.filter(
        F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    told = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w"))
    told = told.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    told = told.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("long"))
    tail = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    told = told.select("doc_id", F.when(F.col("n") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))
    runs = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return periods.collapse(told).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(F.array_join(runs, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("op13_byte_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), ranks, pattern)
    return bpe.decode(encoded, ranks, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
