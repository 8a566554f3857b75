"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat_format, decontam, exact_dedup, hard_negatives, langid, ngram_join, packing, prefix_trie, quality, secret_scan, suffix_dedup, toxicity, url_filter
from .common import table

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
#: The conversation whose texts look like the template's own control strings.
FAKE_CONTROL = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"), keep="max")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("row")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fake = spark.createDataFrame(FAKE_CONTROL, "conv_id long, turn long, role string, text string")
    return chat_format.format_conversations(rows.unionByName(fake))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats(table(spark, sf_dir, "documents")).drop("spans")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.forked(prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.whole_vectors(table(spark, sf_dir, "embeddings"), label=label)
    return hard_negatives.hard_negatives(vectors, F.col("id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_ngram_jaccard_join, op3_toxicity, op4_chat_format, op5_language_id, op6_packing, op7_secret_scan,
                                   op8_url_filter, op9_decontamination, op10_quality, op11_suffix_dedup, op12_prefix_trie, op13_hard_negatives)}

_OP1 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size,
       t.doc_id IS NOT DISTINCT FROM g.keep_id AND row_number() OVER (PARTITION BY t.text, t.doc_id) = 1 AS kept,
       sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text
"""

_OP4 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
e AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?(INST|ROLE)\b')) AS chars FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6
                        ELSE 16 + length(role) + len(regexp_extract_all(role, '[\\<\[\]]')) END)::BIGINT AS formatted_chars,
       false AS rewrites
FROM e GROUP BY conv_id
"""

_OP8 = """
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN url[position('://' IN url) + 3:] ELSE '' END AS tail FROM pages),
u AS (
  SELECT page_id, translate(regexp_extract(tail, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(tail, '^([^/?#]*)([^?#]*)', 2) AS path FROM p),
r(verdict, r_host, r_path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
hit AS (
  SELECT DISTINCT u.host, u.path, r.* FROM (SELECT DISTINCT host, path FROM u) u JOIN r
  ON (u.host = r.r_host OR ends_with(u.host, '.' || r.r_host)) AND starts_with(u.path, r.r_path)),
best AS (
  SELECT host, path, r_host || r_path AS rule, verdict FROM hit
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(r_host || r_path) DESC, length(r_host) DESC, verdict DESC) = 1)
SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.verdict, 'allow') AS verdict
FROM u LEFT JOIN best ON u.host = best.host AND u.path = best.path
"""

_OP12 = """
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS n FROM own GROUP BY conv_id),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM sizes, crc_table),
turns AS (
  SELECT c.conv_id, o.place - c.h + least(c.h, coalesce(b.n, 0)) + 1 AS depth, o.role, o.text
  FROM own o JOIN convs c ON o.conv_id = c.conv_id AND o.place >= c.h LEFT JOIN sizes b ON b.conv_id = c.base
  UNION ALL
  SELECT c.conv_id, o.place + 1, o.role, o.text FROM own o JOIN convs c ON o.conv_id = c.base AND o.place < c.h),
paths AS (
  SELECT conv_id, depth, strlen(text) AS bytes, string_agg(md5(role || chr(10) || text), '') OVER w AS k
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY depth)
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
nodes AS (
  SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved, substr(k, 1, length(k) - 32) AS parent
  FROM paths GROUP BY depth, k),
kids AS (SELECT parent AS k, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent),
sums AS (
  SELECT a.k, sum((kids.k IS NULL)::INT)::BIGINT AS n_leaves, sum(v.saved)::BIGINT AS saved_tokens
  FROM nodes v JOIN paths a ON a.conv_id = v.conv_id AND a.depth <= v.depth LEFT JOIN kids ON kids.k = v.k GROUP BY a.k),
ends AS (
  SELECT k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS h
  FROM paths WHERE (conv_id, depth) IN (SELECT conv_id, max(depth) FROM paths GROUP BY conv_id) GROUP BY k)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(kids.n, 0) AS n_children, sums.n_leaves, sums.saved_tokens,
       coalesce(ends.h, sha256('')) AS ends_sha256
FROM nodes v JOIN sums ON sums.k = v.k LEFT JOIN kids ON kids.k = v.k LEFT JOIN ends ON ends.k = v.k
LEFT JOIN nodes p ON v.depth > 0 AND p.k = v.parent
"""

_OP13 = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS n
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
p AS (
  SELECT a.vec_id AS anchor_id, a.n AS anchor, a.label, a.v, r.vec_id AS positive_id, list_dot_product(a.v, r.v)::BIGINT AS positive_score, r.n AS positive
  FROM r a JOIN r ON r.label = a.label AND r.n <> a.n WHERE a.vec_id % 100 = 0
  QUALIFY row_number() OVER (PARTITION BY a.n ORDER BY list_dot_product(a.v, r.v) DESC, r.vec_id NULLS LAST) <= 5),
c AS (
  SELECT p.*, r.vec_id AS negative_id, list_dot_product(p.v, r.v)::BIGINT AS negative_score
  FROM p JOIN r ON r.label <> p.label
  WHERE 100 * list_dot_product(p.v, r.v) BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, negative_id, positive_score, negative_score
FROM c WINDOW w AS (PARTITION BY anchor, positive ORDER BY negative_score DESC, negative_id NULLS LAST)
QUALIFY row_number() OVER w <= 10
"""

ORACLE_SQL = {"op1_exact_dedup": _OP1, "op4_chat_format": _OP4, "op8_url_filter": _OP8, "op12_prefix_trie": _OP12,
              "op13_hard_negatives": _OP13}
