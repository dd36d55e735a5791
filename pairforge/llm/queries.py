"""Contract queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .common import table
from .fingerprints import fingerprints
from .langid import identify
from .licenses import scan_licenses
from .mixing import mix
from .negatives import mine_negatives
from .ngram_join import ngram_jaccard_join
from .secrets import secret_digest
from .spelling import group_variants, runs, with_slips, words
from .substring_dedup import dedup_substrings
from .topk import top_k
from .toxicity import toxicity
from .urls import url_filter

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages"), URL_RULES)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs(table(spark, sf_dir, "documents"), "doc_id", "text")
    return group_variants(words(found, with_slips(found)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0, label)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_bpe": op2_bpe,
    "op3_mix": op3_mix,
    "op4_ngram_join": op4_ngram_join,
    "op5_top_k": op5_top_k,
    "op6_secret_scan": op6_secret_scan,
    "op7_toxicity": op7_toxicity,
    "op8_fingerprints": op8_fingerprints,
    "op9_license_scan": op9_license_scan,
    "op10_url_filter": op10_url_filter,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_substring_dedup": op13_substring_dedup,
}

SQL: dict[str, str] = {
    "op5_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op10_url_filter": r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*(/[^?#]*)?', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/'
  END AS rule FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
""",
    "op11_spelling_variants": """
WITH RECURSIVE
x AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
r AS (
  SELECT DISTINCT doc_id, low, n FROM (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    GROUP BY ALL) WHERE length(low) >= 7),
b AS (SELECT doc_id, low, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || low)) AS hx FROM r),
h AS (
  SELECT doc_id, low, n, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(0, length(hx) // 2), lambda k: ('0x' || substr(hx, 2 * k + 1, 2))::BIGINT)),
           lambda c, y: xor(x.t[xor(c & 255, y) + 1], c >> 8))) AS h
  FROM b, x),
w AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(low, 1, (h % length(low))::INTEGER) || substr(low, (h % length(low))::INTEGER + 2) ELSE low END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
g AS (SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM p),
e AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM g a JOIN g b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT g.word, g.n, v.word, v.n FROM g JOIN v ON v.word = g.less
  UNION SELECT v.word, v.n, g.word, g.n FROM g JOIN v ON v.word = g.less),
f AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM e GROUP BY word),
j AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM v LEFT JOIN f USING (word)),
c AS (
  SELECT word, word AS at, form AS onward FROM j
  UNION ALL SELECT c.word, j.word, j.form FROM c JOIN j ON j.word = c.onward)
SELECT j.word, form, c.at AS root, n, n_near, form_n FROM j JOIN c ON c.word = j.word AND c.onward IS NULL
""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
""",
    "op13_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM s),
f AS (SELECT win, min(doc_id) AS first FROM g GROUP BY win),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM g JOIN f USING (win) WHERE g.doc_id > f.first),
r AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id),
k AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
         CASE WHEN gone IS NULL THEN w
              ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]) END AS kept
  FROM d LEFT JOIN r USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
""",
}
