"""Registered queries of the operators, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from verdigris.llm import (
    language, licenses, mixing, ngram_join, packing, periods, quality, secrets, sharding, topk, url_filter, variants, warc,
)
from verdigris.llm.common import register, table

N_SHARDS = 24


@register("op1_kd_shards")
def op1(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), N_SHARDS)


@register("op3_quality_rules")
def op3(spark, sf_dir):
    judged = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "failed_rules")


@register("op4_license_scan")
def op4(spark, sf_dir):
    return licenses.license_documents(table(spark, sf_dir, "documents"))


@register("op2_centroid_language")
def op2(spark, sf_dir):
    return language.language_documents(table(spark, sf_dir, "documents"))


@register("op5_secret_scan")
def op5(spark, sf_dir):
    return secrets.secret_documents(table(spark, sf_dir, "documents"))


@register("op6_best_fit_packing")
def op6(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op7_jaccard_join")
def op7(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@register("op8_pivotal_mix")
def op8(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@register("op9_url_templates")
def op9(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@register("op10_max_score", """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op10(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op11_periodic_runs")
def op11(spark, sf_dir):
    return periods.run_documents(table(spark, sf_dir, "documents"))


@register("op12_warc_source", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h FROM p),
b AS (
  SELECT page_id, payload_bytes, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    (CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1) FOR i IN range(32)], '') AS payload_digest
  FROM d
), f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
""")
def op12(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@register("op13_spelling_variants", r"""
WITH RECURSIVE crcs AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
), counted AS (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), bytes AS (
  SELECT run, n, flatten([CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END
                          FOR c IN string_split(doc_id || ':' || run, '')]) AS b
  FROM counted
), hashed AS (
  SELECT run, n, xor(list_reduce([4294967295] || b, lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h
  FROM bytes, crcs
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 <> 0 THEN run
                    ELSE substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), shorter AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS form_n FROM near GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 5 * w.n THEN b.form_n END AS form_n,
         CASE WHEN b.form_n >= 5 * w.n THEN
           (SELECT min(encode(x.other)) FROM near x WHERE x.word = w.word AND x.other_n = b.form_n) END AS form
  FROM words w LEFT JOIN best b ON w.word = b.word
), chain AS (
  SELECT word, CAST(decode(form) AS VARCHAR) AS at FROM forms WHERE form IS NOT NULL
  UNION SELECT c.word, decode(f.form) FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NOT NULL
), last AS (
  SELECT c.word, c.at FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NULL
)
SELECT f.word, decode(f.form) AS form, coalesce(l.at, f.word) AS root, f.n, f.n_near, f.form_n
FROM forms f LEFT JOIN last l ON f.word = l.word
""")
def op13(spark, sf_dir):
    return variants.variant_documents(table(spark, sf_dir, "documents"))
