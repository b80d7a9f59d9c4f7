"""The registered queries of the training-data operators, and their SQL."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, conversations, exact_dedup, fingerprint, html_main, near_dedup, packing, pieces, quality, repeats, secrets, sharding
from .common import documents

SHARDS = 24


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(documents(spark, sf_dir)).drop("th", "comp")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), SHARDS)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op7_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repair(conversations.damage(table), table)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN,
                           public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scan, op2_near_dedup, op3_byte_bpe, op4_exact_dedup, op5_sharding, op6_quality, op7_html_main, op8_fingerprint, op9_packing, op10_repeats,
                              op11_conversations, op12_pieces, op13_alignment)}

#: SQL where it can express an operator; the others are compared with brute force in tests/llm.
ORACLE_SQL = {
    # every pair of documents by shared shingles, and the closure of the links
    "op2_near_dedup": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda w: w <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM words),
flat AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*))
  UNION ALL
  SELECT min(doc_id) OVER (), doc_id FROM sets WHERE len(sh) = 0),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets
  UNION
  SELECT r.doc_id, e.y FROM reach r JOIN edges e ON e.x = r.other),
class AS (SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, c.class_id, count(*) OVER (PARTITION BY c.class_id) AS class_size, CAST(len(s.sh) AS BIGINT) AS n_shingles
FROM class c JOIN sets s ON s.doc_id = c.doc_id""",
    "op4_exact_dedup": r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW g AS (PARTITION BY t)""",
    # the cheapest (cost, initials) of each state, row by row from the end of a conversation
    "op11_conversations": r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
checked AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, length(name) + 1),
      lambda i: [ord(name[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)))) % 20 AS hit FROM given),
damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS again FROM checked WHERE hit <> 0),
placed AS (
  SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n, left(role, 1) AS s,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), again)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (i > 1 AND before || s NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(s) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed) GROUP BY conv_id),
-- states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
step AS (
  SELECT DISTINCT conv_id, n + 1 AS i, {'c': 0, 'a': ''} AS q0, {'c': 10, 'a': 'II'} AS q1, {'c': 5, 'a': 'I'} AS q2, {'c': 0, 'a': ''} AS q3 FROM placed
  UNION ALL
  SELECT conv_id, i, least(r0, {'c': 5 + g2.c, 'a': 'I' || g2.a}), least(r1, {'c': 5 + g2.c, 'a': 'I' || g2.a}), g2, g3 FROM (
    SELECT *, least(r2, {'c': 5 + r3.c, 'a': 'I' || r3.a}) AS g2, least(r3, {'c': 5 + r2.c, 'a': 'I' || r2.a}) AS g3 FROM (
      SELECT p.conv_id, p.i,
        least({'c': 2 + q0.c, 'a': 'D' || q0.a}, {'c': e + 1 + q2.c, 'a': 'R' || q2.a},
          {'c': CASE s WHEN 's' THEN e + q1.c WHEN 'u' THEN e + q2.c ELSE 1000000000 END, 'a': 'K' || CASE s WHEN 's' THEN q1.a ELSE q2.a END}) AS r0,
        least({'c': 2 + q1.c, 'a': 'D' || q1.a}, {'c': e + 1 + q2.c, 'a': 'R' || q2.a},
          {'c': CASE s WHEN 'u' THEN e + q2.c ELSE 1000000000 END, 'a': 'K' || q2.a}) AS r1,
        least({'c': 2 + q2.c, 'a': 'D' || q2.a}, {'c': e + 1 + q3.c, 'a': 'R' || q3.a},
          {'c': CASE s WHEN 'a' THEN e + q3.c ELSE 1000000000 END, 'a': 'K' || q3.a}) AS r2,
        least({'c': 2 + q3.c, 'a': 'D' || q3.a}, {'c': e + 1 + q2.c, 'a': 'R' || q2.a},
          {'c': CASE s WHEN 'u' THEN e + q2.c ELSE 1000000000 END, 'a': 'K' || q2.a}) AS r3
      FROM step JOIN (SELECT *, CASE fault WHEN 'truncated' THEN 5 WHEN '' THEN 0 ELSE 1000000 END AS e FROM placed) p
        ON p.conv_id IS NOT DISTINCT FROM step.conv_id AND p.i = step.i - 1))),
best AS (SELECT conv_id, q0.c AS cost, q0.a AS audit FROM step WHERE i = 1),
letters AS (
  SELECT conv_id, k, audit[k] AS letter, count(*) FILTER (audit[k] <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
    count(*) FILTER (audit[k] <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS m,
    length(replace(audit, 'D', '')) % 2 AS odd
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM best)),
lines AS (
  SELECT l.conv_id, string_agg(CASE WHEN letter = 'K' THEN p.role WHEN (m + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE p.text END, chr(10) ORDER BY k) AS repaired
  FROM letters l LEFT JOIN placed p ON p.conv_id IS NOT DISTINCT FROM l.conv_id AND p.i = l.i AND letter <> 'I'
  WHERE letter <> 'D' GROUP BY l.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM o.conv_id""",
}
