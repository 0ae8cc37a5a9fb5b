"""The operators' registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    ann, byte_bpe, language, ledger, lines, negatives, packing, pii, simhash, suffixes, topk, warc,
    whitening,
)
from tidemark.sources.shared import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"), divisor=50, k=5)


def op2_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), divisor=20, k=20)


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.report(table(spark, folder, "documents"))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.report(table(spark, folder, "pages"), fresh_path(spark, "warc"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.report(table(spark, folder, "documents"))


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.predictions(table(spark, folder, "documents"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.digests(table(spark, folder, "documents"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.report(table(spark, folder, "documents"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.report(table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.report(table(spark, folder, "embeddings"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.report(table(spark, folder, "embeddings"))


def op13_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.report(table(spark, folder, "documents"), fresh_path(spark, "ledger"))


def queries() -> dict[str, Query]:
    return {
        "op1_topk": op1_topk,
        "op2_ann": op2_ann,
        "op3_simhash": op3_simhash,
        "op4_warc": op4_warc,
        "op5_packing": op5_packing,
        "op6_pii": op6_pii,
        "op7_language_id": op7_language_id,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_line_dedup": op9_line_dedup,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_whitening": op11_whitening,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_secret_ledger": op13_secret_ledger,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_topk": TOPK,
        "op4_warc": WARC,
        "op12_hard_negatives": NEGATIVES,
    }


TOPK = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank,
    vec_id, score FROM s
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""


# sha256() of DuckDB takes a string's UTF-8 bytes.
WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), f AS (
  SELECT html AS h, min(page_id) AS target FROM p WHERE n >= 100 GROUP BY html
)
SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN target <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN target <> page_id THEN target END AS refers_to
FROM p LEFT JOIN f ON html = h
"""


NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
    list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (
    PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 3
"""
