"""Registered queries of near-duplicates. SimHash is not in SQL: tests compare brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import minhash, simhash
from carelake.llm.common import table

#: words of a shingle, and bits in which linked fingerprints may differ
SHINGLE, BITS = 3, 3
#: words of a shingle, and percent of shingles that linked documents have in common
SET_SHINGLE, PERCENT = 2, 80


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, BITS)


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), SET_SHINGLE, PERCENT)


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MINHASH_SQL = f"""
WITH RECURSIVE split AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SET_SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {SET_SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SET_SHINGLE - 1}], ' ')) END) AS shingle FROM split
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
met AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
  SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * met.n >= {PERCENT} * (x.n + y.n - met.n)
), edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a AS doc_id, a AS least FROM edges UNION SELECT b, least FROM reach JOIN edges ON a = doc_id),
named AS (SELECT doc_id, min(least) AS least FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, doc_id) AS component_id, coalesce(least, doc_id) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN named USING (doc_id)
"""

QUERIES = {"op10_simhash": op10_simhash, "op11_minhash": op11_minhash}
CHECKS = {"op11_minhash": _MINHASH_SQL}
