"""Registered query of resampling by importance, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import resampling
from carelake.llm.common import table
from carelake.llm.queries_native import crc_sql

PERCENT, LEAST_WORDS, MOST, BUCKETS, SEED = 5, 20, 3, 10_000, 42


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resampled(docs, target, PERCENT, LEAST_WORDS, MOST, BUCKETS, SEED)


_WINDOWS = ", ".join(f"list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i:i + {n - 1}], ' '))" for n in range(1, MOST + 1))


def _features(rows: str) -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate(coalesce(text, ''), '{letters}', '{letters.lower()}')"
    return f"""SELECT doc, len(w) AS n_words, unnest(flatten([{_WINDOWS}])) AS feature FROM (
    SELECT doc, regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {rows})"""


_RESAMPLED_SQL = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS doc, doc_id, text FROM documents),
mine AS MATERIALIZED ({_features("docs")}),
theirs AS MATERIALIZED ({_features("(SELECT item_id AS doc, text FROM benchmark)")}),
hexes AS MATERIALIZED (SELECT feature, hex(feature) AS hexed FROM (SELECT feature FROM mine UNION SELECT feature FROM theirs)),
bucketed AS MATERIALIZED (SELECT feature, {crc_sql()} % {BUCKETS} AS bucket FROM hexes),
s AS (SELECT bucket, count(*) AS n FROM mine JOIN bucketed USING (feature) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM theirs JOIN bucketed USING (feature) GROUP BY bucket),
gains AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM mine) + {BUCKETS})::DOUBLE)
    / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM theirs) + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
), weights AS (
  SELECT doc, any_value(n_words) AS n_words, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM mine JOIN bucketed USING (feature) JOIN gains USING (bucket) GROUP BY doc
), scored AS (
  SELECT doc, doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    ('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h
  FROM docs LEFT JOIN weights USING (doc)
), final AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h::DOUBLE + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM scored
), placed AS (
  SELECT doc, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM final WHERE n_words >= {LEAST_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * {PERCENT} // 100 THEN place END AS rank
FROM final LEFT JOIN placed USING (doc)
"""

QUERIES = {"op12_resampling": op12_resampling}
CHECKS = {"op12_resampling": _RESAMPLED_SQL}
