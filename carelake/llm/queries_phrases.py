"""Registered query of phrase collocations, and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import collocations
from carelake.llm.common import table

LONGEST, LEAST, TOP, COVERED, NO_LANG = 3, 10, 2000, 50, "und"


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), LONGEST, LEAST, TOP, COVERED, no_lang=NO_LANG)


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_RUNS = ", ".join(f"list_transform(range(1, len(w) - {n - 2}), lambda i: {{'words': {n}, 'phrase': array_to_string(w[i:i + {n - 1}], ' ')}})" for n in range(1, LONGEST + 1))
_PHRASES_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), split AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM split GROUP BY lang),
runs AS (SELECT lang, unnest(flatten([{_RUNS}])) AS r FROM split),
often AS MATERIALIZED (
  SELECT lang, r.words AS words, r.phrase AS phrase, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= {LEAST}
), able AS MATERIALIZED (SELECT lang, words, phrase, f, string_split(phrase, ' ') AS w FROM often WHERE words >= 2),
around AS (
  SELECT lang, phrase, max(f) AS most FROM (
    SELECT lang, f, array_to_string(w[i:i + n - 1], ' ') AS phrase
    FROM able, range(2, {LONGEST}) AS sizes(n), range(1, {LONGEST}) AS starts(i) WHERE n < words AND i + n - 1 <= words
  ) GROUP BY lang, phrase
), kept AS (
  SELECT able.* FROM able LEFT JOIN around USING (lang, phrase) WHERE most IS NULL OR 100 * most < {COVERED} * f
), cuts AS (
  SELECT kept.lang, kept.phrase, kept.f AS a, k, x.f AS l, y.f AS r,
    CAST(1000000::HUGEINT * kept.f * kept.f // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM kept, range(1, {LONGEST}) AS places(k), often x, often y
  WHERE k < kept.words AND x.lang = kept.lang AND y.lang = kept.lang
    AND x.phrase = array_to_string(w[1:k], ' ') AND y.phrase = array_to_string(w[k + 1:], ' ')
), lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN total USING (lang) WHERE rank <= {TOP}
"""

QUERIES = {"op13_phrases": op13_phrases}
CHECKS = {"op13_phrases": _PHRASES_SQL}
