"""Registered queries of the operators that stay within DataFrame functions, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import chat, exact_dedup, sharding
from carelake.llm.common import table

SHARDS, SEED = 16, 2024


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    placed = sharding.document_shards(docs, SHARDS, SEED)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classified(table(spark, sf_dir, "documents"), keep="largest")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    one = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.array(
            F.struct(F.lit("user").alias("role"), F.lit(said).alias("content")),
            F.struct(F.lit("assistant").alias("role"), F.lit(said).alias("content")),
        ).alias("messages"),
    )
    turns = chat.canonical(table(spark, sf_dir, "conversations")).unionByName(chat.canonical(one))
    out = chat.formatted(turns).select("conv_id", "segments", "formatted", chat.parsed(F.col("formatted")).alias("back"))
    lines = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.withColumn("learned", chat.learned(F.col("segments"))).select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: CRC-32 of the bytes, four bits at a time, low half of each byte first
_NIBBLES = [0]
for _n in range(1, 16):
    _c = _n
    for _ in range(4):
        _c = (_c >> 1) ^ (0xEDB88320 if _c & 1 else 0)
    _NIBBLES.append(_c)
_DIGITS = "'123456789ABCDEF'"
_HALF = "xor({0} >> 4, %s[CAST({0} & 15 AS INT) + 1]::BIGINT)" % _NIBBLES


def crc_sql() -> str:
    """CRC-32 of the bytes that the column `hexed` spells."""
    return f"""xor(4294967295, list_reduce(list_transform(regexp_extract_all(hexed, '..'),
  lambda h: CAST(16 * instr({_DIGITS}, h[1]) + instr({_DIGITS}, h[2]) AS BIGINT)),
  lambda c, x: {_HALF.format(_HALF.format("xor(c, x)"))}, 4294967295::BIGINT))"""


_SHARD_SQL = f"""
WITH RECURSIVE keys AS (
  SELECT doc_id, coalesce(text, '') AS body, hex(body) AS hexed, strlen(body) + 1 AS size,
    row_number() OVER (ORDER BY doc_id NULLS FIRST) - 1 AS row_number, count(*) OVER () AS total FROM documents
), {sharding.permutation_sql("row_number", "total", SEED, "keys")}
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST({crc_sql()} AS BIGINT) AS text_crc32, 'rows' AS law, CAST(spot % {SHARDS} AS INT) AS shard,
  CAST(spot // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard, row_number FROM placed
"""

_DEDUP_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_CHAT_SQL = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS lines,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learned,
    sum(23 + length(role) + length(regexp_replace(role, '[^<\\[\\\\]', '', 'g'))
      + length(text) + length(regexp_replace(text, '[^<\\[\\\\]', '', 'g'))) AS chars
  FROM said GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
  CAST(chars AS BIGINT) AS formatted_chars FROM whole
"""

QUERIES = {"op3_shards": op3_shards, "op7_exact_dedup": op7_exact_dedup, "op9_chat_format": op9_chat_format}
CHECKS = {"op3_shards": _SHARD_SQL, "op7_exact_dedup": _DEDUP_SQL, "op9_chat_format": _CHAT_SQL}
