"""The text pipeline: from raw documents to token counts, stage by stage.

Each stage works on all that its predecessor kept, and all but the last return the columns of the
documents. Rows are defined as by the operators that the stages call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelake.llm import exact_dedup, mixing, quality, simhash
from carelake.llm.common import stored, table
from carelake.llm.queries_mixing import MOST, schedule
from carelake.llm.queries_near import BITS, SHINGLE
from carelake.llm.queries_tokens import token_digests, vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the plain rules and their language's perplexity band."""
    return quality.accepted(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest id."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest id."""
    return simhash.one_of_each(docs, SHINGLE, BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in training order."""
    return mixing.mixed(docs, schedule, MOST)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text, for each row taken."""
    return token_digests(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing to target weights", mix_sources),
    ("BPE encoding", encode),
]

#: no SQL can express the stages; tests/llm compares them with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before has written."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
